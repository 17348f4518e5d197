"""Small builders shared by the tests."""

import datetime as dt

EPOCH = dt.date(2013, 1, 1)
CURVE = (
    "id long, ts timestamp_ntz, volt_c double, power double, dti long, sdti int, season int, daytype int"
)


def ts_of(dti):
    return dt.datetime(2013, 1, 1) + dt.timedelta(minutes=15 * (dti - 1))


def curve_row(meter, dti, volt, power, season=4, daytype=1):
    return (meter, ts_of(dti), volt, power, dti, (season - 1) * 3 + daytype, season, daytype)


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())

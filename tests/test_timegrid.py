import datetime as dt

import pytest

from pyspark.sql import functions as F

from helpers import EPOCH, rows
from wattloom.functions import codes, timegrid
from wattloom.operators import (
    calendar_labels,
    interval_calendar,
    interval_calendar_of,
    season_daytype_labels,
)


def one(spark, *exprs):
    return spark.range(1).select(*exprs).first()


def test_slots_and_dti_are_inverse(spark):
    slots = spark.range(1, 97).select(F.col("id").cast("int").alias("idx"), F.lit(dt.date(2013, 3, 31)).alias("day"))
    placed = slots.select(
        "idx",
        timegrid.slot_timestamp(F.col("day"), F.col("idx")).alias("ts"),
        timegrid.slot_dti(F.col("day"), F.col("idx"), EPOCH).alias("dti"),
    )
    back = placed.select(
        "idx",
        "ts",
        "dti",
        timegrid.dti_of(F.col("ts"), EPOCH).alias("dti2"),
        timegrid.timestamp_of(F.col("dti"), EPOCH).alias("ts2"),
        timegrid.bucket(F.col("dti")).alias("bucket"),
        timegrid.hour_index(F.col("dti")).alias("hour"),
        timegrid.is_hour_start(F.col("dti")).alias("start"),
    ).collect()
    assert len(back) == 96
    for r in back:
        assert r.ts == dt.datetime(2013, 3, 31) + dt.timedelta(minutes=15 * (r.idx - 1))
        assert r.dti == 89 * 96 + r.idx == r.dti2
        assert r.ts2 == r.ts
        assert r.bucket == r.idx % 96
        assert r.hour == (r.idx - 1) // 4
        assert r.start == (r.idx % 4 == 1)


def test_the_grid_does_not_follow_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 2013-03-10 has only 23 hours there.
        r = one(
            spark,
            timegrid.slot_timestamp(F.lit(dt.date(2013, 3, 10)), F.lit(13)).alias("ts"),
            timegrid.timestamp_of(F.lit(68 * 96 + 13), EPOCH).alias("ts2"),
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert r.ts == r.ts2 == dt.datetime(2013, 3, 10, 3, 0)


def test_seasons_and_daytypes(spark):
    days = [(dt.datetime(2013, m, d),) for m in range(1, 13) for d in range(1, 8)]
    df = spark.createDataFrame(days, "ts timestamp_ntz")
    ts = F.col("ts")
    got = df.select("ts", timegrid.season(ts), timegrid.daytype(ts), timegrid.sdti(ts)).collect()
    expected_season = {1: 4, 2: 4, 3: 1, 4: 1, 5: 1, 6: 2, 7: 2, 8: 2, 9: 2, 10: 3, 11: 3, 12: 4}
    for when, se, dy, sdti in got:
        assert se == expected_season[when.month]
        assert dy == (1 if when.weekday() < 5 else 2)
        assert sdti == 3 * (se - 1) + dy
    assert {r[3] for r in got} == {1, 2, 4, 5, 7, 8, 10, 11}


def test_null_times_stay_null(spark):
    ts = F.lit(None).cast("timestamp_ntz")
    assert tuple(one(spark, timegrid.season(ts), timegrid.daytype(ts), timegrid.sdti(ts))) == (None,) * 3


def test_codes_and_casts(spark):
    d = F.lit("5.000").cast("decimal(10,3)")
    ts = F.lit("2013-01-02 03:45:00").cast("timestamp_ntz")
    r = one(
        spark,
        codes.decimal_to_int(d),
        codes.decimal_to_long(d),
        codes.decimal_to_double(d),
        codes.timestamp_text(ts),
        codes.date_text(ts),
        codes.text_timestamp(codes.timestamp_text(ts)),
    )
    assert tuple(r) == (5, 5, 5.0, "2013-01-02 03:45:00", "2013-01-02", dt.datetime(2013, 1, 2, 3, 45))
    types = spark.createDataFrame([("01",), ("02",), ("11",), ("99",), (None,)], "c string")
    assert [x[0] for x in types.select(codes.load_type(F.col("c"))).collect()] == [1, 2, 3, 0, 0]


def test_mean_of_decimals_is_exact(spark):
    df = spark.range(30).select((F.lit("0.1").cast("decimal(8,4)")).alias("v"))
    assert df.agg(codes.mean("v")).first()[0] == 0.1


def test_calendars(spark):
    cal = interval_calendar(spark, days=2, epoch=EPOCH)
    got = rows(cal, "datetimeintervalid", "end")
    assert got[0] == (1, dt.datetime(2013, 1, 1)) and got[-1] == (192, dt.datetime(2013, 1, 2, 23, 45))
    assert cal.filter("start IS NOT NULL").count() == 0
    readings = spark.createDataFrame(
        [(dt.datetime(2013, 1, 3, 5),), (dt.datetime(2013, 1, 4, 1),)], "ts timestamp_ntz"
    )
    ids = rows(interval_calendar_of(readings, EPOCH), "datetimeintervalid")
    assert ids == [(i,) for i in range(193, 385)]
    assert interval_calendar_of(readings.limit(0), EPOCH).count() == 0
    bad = readings.union(spark.createDataFrame([(dt.datetime(3013, 1, 3),)], readings.schema))
    with pytest.raises(Exception, match="3013"):
        interval_calendar_of(bad, EPOCH).count()
    assert interval_calendar_of(bad, EPOCH, last=dt.date(2013, 1, 4)).count() == 192


def test_labels(spark):
    twelve = {r.sdti: r.label for r in season_daytype_labels(spark).collect()}
    assert len(twelve) == 12
    assert (twelve[1], twelve[3], twelve[5], twelve[12]) == (
        "Spring-Weekday", "Spring-Holiday", "Summer-Weekend", "Winter-Holiday",
    )
    full = calendar_labels(spark).collect()
    assert len({r.label for r in full}) == 36
    assert {r.label for r in full if r.loadtype == 2 and r.sdti == 8} == {"Commercial-Fall-Weekend"}

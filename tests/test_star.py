import datetime as dt

from pyspark.sql import functions as F

from helpers import EPOCH, rows, ts_of
from wattloom.operators import (
    basereading,
    for_meters,
    interval_calendar,
    meter_dims,
    meter_range,
    reading_types,
    stacked_basereading,
    star_readings,
    to_basereading,
)
from wattloom.settings import BASEREADING_CHANNELS, FAMILY_COLUMNS
from wattloom.sources import sample

FACTS = ("meter", "timeperiod", "readingtype", "value")


def dims(spark):
    kinds = ["V", "A", "P", "Q", "PF", "EP", "EQ"]
    names = ["none", "phaseA", "phaseB", "phaseC"]
    types = [
        (100 + 10 * k + p, p, None, k) for k in range(len(kinds)) for p in range(4)
    ] + [(1, 1, "peak", 0), (900, 1, None, 0)]
    return (
        spark.createDataFrame(types, "readingtypeid long, phases int, tou string, measurementkind int"),
        spark.createDataFrame(list(enumerate(names)), "phasecode int, code string"),
        spark.createDataFrame(list(enumerate(kinds)), "measurementkindid int, code string"),
    )


def test_reading_types(spark):
    got = {(r.family, r.flag): (r.code, r.phase, r.readingtypeid) for r in reading_types(*dims(spark)).collect()}
    assert len(got) == 20 == sum(len(f) for f in BASEREADING_CHANNELS.values())
    # Time-of-use types do not count and the smallest id wins.
    assert got[("V", 1)] == ("V", "A", 101)
    assert got[("P", 5)] == ("Q", "none", 130)
    assert got[("E", 2)] == ("EQ", "none", 160)


def test_basereading(spark):
    types = reading_types(*dims(spark))
    volts = spark.createDataFrame(
        [(1, 5, 1, 220.0), (1, 5, 2, None), (2, 6, 3, 221.0), (2, 6, 9, 1.0), (None, 6, 3, 1.0)],
        "id long, dti long, phase_flag int, volt double",
    )
    fact = to_basereading(volts, "V", types)
    assert fact.columns == ["meter", "timeperiod", "readingtype", "reason", "reporteddatatime", "value", "source"]
    assert rows(fact, "meter", "timeperiod", "readingtype", "value") == [(1, 5, 101, 220.0), (2, 6, 103, 221.0)]
    assert to_basereading(volts, "XX", types).count() == 0
    power = volts.select("id", "dti", F.lit(6).alias("data_type"), F.col("volt").alias("power"))
    both = basereading({"V": volts, "P": power}, types)
    assert both.count() == 2 + 3


def test_meter_dims(spark):
    readings = spark.createDataFrame([(3,), (3,), (4,)], "id long")
    tables = meter_dims(readings)
    assert rows(tables["identifiedobject"], "identifiedobjectid", "description") == [(3, "meter"), (4, "meter")]
    assert len(tables["enddevice"].columns) == 11 and tables["enddevice"].count() == 2
    assert tables["meter"].columns == ["meterid", "formnumber", "description"]


def test_meter_filters(spark):
    df = spark.range(3000)
    assert meter_range(df, "id").agg(F.min("id"), F.max("id"), F.count("*")).first()[:] == (14, 1648, 1635)
    assert rows(for_meters(df, [5, 7])) == [(5,), (7,)]
    table = spark.createDataFrame([(5,), (5,), (9,)], "meter long")
    assert rows(for_meters(df, table)) == [(5,), (9,)]


def test_star_readings(spark):
    readingtype, _, kinds = dims(spark)
    fact = spark.createDataFrame(
        [(1, 2, 101, 220.0), (1, 3, 130, 0.5), (2, 2, 101, 1.0), (3, 2, 101, 1.0), (1, 9999, 101, 1.0)],
        "meter long, timeperiod long, readingtype long, value double",
    )
    meter = spark.createDataFrame([(1,), (2,)], "meterid long")
    ido = spark.createDataFrame([(1,), (3,)], "identifiedobjectid long")
    summary = star_readings(fact, meter, ido, readingtype, kinds, interval_calendar(spark, 2, EPOCH))
    assert rows(summary) == [
        (1, 2, ts_of(2), 220.0, "V", 1),
        (1, 3, dt.datetime(2013, 1, 1, 0, 30), 0.5, "Q", 0),
    ]


def test_stacked_families_give_the_same_facts(spark):
    sf = "/root/testdata/sf0.001"
    readings = sample.readings(spark, sf)
    types = reading_types(sample.reading_type_table(spark, sf), sample.phases(spark), sample.measurement_kinds(spark))
    parts = {f: sample.family(readings, value) for f, (value, _) in FAMILY_COLUMNS.items()}
    assert rows(stacked_basereading(readings, types), *FACTS) == rows(basereading(parts, types), *FACTS)
    some = stacked_basereading(readings, types, ["V", "unknown", "E"])
    assert rows(some, *FACTS) == rows(basereading({f: parts[f] for f in ("V", "E")}, types), *FACTS)

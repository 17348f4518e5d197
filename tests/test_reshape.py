import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import EPOCH, rows, ts_of
from wattloom.operators import day_curve_pivot, phase_pivot, power_pivot, slot_columns, unpivot_curve
from wattloom.settings import DAY_CURVES, FACTOR_PHASES, VOLT_PHASES


def wide_frame(spark, prefix, flag, days=2, holes=()):
    records = [
        (7, dt.datetime(2013, 1, 1) + dt.timedelta(days=d), f)
        + tuple(None if (d, n) in holes else float(1000 * d + 100 * f + n) for n in range(1, 97))
        for d in range(days)
        for f in (1, 2)
    ]
    schema = f"id long, data_date timestamp_ntz, {flag} int, " + ", ".join(f"{prefix}{n} double" for n in range(1, 97))
    return spark.createDataFrame(records, schema)


@pytest.mark.parametrize(
    "value, prefix, flag",
    [("volt", "U", "phase_flag"), ("power", "P", "data_type"), ("cur", "I", "phase_flag"),
     ("pf", "C", "phase_flag"), ("energy", "R", "data_type")],
)
def test_unpivot_keeps_every_cell(spark, value, prefix, flag):
    wide = wide_frame(spark, prefix, flag, holes={(0, 5)})
    long = unpivot_curve(wide, value, epoch=EPOCH)
    assert long.columns == ["id", "ts", "dti", flag, value]
    got = {(r.dti, r[flag]): (r.ts, r[value]) for r in long.collect()}
    assert len(got) == 2 * 2 * 96
    for d in range(2):
        for f in (1, 2):
            for n in range(1, 97):
                expected = None if (d, n) == (0, 5) else float(1000 * d + 100 * f + n)
                assert got[(96 * d + n, f)] == (ts_of(96 * d + n), expected)


def test_unpivot_is_one_scan_without_shuffle(spark):
    plan = unpivot_curve(wide_frame(spark, "U", "phase_flag"), "volt")._jdf.queryExecution().toString()
    assert "Union" not in plan and "Exchange" not in plan


def test_pivot_of_unpivot_is_the_identity(spark):
    wide = wide_frame(spark, "P", "data_type").filter("data_type = 1")
    long = unpivot_curve(wide, "power", epoch=EPOCH)
    summary = long.select(
        F.col("id").alias("meterid"),
        F.col("dti").alias("datetimeintervalid"),
        F.col("ts").alias("mtime"),
        F.col("power").alias("value"),
        F.lit("P").alias("code"),
    )
    back = day_curve_pivot(summary, "P", first_bucket=1)
    got = sorted(tuple(r[f"P{n}"] for n in range(96)) for r in back.collect())
    want = sorted(tuple(r[f"P{n}"] for n in range(1, 97)) for r in wide.collect())
    assert got == want


@pytest.mark.parametrize("code", list(DAY_CURVES))
def test_day_curve_columns(spark, code):
    prefix, flag, flag_value = DAY_CURVES[code]
    summary = spark.createDataFrame(
        [(1, d, ts_of(d), float(d), code) for d in range(1, 97)]
        + [(1, 5, ts_of(5), 500.0, code), (1, 6, ts_of(6), 1.0, "other")],
        "meterid long, datetimeintervalid long, mtime timestamp_ntz, value double, code string",
    )
    (row,) = day_curve_pivot(summary, code).collect()
    assert (row.mdate, row[flag], row.data_point_flag, row.data_whole_flag) == ("2013-01-01", flag_value, 1, 1)
    # Column n holds bucket (n + 2) mod 96; the largest of several values wins.
    assert (row[f"{prefix}0"], row[f"{prefix}3"], row[f"{prefix}94"], row[f"{prefix}95"]) == (2.0, 500.0, 96.0, 1.0)


def test_phase_pivots(spark):
    long = spark.createDataFrame(
        [(1, ts_of(1), 1, 1, 220.0), (1, ts_of(1), 1, 1, 221.0), (1, ts_of(1), 1, 2, None),
         (1, ts_of(2), 2, 0, 0.9), (1, ts_of(2), 2, 3, 0.5)],
        "id long, ts timestamp_ntz, dti long, phase_flag int, v double",
    )
    assert rows(phase_pivot(long, "v", VOLT_PHASES), "dti", "volt_a", "volt_b", "volt_c") == [
        (1, 221.0, None, None), (2, None, None, 0.5),
    ]
    assert rows(phase_pivot(long, "v", FACTOR_PHASES).filter("dti = 2"), "pfsum", "pf_c") == [(0.9, 0.5)]
    power = long.select("id", "ts", "dti", F.lit(6).alias("data_type"), F.col("v").alias("power"))
    assert rows(power_pivot(power), "dti", "psum", "qa") == [(1, None, 221.0), (2, None, 0.9)]


def test_wide_rows_are_laid_out_after_the_shuffle(spark):
    """Readings are narrow rows until the cells of a group are together: no wide partial row is shuffled."""
    df = spark.createDataFrame(
        [(1, 1, 5.0), (1, 1, 7.0), (1, 96, 2.0), (2, 3, None), (2, None, 4.0), (None, 2, 1.0)], "id long, idx int, v double"
    )
    wide = slot_columns(df, ["id"], "idx", "v", {n: f"U{n}" for n in range(1, 97)})
    plan = wide._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange", 1)
    assert "partial_max(CASE" in above and "CASE" not in below
    got = {tuple(r) for r in wide.select("id", "U1", "U2", "U3", "U96").collect()}
    assert got == {(1, 7.0, None, None, 2.0), (2, None, None, None, None), (None, None, 1.0, None, None)}

import random

import numpy as np
from pyspark.sql import functions as F

from helpers import rows, ts_of
from wattloom.operators import (
    dead_points,
    outage_events,
    outage_points,
    quality_tags,
    slot_stats,
    volt_high,
    volt_low,
    volt_out,
    volt_quality,
)
from wattloom.operators.quality import is_high, is_low

POINT = "id long, ts timestamp_ntz, dti long"


def volts(spark, values):
    data = [(1, ts_of(i + 1), i + 1, 1, v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, f"{POINT}, phase_flag int, volt double")


def test_voltage_bands(spark):
    levels = [0.0, 9.9, 10.0, 10.1, 87.9, 88.0, 110.0, 132.0, 132.1, 187.9, 188.0, 220.0, 236.0, 236.1, None]
    df = volts(spark, levels)
    assert rows(volt_low(df), "volt") == [(10.1,), (87.9,), (132.1,), (187.9,)]
    assert rows(volt_high(df), "volt") == [(236.1,)]
    assert rows(volt_out(df), "volt") == [(0.0,), (9.9,)]
    tables = volt_quality(df)
    assert set(tables) == {"volt", "voltagelow", "voltagehigh", "voltageout"}
    assert tables["volt"].count() == len(levels)


def test_tags(spark):
    df = volts(spark, [0.05, 5.0, 150.0, 220.0, 240.0, None])
    v = F.col("volt")
    tagged = quality_tags(df, "volt", "Voltage", low=is_low(v), high=is_high(v))
    assert rows(tagged, "volt", "prbcode") == [
        (0.05, "Voltage-Missing"), (150.0, "Voltage-Low"), (240.0, "Voltage-High"),
    ]
    assert rows(quality_tags(df, "volt", "Power"), "prbcode") == [("Power-Missing",)]


def test_dead_points_need_all_three_phases(spark):
    df = spark.createDataFrame(
        [(1, ts_of(1), 1, 0.0, 0.0, 0.0), (1, ts_of(2), 2, 0.0, None, 0.0), (1, ts_of(3), 3, 0.0, 1.0, 0.0)],
        f"{POINT}, volt_a double, volt_b double, volt_c double",
    )
    assert rows(dead_points(df), "dti") == [(1,)]


def brute_events(points):
    out = []
    for meter in {p[0] for p in points}:
        dtis = sorted({p[1] for p in points if p[0] == meter})
        start = prev = dtis[0]
        for d in dtis[1:] + [None]:
            if d is None or d != prev + 1:
                out.append((meter, ts_of(start), start, prev, prev - start + 1))
                start = d
            prev = d
    return sorted(out)


def point_frame(spark, points):
    return spark.createDataFrame([(m, ts_of(d), d) for m, d in points], POINT)


def test_outage_events_match_brute_force(spark):
    rng = random.Random(3)
    points = [(m, rng.randrange(-40, 120)) for m in (1, 2, 3) for _ in range(90)]
    # One run covers several whole chunks, one starts and one ends on a chunk border.
    points += [(4, d) for d in range(5, 60)] + [(5, 16), (5, 17), (5, 31), (5, 32)]
    expected = brute_events(points)
    for chunk, fan in ((1, 2), (2, 3), (8, 256), (16, 2), (2688, 256)):
        got = rows(outage_events(point_frame(spark, points), chunk_slots=chunk, fan=fan))
        assert got == expected, chunk
    assert sum(e[4] for e in expected) == len(set(points))


def test_outage_in_every_chunk_of_one_meter(spark):
    """Every run crosses a border; no window holds more than the runs of ``fan`` chunks."""
    points = [(1, d) for d in range(4000) if d % 10 not in (4, 5)]
    frame = point_frame(spark, points)
    events = outage_events(frame, chunk_slots=10, fan=5)
    assert rows(events) == brute_events(points)
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(id" in plan and "windowspecdefinition(rangestart" not in plan


def test_outage_events_of_one_dominant_meter(spark):
    # A third of all rows are copies of one point and another third belongs to one meter.
    n = 3000
    points = spark.range(3 * n).select(
        F.when(F.col("id") < 2 * n, 1).otherwise(F.col("id")).cast("long").alias("id"),
        F.when(F.col("id") < n, 7).when(F.col("id") < 2 * n, F.col("id") + 100).otherwise(1).cast("long").alias("dti"),
    )
    points = points.withColumn("ts", F.expr("TIMESTAMP_NTZ '2013-01-01' + make_dt_interval(0, 0, 15 * (dti - 1))"))
    events = outage_events(points, chunk_slots=96)
    assert rows(events.filter("id = 1"), "rangestart", "rangeend", "duration") == [
        (7, 7, 1), (n + 100, 2 * n + 99, n),
    ]
    assert events.count() == 2 + n


def test_outage_points_are_single_intervals(spark):
    got = rows(outage_points(point_frame(spark, [(1, 1), (1, 2), (2, 2)])))
    assert got == [(1, ts_of(1), 1, 1, 1), (1, ts_of(2), 2, 2, 1), (2, ts_of(2), 2, 2, 1)]


def test_slot_stats_match_numpy(spark):
    rng = np.random.default_rng(1)
    data = np.round(rng.normal(220, 5, (6, 96)), 1)
    data[2, 3] = 0.0
    records = [(i, *map(float, row)) for i, row in enumerate(data)] + [(9, *([1.0] * 95), None)]
    schema = "id long, " + ", ".join(f"U{n} double" for n in range(1, 97))
    got = {r.idx: r for r in slot_stats(spark.createDataFrame(records, schema)).collect()}
    assert len(got) == 96
    for n in range(96):
        column, r = data[:, n], got[n + 1]
        assert r["count"] == 6 and r.nonzeros == np.count_nonzero(column)
        assert (r["min"], r["max"]) == (column.min(), column.max())
        np.testing.assert_allclose(
            [r["mean"], r.variance, r.norm_l1, r.norm_l2],
            [column.mean(), column.var(ddof=1), np.abs(column).sum(), np.sqrt((column**2).sum())],
        )


def test_runs_are_joined_in_their_sort(spark):
    """Only repeated points are aggregated; events keep their least ``ts``, and null points stay apart."""
    points = [(1, ts_of(d), d) for d in (3, 4, 5, 6, 7, 12, 13)] + [(1, ts_of(1), 6), (1, None, 12), (1, ts_of(9), None), (None, ts_of(2), 2)]
    df = spark.createDataFrame(points, "id long, ts timestamp_ntz, dti long")
    events = outage_events(df, chunk_slots=2, fan=2)
    assert events._jdf.queryExecution().executedPlan().toString().count("HashAggregate(") == 2
    assert {tuple(r) for r in events.collect()} == {
        (1, ts_of(1), 3, 7, 5), (1, ts_of(12), 12, 13, 2), (1, ts_of(9), None, None, None), (None, ts_of(2), 2, 2, 1)
    }

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import CURVE, curve_row, rows, ts_of
from wattloom.operators import (
    adaptive_histograms,
    hour_curves,
    hour_features,
    hour_histograms,
    hour_start_power,
    hour_start_vectors,
    hourly_profile,
    in_band,
    irregular_groups,
    load_category,
    meter_ids,
    meter_profile,
    smallest_histograms,
)
from wattloom.operators.histograms import condense


def curve(spark, records):
    return spark.createDataFrame(records, CURVE)


def test_band_is_closed_and_drops_nulls(spark):
    df = curve(spark, [curve_row(1, d, v, 1.0) for d, v in enumerate([87.9, 88.0, 300.0, 300.1, None], 1)])
    df = df.union(curve(spark, [curve_row(1, 9, 220.0, None), curve_row(None, 9, 220.0, 1.0)]))
    assert rows(in_band(df, 88, 300), "volt_c") == [(88.0,), (300.0,)]


def test_hourly_profile(spark):
    df = curve(
        spark,
        [curve_row(1, 1, 220.0, 1.0), curve_row(1, 97, 222.0, 2.0), curve_row(1, 96, 210.0, 4.0),
         curve_row(1, 1, 50.0, 99.0), curve_row(1, 1, 230.0, 5.0, season=2)],
    )
    profile = hourly_profile(df)
    assert rows(profile) == [(1, 2, 1, 1, 5.0, 230.0), (1, 4, 1, 0, 4.0, 210.0), (1, 4, 1, 1, 1.5, 221.0)]
    assert rows(meter_ids(profile)) == [(1,)]


def regular(meter, step, volt=220.0):
    """Every ``step``-th slot of one day; power equals the slot number."""
    return [curve_row(meter, d, volt + d / 100, float(d)) for d in range(1, 97, step)]


def test_hour_features_follow_the_slot_count(spark):
    df = curve(spark, regular(1, 1) + regular(2, 2) + regular(3, 4, volt=110.0) + regular(4, 1)[:30])
    profile = hourly_profile(df)
    assert rows(irregular_groups(profile)) == [(4, 4, 1)]
    assert irregular_groups(profile, min_points=31).count() == 0
    got = {(r.id, r.hourindex): (r.power, r.volt) for r in hour_features(profile).collect()}
    assert len(got) == 3 * 24
    for h in range(24):
        # 96 slots: bucket 0 comes first, so position 4h+1 is slot 4h+1, the hour start.
        assert got[(1, h)] == (4.0 * h + 1, (220.0 + (4 * h + 1) / 100) / 220.0)
        # 48 slots 1, 3, ..., 95: position 2h+1 is slot 4h+3.
        assert got[(2, h)][0] == 4.0 * h + 3
        # 24 slots: position h, and the second slot's mean decides for 110 V.
        assert got[(3, h)] == (4.0 * h + 1, (110.0 + (4 * h + 1) / 100) / 110.0)
    assert hour_curves(profile).filter("size(power) != 24 OR size(volt) != 24").count() == 0


def test_meter_profile_and_hour_start(spark):
    power = spark.createDataFrame(
        [(1, ts_of(d), d, t, p) for d, t, p in [(1, 1, 2.0), (2, 1, 4.0), (5, 1, None), (5, 5, 7.0), (9, 1, 3.0)]],
        "id long, ts timestamp_ntz, dti long, data_type int, power double",
    )
    assert rows(meter_profile(power)) == [(1, 9.0, 3.0, 4.0)]
    assert rows(hour_start_power(power)) == [(1, 1, 2.0), (1, 9, 3.0)]
    cats = spark.createDataFrame([(1, "11"), (2, "01")], "mped_id long, mp_attr_code string")
    assert rows(load_category(power, cats), "dti", "mp_attr_code", "loadtype") == [
        (1, "11", 3), (2, "11", 3), (9, "11", 3),
    ]


def random_curve(seed, n=1500):
    rng = np.random.default_rng(seed)
    return [
        curve_row(int(m), int(d), float(v), float(p), season=1, daytype=int(m))
        for m, d, v, p in zip(
            rng.integers(1, 3, n), rng.integers(1, 900, n),
            np.round(rng.uniform(150, 305, n), 1), np.round(rng.uniform(0, 3, n), 2),
        )
    ]


def brute_histogram(values, low, high, bins):
    counts = [0] * bins
    edges = [low + i * (high - low) / bins for i in range(1, bins)]
    for v in values:
        counts[sum(v >= e for e in edges) if high > low else 0] += 1
    return counts


@pytest.mark.parametrize("hot_share", [2, 1000])
def test_hour_histograms_match_brute_force(spark, hot_share):
    data = random_curve(2) + [curve_row(9, 1, 200.0, 1.0, season=1)] * 5
    got = {(r.id, r.hourindex): r for r in hour_histograms(curve(spark, data), hot_share=hot_share).collect()}
    assert len(got) == 3 * 24
    for meter in (1, 2, 9):
        band = [r for r in data if r[0] == meter and 154 <= r[2] <= 300]
        power, volt = [r[3] for r in band], [r[2] for r in band]
        for h in range(24):
            here = [r for r in band if r[4] % 4 == 1 and (r[4] - 1) % 96 // 4 == h]
            r = got[(meter, h)]
            assert [r[f"p{i}"] for i in range(10)] == brute_histogram(
                [x[3] for x in here], min(power), max(power), 10)
            assert [r[f"v{i}"] for i in range(3)] == brute_histogram(
                [x[2] for x in here], min(volt), max(volt), 3)


def brute_condense(values, points):
    """Repeatedly merges the first nearest pair."""
    slots = [[v, float(n)] for v, n in sorted(Counter(values).items())]
    while len(slots) > points:
        gaps = [b[0] - a[0] for a, b in zip(slots, slots[1:])]
        i = gaps.index(min(gaps))
        (x, m), (y, n) = slots[i], slots[i + 1]
        slots[i : i + 2] = [[(x * m + y * n) / (m + n), m + n]]
    return [tuple(s) for s in slots]


@pytest.mark.parametrize("seed", range(20))
def test_condense_merges_the_nearest_first(seed):
    rng = np.random.default_rng(seed)
    values = np.round(rng.uniform(0, 9, rng.integers(1, 60)), 1)  # many equal gaps
    distinct, counts = np.unique(values, return_counts=True)
    for points in (1, 3, 10):
        assert condense(distinct, counts, points) == brute_condense(values.tolist(), points)


def test_adaptive_histograms(spark):
    data = random_curve(4)
    df = curve(spark, [*data, curve_row(7, 5, 200.0, float("nan"), season=1, daytype=1)])
    histograms = adaptive_histograms(df)
    got = {(r.id, r.bucket): r for r in histograms.collect()}
    for meter, limit in ((1, 10), (2, 4)):
        band = [r for r in data if r[0] == meter and 154 <= r[2] <= 300]
        assert {b for m, b in got if m == meter} == {r[4] % 96 for r in band}
        for b in {r[4] % 96 for r in band}:
            here = [r for r in band if r[4] % 96 == b]
            r = got[(meter, b)]
            assert [(p.x, p.y) for p in r.power] == [(x, y / 5) for x, y in brute_condense([x[3] for x in here], limit)]
            assert [(p.x, p.y) for p in r.volt] == [(x / 1000, y / 100) for x, y in brute_condense([x[2] for x in here], 3)]
    assert got[(7, 5)].power is None and len(got[(7, 5)].volt) == 1
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert rows(adaptive_histograms(df.repartition(5))) == rows(histograms)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for v in hour_start_vectors(histograms.filter("id < 7")).collect():
        r = got[(v.id, 4 * v.hourindex + 1)]
        assert v.features == [x for p in (*r.power, *r.volt) for x in (p.x, p.y)]
    small = {r.id: r for r in smallest_histograms(histograms).collect()}
    assert small[1].min_power_bins == min(len(r.power) for k, r in got.items() if k[0] == 1)
    assert small[2].min_volt_bins == min(len(r.volt) for k, r in got.items() if k[0] == 2)
    assert adaptive_histograms(df.limit(0)).count() == 0

from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import CURVE, curve_row, rows
from wattloom import operators
from wattloom.operators import (
    draw_rows,
    elbow_cost,
    hour_features,
    hour_group_curve,
    hour_groups,
    hourly_profile,
    label_hour_groups,
    store_curve,
)


def lloyd(points, seeds, rounds=21):
    """Plain Lloyd on one list of points: empty clusters vanish, ties go to the lowest index."""
    means = [points[s] for s in seeds]

    def nearest(p):
        return min(range(len(means)), key=lambda i: ((p[0] - means[i][0]) ** 2 + (p[1] - means[i][1]) ** 2, i))

    for _ in range(rounds):
        labels = [nearest(p) for p in points]
        kept = [i for i in range(len(means)) if i in labels]
        means = [tuple(np.mean([p for p, l in zip(points, labels) if l == i], axis=0)) for i in kept]
    labels = [nearest(p) for p in points]
    order = list(dict.fromkeys(labels))
    return [order.index(l) for l in labels]


def profile_of(spark, meters=12, seed=8):
    rng = np.random.default_rng(seed)
    data = []
    for m in range(1, meters + 1):
        for d in range(1, 97, (1, 2, 4)[m % 3]):
            data.append(curve_row(m, d, float(rng.uniform(200, 240)), float(rng.choice([0.1, 1.0, 5.0]) + rng.random())))
    # All points of one meter are equal, so five clusters vanish at once.
    data += [curve_row(99, d, 220.0, 1.0) for d in range(1, 97, 4)]
    curve = spark.createDataFrame(data, CURVE)
    return curve, hourly_profile(curve)


def by_meter(df, *columns):
    out = {}
    for r in df.orderBy("id", "hourindex").collect():
        out.setdefault(r.id, []).append(tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]])
    return out


def test_hour_groups_match_plain_lloyd(spark):
    _, profile = profile_of(spark)
    groups = by_meter(hour_groups(profile), "hourgroup")
    points = by_meter(hour_features(profile), "power", "volt")
    assert set(groups) == set(points) and len(groups) == 13
    for meter, labels in groups.items():
        assert labels == lloyd(points[meter], [0, 4, 8, 12, 16, 20]), meter
    assert groups[99] == [0] * 24


def test_batches_do_not_change_labels(spark):
    _, profile = profile_of(spark)
    whole = rows(hour_groups(profile))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        assert rows(hour_groups(profile)) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_seeded_start_is_repeatable(spark):
    _, profile = profile_of(spark)
    first = rows(hour_groups(profile, seed=1))
    assert first == rows(hour_groups(profile.repartition(3), seed=1))
    assert len(first) == 13 * 24 and all(0 <= r[3] < 6 for r in first)
    assert {r[3] for r in hour_groups(profile, k=2).collect()} <= {0, 1}


def test_more_runs_never_cost_more(spark):
    _, profile = profile_of(spark)
    features = {}
    for r in hour_features(profile).collect():
        features.setdefault((r.id, r.season, r.daytype), {})[r.hourindex] = (r.power, r.volt)

    def cost(groups):
        total = {}
        for key, hours in groups.items():
            for g in set(hours.values()):
                points = np.array([features[key][h] for h in hours if hours[h] == g])
                total[key] = total.get(key, 0.0) + ((points - points.mean(axis=0)) ** 2).sum()
        return total

    def run(runs):
        found = {}
        for r in hour_groups(profile, seed=5, runs=runs).collect():
            found.setdefault((r.id, r.season, r.daytype), {})[r.hourindex] = r.hourgroup
        return cost(found)

    one, many = run(1), run(6)
    assert set(one) == set(many) and all(many[k] <= one[k] + 1e-6 for k in one)
    assert any(many[k] < one[k] - 1e-6 for k in one)


def test_drawn_rows(spark):
    df = spark.range(5000).selectExpr("CAST(id % 3 AS STRING) AS g", "id AS item").union(
        spark.createDataFrame([("few", 1), ("few", 2)], "g string, item long")
    )
    drawn = draw_rows(df, ["g"], "item", 5, seed=1)
    assert {r.g: r["count"] for r in drawn.groupBy("g").count().collect()} == {"0": 5, "1": 5, "2": 5, "few": 2}
    assert rows(drawn) == rows(draw_rows(df.repartition(5), ["g"], "item", 5, seed=1))
    assert rows(drawn) != rows(draw_rows(df, ["g"], "item", 5, seed=2))
    assert "WindowGroupLimit" in drawn._jdf.queryExecution().executedPlan().toString()


def test_stored_curve_is_labelled_in_place(spark, tmp_path):
    curve, profile = profile_of(spark, meters=3)
    groups = hour_groups(profile).filter("id != 2")
    stored = store_curve(curve, "stored_curve_test", str(tmp_path / "curve"), buckets=3)
    try:
        labelled = label_hour_groups(stored, groups)
        assert rows(labelled.drop("hourindex")) == rows(label_hour_groups(curve, groups))
        assert rows(hour_group_curve(stored, groups)) == rows(hour_group_curve(curve, groups))
        settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
        for k, v in settings.items():
            spark.conf.set(k, v)
        try:
            plan = label_hour_groups(stored, groups)._jdf.queryExecution().executedPlan().toString()
        finally:
            for k in settings:
                spark.conf.unset(k)
        # The plan is printed from the top, the curve's scan first.
        assert "Exchange" not in plan[: plan.index("stored_curve_test")] and "SortMergeJoin" in plan
    finally:
        spark.sql("DROP TABLE stored_curve_test")


def test_labels_reach_every_curve_row(spark):
    curve, profile = profile_of(spark, meters=3)
    groups = hour_groups(profile).filter("id != 2")
    labelled = label_hour_groups(curve, groups)
    assert labelled.columns == [*curve.columns, "hourgroup"]
    assert labelled.count() == curve.count()
    assert {r.hourgroup for r in labelled.filter("id = 2").collect()} == {-1}
    wanted = {(r.id, r.hourindex): r.hourgroup for r in groups.collect()}
    for r in labelled.filter("id != 2").collect():
        assert r.hourgroup == wanted[(r.id, (r.dti - 1) % 96 // 4)]
    extract = hour_group_curve(curve, groups)
    assert extract.columns == ["id", "ts", "season", "daytype", "hourgroup", "power", "volt_c"]
    assert extract.count() == curve.filter("id != 2").count()
    # The last slot of the day, bucket 0, belongs to hour 23.
    assert extract.filter("hour(ts) = 23 AND minute(ts) = 45").count() > 0


def test_elbow_cost(spark):
    near = [(0.1 * i, 0.1 * i, 0.1 * i) for i in range(3)]
    far = [(9 + 0.1 * i,) * 3 for i in range(3)]
    points = spark.createDataFrame(near + far, "x double, y double, z double")
    cost = {r.k: r.cost for r in elbow_cost(points, ["x", "y", "z"], ks=[2, 3, 4]).collect()}
    assert abs(cost[2] - 0.12) < 1e-9 and all(c >= 0 for c in cost.values())


def brute_cost(points, k, rounds=20):
    """Lloyd's rounds over every point and centre."""
    x = np.array([[float(Decimal(v).quantize(Decimal("1e-12"))) for v in p] for p in points])
    low, high = x.min(axis=0), x.max(axis=0)
    centres = np.array([low + (i + 0.5) * (high - low) / k for i in range(k)])
    for _ in range(rounds):
        near = ((x[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.array([x[near == i].mean(axis=0) for i in range(len(centres)) if (near == i).any()])
    return ((x[:, None] - centres) ** 2).sum(axis=2).min(axis=1).sum()


@pytest.mark.parametrize("features", [1, 2, 3])
def test_elbow_cost_matches_brute_force(spark, features, monkeypatch):
    monkeypatch.setattr(operators.groups, "BLOCK_POINTS", 16)
    rng = np.random.default_rng(features)
    middles = rng.uniform(-50, 50, (4, features))
    points = [tuple(float(v) for v in rng.normal(middles[i % 4], 3)) for i in range(900)] + [(7.5,) * features] * 40
    names = [f"f{j}" for j in range(features)]
    df = spark.createDataFrame([*points, (None,) * features, (float("nan"),) * features], ", ".join(f"{n} double" for n in names))
    got = {r.k: r.cost for r in elbow_cost(df, names, ks=[1, 2, 4, 7]).collect()}
    for k, cost in got.items():
        assert cost == pytest.approx(brute_cost(points, k), rel=1e-9)
    assert {r.k: r.cost for r in elbow_cost(df.repartition(7), names, ks=[1, 2, 4, 7]).collect()} == got
    assert elbow_cost(df.limit(0), names).count() == 0
    assert [r.cost for r in elbow_cost(df.limit(0).union(spark.createDataFrame([(3.0,) * features], df.schema)), names).collect()] == [0.0] * 19

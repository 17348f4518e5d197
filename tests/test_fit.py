import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from wattloom.operators import fit, fit_curve


def frame(spark, groups):
    data = [(g, float(x), float(y)) for g, points in groups.items() for x, y in points]
    return spark.createDataFrame(data, "g string, volt_c double, power double")


@pytest.mark.parametrize("degree", [1, 2, 3, 4])
@pytest.mark.parametrize("origin", [0.0, 220.0])
def test_fit_matches_numpy(spark, degree, origin):
    rng = np.random.default_rng(degree)
    groups = {}
    for g in ("a", "b", "c"):
        x = np.round(rng.uniform(-3, 3, 60), 2) + origin
        groups[g] = list(zip(x, rng.normal(0, 1, 60) + 0.3 * (x - origin) ** 2))
    got = fit_curve(frame(spark, groups), ["g"], degree=degree).collect()
    assert len(got) == 3
    for r in got:
        x, y = map(np.array, zip(*groups[r.g]))
        want = np.polynomial.Polynomial.fit(x, y, degree)
        fitted = sum(r[f"c{n}"] * x**n for n in range(degree + 1))
        assert r.points == 60
        np.testing.assert_allclose(fitted, want(x), rtol=1e-5, atol=1e-5)


@pytest.mark.parametrize("degree", [1, 2, 3, 4])
def test_too_few_distinct_x_give_nulls(spark, degree):
    exact = [(200 + 3 * i, 1.0 + i) for i in range(degree + 1)]
    groups = {"short": [exact[i % degree] for i in range(20)], "enough": exact * 3}
    got = {r.g: r for r in fit_curve(frame(spark, groups), ["g"], degree=degree).collect()}
    names = [f"c{n}" for n in range(degree + 1)]
    assert all(got["short"][c] is None for c in names)
    assert all(got["enough"][c] is not None for c in names)
    fitted = [sum(got["enough"][c] * x**n for n, c in enumerate(names)) for x, _ in exact]
    np.testing.assert_allclose(fitted, [y for _, y in exact], rtol=1e-4)


def test_nulls_are_left_out(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 2.0), ("a", 2.0, 4.0), ("a", None, 9.0), ("a", 3.0, None)], "g string, volt_c double, power double"
    )
    (r,) = fit_curve(df, ["g"]).collect()
    assert r.points == 2 and abs(r.c0) < 1e-12 and abs(r.c1 - 2) < 1e-12


def test_close_points_are_still_distinct(spark):
    points = [(220.0, 1.0)] * 240 + [(220.0004, 3.0), (300.0, 2.0)]
    (r,) = fit_curve(frame(spark, {"a": points}), ["g"], degree=2).collect()
    assert r.points == 242 and r.c2 is not None
    fitted = [r.c0 + r.c1 * x + r.c2 * x * x for x in (220.0, 220.0004, 300.0)]
    np.testing.assert_allclose(fitted, [1.0, 3.0, 2.0], atol=0.05)


def test_null_group_and_narrow_band(spark):
    rng = np.random.default_rng(3)
    x = rng.uniform(229.5, 230.5, 500)
    data = [(None, float(a), float(np.sin(3 * a))) for a in x]
    df = spark.createDataFrame(data, "g string, volt_c double, power double")
    (r,) = fit_curve(df, ["g"], degree=3).collect()
    want = np.polynomial.Polynomial.fit(x, np.sin(3 * x), 3)(x)
    fitted = r.c0 + x * (r.c1 + x * (r.c2 + x * r.c3))
    np.testing.assert_allclose(fitted, want, atol=1e-6)


def test_parts_put_together_in_any_order(spark, monkeypatch):
    """Groups over many tasks and batches, and factors gathered a few at a time."""
    monkeypatch.setattr(fit, "HELD", 10)
    rng = np.random.default_rng(8)
    groups = {g: [(x, np.cos(x)) for x in rng.normal(100 * i, 1 + i, 400)] for i, g in enumerate("abcdefgh")}
    df = frame(spark, groups).repartition(6)
    whole = {r.g: r for r in fit_curve(df, ["g"], degree=3).collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        parts = {r.g: r for r in fit_curve(df, ["g"], degree=3).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for i, g in enumerate("abcdefgh"):
        x, y = map(np.array, zip(*groups[g]))
        want = np.polynomial.Polynomial.fit(x, y, 3)(x)
        for r in (whole[g], parts[g]):
            assert r.points == 400
            np.testing.assert_allclose(r.c0 + x * (r.c1 + x * (r.c2 + x * r.c3)), want, atol=1e-6 * 10**i)


def test_origin_and_no_group(spark):
    x = np.linspace(219.8, 220.3, 40)
    y = 2 + 3 * (x - 220) - 5 * (x - 220) ** 2 + 7 * (x - 220) ** 3
    df = frame(spark, {"a": zip(x, y)}).repartition(3)
    (r,) = fit_curve(df, [], degree=3, origin=220.0).collect()
    np.testing.assert_allclose([r.c0, r.c1, r.c2, r.c3], [2, 3, -5, 7], rtol=1e-8)
    assert fit_curve(df.limit(0), ["g"], degree=2).count() == 0


def test_rows_of_small_groups_travel_as_they_are(spark, monkeypatch):
    """Mixed rows of many groups: no part and no mostly empty tile for each; a large group is still parts."""
    rng = np.random.default_rng(5)
    tiles = []
    qr = np.linalg.qr
    monkeypatch.setattr(fit.np.linalg, "qr", lambda a, mode: tiles.append(a.size) or qr(a, mode=mode))
    g = np.concatenate([np.arange(1000).repeat(8), np.full(2000, 1000)])
    x = rng.uniform(200, 240, len(g))
    y = 3 - 2 * x + rng.normal(0, 1, len(g))
    mix = rng.permutation(len(g))
    batch = pa.record_batch({"g": g[mix], "_u": x[mix], "_v": y[mix]})
    records = pa.Table.from_batches(fit._parts(["g"], 3)(iter([batch])))
    assert records.num_rows == 8001 and records.filter(pc.is_valid(records["_part"]))["g"].to_pylist() == [1000]
    assert sum(tiles) < 4 * 5 * 2000
    records = records.sort_by("g")
    (whole,) = fit._whole(["g"], 3, 0.0)(iter(records.combine_chunks().to_batches()))
    assert whole.column("points").to_pylist() == [8] * 1000 + [2000] and sum(tiles) < 4 * 5 * len(g)

    df = spark.createDataFrame(zip(g.tolist(), x.tolist(), y.tolist()), "g long, volt_c double, power double").repartition(3)
    for held in (100, 100_000):
        monkeypatch.setattr(fit, "HELD", held)
        got = {r.g: r for r in fit_curve(df, ["g"], degree=1).collect()}
        assert len(got) == 1001
        for k in (0, 500, 1000):
            c1, c0 = np.polyfit(x[g == k], y[g == k], 1)
            assert got[k].points == (g == k).sum()
            np.testing.assert_allclose([got[k].c0, got[k].c1], [c0, c1], rtol=1e-9)

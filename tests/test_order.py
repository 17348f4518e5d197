import random

import pytest

from helpers import rows
from wattloom.operators import with_position


def test_positions_follow_the_order(spark):
    rng = random.Random(1)
    # A key that half of the rows share, nulls, and equal rows.
    data = [(rng.choice([7, 7, None, *range(40)]), rng.choice([None, *range(9)]), rng.choice("abc")) for _ in range(3000)]
    df = spark.createDataFrame(data, "b long, a int, c string").repartition(7)
    key = lambda r: [(v is not None, v or (0 if not isinstance(v, str) else "")) for v in (r[1], r[0], r[2])]
    got = sorted((tuple(r) for r in with_position(df, ["a"]).collect()), key=lambda r: r[3])
    assert got == [(*r, i) for i, r in enumerate(sorted(data, key=key))]
    placed = with_position(df, ["a", "b"], name="at")
    assert placed.columns == ["b", "a", "c", "at"]
    assert [r.at for r in placed.collect()] == list(range(3000))  # partitions are ranges, sorted inside


def test_no_task_holds_everything(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = with_position(spark.range(5000).selectExpr("id % 3 AS k", "id"), ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert "SinglePartition" not in placed._jdf.queryExecution().executedPlan().toString()
    sizes = placed.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
    assert sum(sizes) == 5000 and max(sizes) < 2500


def test_edges(spark):
    assert with_position(spark.range(0), ["id"]).count() == 0
    odd = spark.createDataFrame([(2, 1), (1, 1)], "`a.b` int, c int")
    assert rows(with_position(odd, ["a.b"])) == [(1, 1, 0), (2, 1, 1)]
    with pytest.raises(ValueError):
        with_position(spark.range(3).withColumnRenamed("id", "position"), ["position"])

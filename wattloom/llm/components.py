"""Connected components of an edge table by alternating stars, all in joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.store import keep

ROUNDS = 60


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return r.n, r.x


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for edges ``a, b`` (longs): the smallest node of each node's component.

    Only nodes on an edge between two different nodes appear. Each round ties every node and
    its neighbours to the smallest of them; the number of rounds follows the logarithm of the
    longest chain. Minima are combined before they are shuffled, and a node with very many
    neighbours is a skewed join key that Spark splits.
    """
    pair = (F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = keep(edges.where("a != b").select(*pair).distinct(), "edges")
    mark = _mark(edges)
    for _ in range(ROUNDS):
        if not mark[0]:
            break
        # Larger neighbours move to the smallest neighbour.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.min("a")).alias("m"))
        moved = both.join(least, F.col("a") == F.col("u")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.distinct()
        # Smaller neighbours and the node itself move to the smallest.
        least = moved.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        across = moved.join(least, F.col("a") == F.col("u")).where("b != m")
        stars = across.select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = stars.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        edges = keep(stars.distinct(), "edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())

"""Mixing sources to target weights: temperature, bisected exponent, block permutations."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from wattloom.llm.store import keep
from wattloom.llm.text import words

#: Blocks over all sources. A source has its share of them, one at least.
BLOCKS = 2**14
STEPS = 30
MAX_REPEATS = 2.0


def _bisect(fits: Callable[[float], bool]) -> float:
    """The largest number in 0..1 that fits, where smaller ones always fit; 0 if none does."""
    if fits(1.0):
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        middle = (low + high) / 2
        low, high = (middle, high) if fits(middle) else (low, middle)
    return low


def exponent(
    sources: DataFrame,
    *,
    entropy: float | None = None,
    max_repeats: float | None = None,
    reads: float | None = None,
) -> float:
    """Exponent for the shares of ``sources(share)`` that meets the target.

    ``entropy`` (nats): the largest exponent whose weights reach it, 0 if none does.
    ``max_repeats``: the smallest exponent that reads no source more than so many times as
    often as the source read least and, with ``reads``, the budget over the tokens of all
    sources, none more than so many times at all. Each step is one small aggregation; no list
    of sources reaches the driver.
    """
    shares = sources.where("share > 0")
    if (entropy is None) == (max_repeats is None):
        raise ValueError("give either an entropy or a repetition limit")

    def reached(a: float) -> float:
        weight = F.pow("share", F.lit(a))
        r = shares.agg(F.sum(weight).alias("s"), F.sum(weight * F.log(weight)).alias("t")).first()
        return math.inf if r.s is None else math.log(r.s) - r.t / r.s

    def repeats(a: float) -> float:
        each = F.pow("share", F.lit(a - 1))
        once = F.min(each)
        if reads is not None:
            once = F.least(once, F.sum(F.pow("share", F.lit(a))) / F.lit(reads))
        return shares.agg(F.coalesce(F.max(each) / once, F.lit(1.0))).first()[0]

    if entropy is not None:
        return _bisect(lambda a: reached(a) >= entropy)
    # The bound itself is met at exponent 1, but for rounding.
    return 1.0 - _bisect(lambda b: repeats(1.0 - b) <= max_repeats * (1 + 1e-12))


def _sized(docs: DataFrame) -> DataFrame:
    """``source, doc_id, n_tokens``, one row for each distinct pair; tokens of repeats add up."""
    counted = docs.select("source", "doc_id", F.size(words(F.col("text"))).cast("long").alias("n"))
    return counted.groupBy("source", "doc_id").agg(F.sum("n").alias("n_tokens"))


def source_budgets(
    sized: DataFrame,
    *,
    entropy: float | None = None,
    max_repeats: float | None = None,
    budget: int | None = None,
) -> DataFrame:
    """``source, tokens, share, weight, epochs, rest``: whole epochs and the tokens left over.

    Without ``budget`` it is the smallest that reads every source once, so nothing is dropped.
    ``max_repeats`` bounds how often a source is read, in all and against the source read least;
    a budget that no weights can spend within it is cut to ``max_repeats`` times all tokens. Sources without tokens are read once.
    A null source is one of its own.
    """
    totals = keep(sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "mix-sources")
    total = totals.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    shares = totals.withColumn("share", F.col("tokens") / F.lit(float(max(total, 1))))
    if budget is not None:
        budget = max(budget, 0) if max_repeats is None else min(max(budget, 0), max_repeats * total)
    reads = None if budget is None else max(budget, 1e-9) / max(total, 1)
    a = exponent(shares, entropy=entropy, max_repeats=max_repeats, reads=reads)
    raw = F.when(F.col("tokens") > 0, F.pow("share", F.lit(a))).otherwise(F.lit(0.0))
    norm = shares.agg(F.coalesce(F.sum(raw), F.lit(0.0))).first()[0] or 1.0
    weighted = shares.withColumn("weight", raw / F.lit(norm))
    if budget is None:
        once = weighted.where("tokens > 0").agg(F.coalesce(F.max(F.col("tokens") / F.col("weight")), F.lit(0.0)))
        budget = once.first()[0]
    often = F.col("weight") * F.lit(float(budget)) / F.col("tokens")
    # Rounding must not turn one whole epoch into none.
    epochs = F.when(F.col("tokens") > 0, F.floor(often + 1e-9)).otherwise(1).cast("int")
    rest = F.floor(F.col("weight") * F.lit(float(budget)) - F.col("epochs") * F.col("tokens"))
    rest = F.when(F.col("tokens") > 0, F.greatest(rest, F.lit(0))).otherwise(0).cast("long")
    return weighted.withColumn("epochs", epochs).withColumn("rest", rest)


def mix_sources(
    docs: DataFrame,
    *,
    entropy: float | None = None,
    max_repeats: float | None = None,
    budget: int | None = None,
) -> DataFrame:
    """The mix as rows ``doc_id, source, n_tokens, epoch, block_rank, seat``.

    Every epoch of a source reads its blocks in another order, and the documents of a block in
    another order. ``block_rank`` is the block's place in the epoch and ``seat`` the place in
    the block, both from 0. The last epoch of a source ends before the document that would
    overrun its tokens. A null source is a source of its own, a null doc_id an id; rows that
    share a source and a doc_id are one unit whose tokens add up. Empty texts ride along with
    their block. No window is wider than a block or the list of blocks.
    """
    sized = keep(_sized(docs), "mix-docs")
    budgets = keep(source_budgets(sized, entropy=entropy, max_repeats=max_repeats, budget=budget), "mix-budgets")
    plan = budgets.select(
        F.col("source").alias("of"),
        "epochs",
        "rest",
        F.ceil(F.greatest(F.col("share") * BLOCKS, F.lit(1.0))).cast("long").alias("n_blocks"),
    )
    blocked = sized.join(plan, sized["source"].eqNullSafe(plan["of"])).drop("of")
    blocked = blocked.withColumn("block", F.pmod(F.xxhash64("doc_id", "source"), F.col("n_blocks")))

    # The order of the blocks in each epoch; rows: blocks times epochs.
    blocks = blocked.groupBy("source", "block", "epochs", "rest").agg(F.sum("n_tokens").alias("block_tokens"))
    # A source whose budget is below a token is not read; a sequence to -1 would count down.
    runs = blocks.where("epochs > 0 OR rest > 0")
    runs = runs.withColumn("epoch", F.explode(F.expr("sequence(0, epochs - IF(rest = 0, 1, 0))")))
    drawn = F.xxhash64("block", "source", "epoch")
    in_epoch = W.Window.partitionBy("source", "epoch").orderBy(drawn, "block")
    runs = runs.select(
        F.col("source").alias("of"),
        F.col("block").alias("at"),
        "epoch",
        (F.col("epoch") == F.col("epochs")).alias("partial"),
        (F.row_number().over(in_epoch) - 1).alias("block_rank"),
        (F.sum("block_tokens").over(in_epoch) - F.col("block_tokens")).alias("before"),
    )
    runs = runs.join(plan.select(F.col("of").alias("whose"), F.col("rest").alias("left_over")),
                     F.col("of").eqNullSafe(F.col("whose"))).drop("whose")
    runs = runs.where("NOT partial OR before < left_over")

    same = blocked["source"].eqNullSafe(runs["of"]) & (blocked["block"] == runs["at"])
    rows = blocked.join(runs, same)
    in_block = W.Window.partitionBy("source", "block", "epoch").orderBy(F.xxhash64("doc_id", "epoch"), "doc_id")
    rows = rows.select(
        "doc_id",
        "source",
        "n_tokens",
        "epoch",
        "block_rank",
        (F.row_number().over(in_block) - 1).cast("long").alias("seat"),
        (F.col("before") + F.sum("n_tokens").over(in_block.rowsBetween(W.Window.unboundedPreceding, 0))).alias("upto"),
        "partial",
        "left_over",
    )
    return rows.where("NOT partial OR upto <= left_over").drop("upto", "partial", "left_over")


def mixed_documents(docs: DataFrame, **target) -> DataFrame:
    """The documents as often as the mix reads them, with all their columns whatever their names.

    Rows that share a source and a doc_id, nulls included, come equally often. An empty table
    stays empty.
    """
    reads = mix_sources(docs, **target).groupBy("source", "doc_id").count()
    reads = reads.select(F.col("source").alias("of"), F.col("doc_id").alias("id"), F.col("count").alias("often"))
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("row")
    rows = docs.select(F.col("source"), F.col("doc_id"), row)
    same = rows["source"].eqNullSafe(reads["of"]) & rows["doc_id"].eqNullSafe(reads["id"])
    often = rows.join(reads, same).withColumn("copy", F.explode(F.expr("sequence(1L, often)")))
    return often.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents, no source read more than twice as often as another."""
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"), max_repeats=MAX_REPEATS)

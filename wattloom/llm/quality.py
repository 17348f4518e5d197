"""Quality rules by weak supervision: rules vote or abstain, EM weighs them, posteriors decide."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.store import keep

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SYMBOLS = b"#*$%&|<>"
FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_stops long"
#: Frequent short words of four languages.
STOP_WORDS = frozenset(
    "the of and to in a is that it for was on are with as de la le les des et en un une du que qui dans pour par "
    "der die das und den von zu mit sich auf ist im dem el los las del se por con no una su al lo".encode().split()
)
ROUNDS = 100


def _measures(text: bytes) -> tuple[int, ...]:
    words = text.split()
    # Code points: bytes that do not continue one.
    data = np.frombuffer(b"".join(words), np.uint8)
    chars = int(((data & 0xC0) != 0x80).sum())
    lines = [line for line in text.split(b"\n") if line.split()]
    first: dict[tuple[bytes, ...], int] = {}
    covered = np.zeros(len(words) + 1, np.int64)
    for i, window in enumerate(zip(words, words[1:], words[2:], strict=False)):
        at = first.setdefault(window, i)
        if at != i:
            covered[at : at + 3] = 1
            covered[i : i + 3] = 1
    stops = sum(w.lower() in STOP_WORDS for w in words)
    symbols = sum(text.count(bytes([b])) for b in SYMBOLS)
    return len(words), chars, symbols, len(lines) - len(set(lines)), int(covered.sum()), len(lines), stops


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in FEATURES.split(", ")]
    for batch in batches:
        rows = [_measures(t.as_py() or b"") for t in batch.column("data")]
        columns = zip(*rows, strict=True) if rows else [[] for _ in names]
        out = {"doc_id": batch.column("doc_id")}
        yield pa.RecordBatch.from_pydict(out | {n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the measures of every row's text; null and empty texts measure 0."""
    kind = docs.select("doc_id").dtypes[0][1]
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("data"))
    return rows.mapInArrow(_features, f"doc_id {kind}, {FEATURES}")


def _rule(good: Column, bad: Column) -> Column:
    """1 for a vote of good, -1 for bad, 0 for abstaining."""
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("tinyint")


def votes() -> list[Column]:
    """The rules over the measures."""
    words, lines = F.col("n_words"), F.greatest(F.col("n_lines"), F.lit(1))
    chars = F.col("word_chars") / F.greatest(words, F.lit(1))
    symbols = F.col("n_symbols") / F.greatest(words, F.lit(1))
    repeats = F.col("n_repeat_words") / F.greatest(words, F.lit(1))
    copies = F.col("n_dup_lines") / lines
    stops = F.col("n_stops") / F.greatest(words, F.lit(1))
    return [
        _rule(words >= 80, words < 50),
        _rule((chars >= 3.5) & (chars <= 8), (chars < 2.5) | (chars > 11)),
        _rule(symbols < 0.02, symbols > 0.1),
        _rule(copies < 0.05, copies > 0.3),
        _rule(repeats < 0.1, repeats > 0.5),
        _rule(stops >= 0.1, stops < 0.02),
        _rule(words / lines >= 8, words / lines < 3),
    ]


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Posterior probability of good for each vote pattern.

    Rules are independent given the hidden class. Each has for either class a probability of
    voting good, bad or abstaining. It starts from the filter that all rules must pass; the
    prior keeps rules better than chance.
    """
    if not len(patterns):
        return np.empty(0)
    options = (-1, 0, 1)
    cast = np.stack([(patterns == o).astype(float) for o in options], axis=2)  # pattern, rule, option
    n = patterns.astype(float)
    posterior = np.where((n == -1).any(axis=1), 0.1, 0.95)
    # As if some documents had been voted on rightly: bad by the bad, good by the good.
    total = counts.sum()
    prior = np.array([[3.0, 2.0, 1.0], [1.0, 2.0, 3.0]]) * max(1.0, 0.002 * total)
    for _ in range(rounds):
        weight = np.stack([1 - posterior, posterior]) * counts
        share = (weight.sum(axis=1) + 1) / (weight.sum() + 2)
        table = np.einsum("cp,pro->cro", weight, cast) + prior[:, None, :]
        table /= table.sum(axis=2, keepdims=True)
        score = np.log(share)[:, None] + np.einsum("pro,cro->cp", cast, np.log(table))
        new = 1 / (1 + np.exp(np.clip(score[0] - score[1], -500, 500)))
        if np.abs(new - posterior).max() < 1e-10:
            return new
        posterior = new
    return posterior


def posterior_quality(measured: DataFrame, rules: Sequence[Column] | None = None) -> DataFrame:
    """``measured`` with ``quality``, the posterior probability that the document is good.

    Votes are counted by pattern over all documents; three options in each of seven rules make
    2187 patterns at most, and only they reach the driver. Rows vote one by one, so repeated
    rows count repeatedly. An empty table gives no rows.
    """
    rules = list(rules or votes())
    names = [f"vote_{i}" for i in range(len(rules))]
    voted = measured.select("*", *[r.alias(n) for r, n in zip(rules, names, strict=True)])
    found = voted.groupBy(*names).count().orderBy(*names).collect()
    patterns = np.array([r[:-1] for r in found], np.int64).reshape(len(found), len(rules))
    posterior = expectation_maximisation(patterns, np.array([r["count"] for r in found], float))
    rows = [(*map(int, p), float(q)) for p, q in zip(patterns, posterior, strict=True)]
    table = measured.sparkSession.createDataFrame(rows, ", ".join(f"{n} tinyint" for n in names) + ", quality double")
    return voted.join(F.broadcast(table), names).drop(*names)


def quality(docs: DataFrame) -> DataFrame:
    """Measures, ``base_failed`` and ``quality`` of every row; null and empty texts fail."""
    measured = posterior_quality(keep(measures(docs), "quality-measures"))
    short, repeated = F.col("n_words") < 50, 100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    return measured.withColumn("base_failed", short | repeated)


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Contract columns for all documents; kept at a posterior of a half or more."""
    judged = quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("quality") >= 0.5)).alias("kept"), "quality",
    )

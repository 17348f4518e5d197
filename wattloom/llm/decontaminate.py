"""Benchmark decontamination: training windows looked up in a broadcast set of test n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.store import keep
from wattloom.llm.text import ITEM_WORDS, lower_ascii, words

WINDOW = 13
#: Benchmark windows in one broadcast, some 60 MB.
BROADCAST_WINDOWS = 300_000


def _words(text: Column) -> Column:
    return words(lower_ascii(text), ITEM_WORDS)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows ``gram, items`` of a benchmark ``(item_id, text)``, ``gram`` an array of words.

    An item shorter than the window is one window; items without words have none. A null
    ``item_id`` counts as the empty id, and rows with the same id are one item.
    """
    item = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")
    tokens = benchmark.select(item, F.explode(F.array(_words(F.col("text")))).alias("tokens"))
    length = F.least(F.lit(window), F.size("tokens"))
    starts = F.sequence(F.lit(1), F.size("tokens") - length + 1)
    pieces = tokens.where("size(tokens) > 0").select(
        "item", F.explode(F.transform(starts, lambda i: F.slice("tokens", i, length))).alias("gram")
    )
    return pieces.groupBy("gram").agg(F.collect_set("item").alias("items"))


def _by_anchor(windows: DataFrame) -> DataFrame:
    """Windows ``(offset, gram, items)`` gathered under their longest word, which is likely rare."""
    longest = F.array_max(
        F.transform("gram", lambda w, i: F.struct(F.length(w).alias("n"), w.alias("word"), i.alias("at")))
    )
    placed = windows.select(longest.alias("longest"), "gram", "items")
    return placed.groupBy(F.col("longest.word").alias("word")).agg(
        F.collect_list(F.struct(F.col("longest.at").alias("offset"), "gram", "items")).alias("windows")
    )


def _parts(docs: DataFrame) -> DataFrame:
    """``doc_id, part, tokens``: equal rows are one part, other rows of a doc_id are parts of it."""
    # The generator keeps the optimizer from computing the words anew for every window.
    tokens = F.explode(F.array(_words(F.col("text")))).alias("tokens")
    return docs.select("doc_id", F.xxhash64("text").alias("part"), tokens)


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every benchmark window in the documents: ``doc_id, part, start, length, items``.

    ``start`` counts words from 0. The set of windows is broadcast, keyed by one word of each;
    at every document word that is such a key the windows around it are compared word by word.
    A set over the bound is broadcast in blocks, with a scan of the documents for each.

    Null and empty texts and items have no windows. Rows that share a doc_id are told apart by
    ``part``, a hash of the text; equal rows give their hits once. Items that share a window are
    all named. An empty table on either side gives no rows.
    """
    known = keep(benchmark_windows(benchmark, window), "benchmark-windows")
    blocks = max(1, -(-known.count() // BROADCAST_WINDOWS))
    found = None
    for block in range(blocks):
        part = known.where(F.pmod(F.xxhash64("gram"), F.lit(blocks)) == block) if blocks > 1 else known
        words_at = _parts(docs).select("doc_id", "part", "tokens", F.posexplode("tokens").alias("at", "word"))
        near = words_at.join(F.broadcast(_by_anchor(part)), "word")
        near = near.select("doc_id", "part", "tokens", "at", F.explode("windows").alias("w"))
        start, length = F.col("at") - F.col("w.offset"), F.size("w.gram")
        hits = near.where(start >= 0).where(F.slice("tokens", start + 1, length) == F.col("w.gram"))
        hits = hits.select("doc_id", "part", start.alias("start"), length.alias("length"), F.col("w.items").alias("items"))
        found = hits if found is None else found.unionByName(hits)
    return found


def _covered(spans: str) -> Column:
    every = F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))
    return F.array_distinct(every)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20) -> DataFrame:
    """One row per ``doc_id``: ``n_words, n_hit, items, contaminated``.

    A word inside any benchmark window is hit. A document is contaminated if it has a hit word
    and at least one in ``share`` of its words is hit. Null and empty texts have no words. Rows
    that share a doc_id (null too) are parts of one document; equal rows count once.
    """
    sizes = docs.select(
        "doc_id", F.xxhash64("text").alias("part"), F.size(_words(F.col("text"))).alias("n_words")
    )
    none = F.lit(None)
    rows = sizes.select(
        "*", none.cast("struct<start:int,length:int>").alias("span"), none.cast("array<string>").alias("items")
    ).unionByName(
        benchmark_hits(docs, benchmark, window).select(
            "doc_id", "part", F.lit(0).alias("n_words"), F.struct("start", "length").alias("span"), "items"
        )
    )
    # What a group collects is bounded by the words of one text.
    per_part = rows.groupBy("doc_id", "part").agg(
        F.max("n_words").alias("n_words"),
        F.collect_set("span").alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    per_doc = per_part.groupBy("doc_id").agg(
        F.sum(F.col("n_words").cast("long")).alias("n_words"),
        F.sum(F.size(_covered("spans")).cast("long")).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    bad = (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    return per_doc.withColumn("contaminated", bad)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20
) -> DataFrame:
    """The documents that are not contaminated, with all their columns.

    Null and empty texts stay. Rows that share a doc_id, a null one too, stay or go together. An
    empty benchmark takes nothing away.
    """
    bad = contamination(docs, benchmark, window, share).where("contaminated")
    bad = bad.select(F.col("doc_id").alias("contaminated_doc_id"))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["contaminated_doc_id"]), "left_anti")


def cut_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, text`` with hit words cut out; touched texts become their words joined by blanks.

    Texts without a hit, null and empty ones among them, stay as they are. Repeated rows each give
    a row, and overlapping spans are cut once.
    """
    hits = benchmark_hits(docs, benchmark, window).groupBy("doc_id", "part")
    hits = hits.agg(F.collect_set(F.struct("start", "length")).alias("spans"))
    hits = hits.select(F.col("doc_id").alias("hit_id"), F.col("part").alias("hit_part"), _covered("spans").alias("hit"))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("part"))
    same = texts["doc_id"].eqNullSafe(hits["hit_id"]) & (texts["part"] == hits["hit_part"])
    tokens = words(F.col("text"), ITEM_WORDS)
    rest = F.filter(tokens, lambda _, i: ~F.array_contains("hit", i))
    kept = F.when(F.col("hit").isNull(), F.col("text")).otherwise(F.concat_ws(" ", rest))
    return texts.join(hits, same, "left").select("doc_id", kept.alias("text"))


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    """Contract columns for all documents against the whole benchmark."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


OP4_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), b AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), g AS (
    SELECT DISTINCT item, len, list_slice(w, s, s + len - 1) AS gram
    FROM (SELECT item, w, least(13, len(w)) AS len, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS s
          FROM b WHERE len(w) > 0)
), t AS (
    SELECT doc_id, w, l.len AS len, unnest(generate_series(1, len(w) - l.len + 1)) AS s
    FROM d, (SELECT DISTINCT len FROM g) l
), h AS (
    SELECT doc_id, s, t.len AS len, item FROM t JOIN g ON g.len = t.len AND list_slice(w, s, s + t.len - 1) = g.gram
), n AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(s, s + len - 1)) AS p FROM h) GROUP BY doc_id
), i AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)
"""

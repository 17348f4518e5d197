"""Substring dedup: winnowed anchors as seeds, extended by hashes of the words around them.

A window of ``window`` words owns one anchor: its smallest run of ``SEED`` words. Equal windows
have equal anchors at equal places, so a repeated window is found among the occurrences of its
anchor. An occurrence stands for all neighbouring windows that own it, its span. Equal spans
repeat as a whole. Spans that share an anchor but differ are extended window by window.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from wattloom.llm.store import keep
from wattloom.llm.wordhash import Hasher, chunks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW, SEED = 20, 6


def _earlier_first(keys: list[np.ndarray], ids: pa.Array, rows: np.ndarray, parts: np.ndarray, starts: np.ndarray):
    """Order by key and place, and for each ordered item whether an earlier one has its key.

    Items of equal rows (the same id, part and start) do not precede each other. A null id
    comes first.
    """
    known = np.asarray(ids.is_valid())[rows]
    number = np.asarray(ids.fill_null(0))[rows]
    order = np.lexsort([starts, parts, number, known, *keys])
    place = [a[order] for a in (known, number, parts, starts)]
    new_key = np.ones(len(order), bool)
    new_key[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    lead = np.maximum.accumulate(np.where(new_key, np.arange(len(order)), 0))
    later = np.logical_or.reduce([p != p[lead] for p in place])
    repeat = ~new_key & ~later  # an equal row's copy of the first
    return order, later, repeat


def _spans(hasher: Hasher, data: np.ndarray, offsets: np.ndarray, window: int):
    """Anchor occurrences of a run of texts: text, first window, windows, anchor, span hash."""
    words = hasher.words(data, offsets)
    n = len(words.hashes)
    if n < window:
        return None
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(words.first))
    valid = np.flatnonzero(text[: n - window + 1] == text[window - 1 :])
    if not len(valid):
        return None
    seeds = hasher.runs(words.hashes, SEED)
    reach = window - SEED + 1
    least = np.lib.stride_tricks.sliding_window_view(seeds, reach).argmin(axis=1)[valid] + valid
    edge = np.flatnonzero(np.diff(least)) + 1
    first, last = np.concatenate([[0], edge]), np.concatenate([edge - 1, [len(valid) - 1]])
    begin, end = valid[first], valid[last]
    span = hasher.spans(words.hashes, begin, end + window, 1)
    return text[begin], begin - words.first[text[begin]], end - begin + 1, seeds[least[first]], span


def _occurrences(window: int, repeated: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per batch, the first occurrence of each anchor and span, or else all later ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(lower=False)
        for batch in batches:
            found = []
            for at, _, data, offsets in chunks(batch.column("data")):
                if (spans := _spans(hasher, data, offsets, window)) is not None:
                    found.append((spans[0] + at, *spans[1:]))
            if not found:
                continue
            row, start, size, anchor, span = (np.concatenate(x) for x in zip(*found, strict=True))
            part = np.asarray(batch.column("part"))[row]
            order, later, repeat = _earlier_first([span, anchor], batch.column("doc_id"), row, part, start)
            take = order[later] if repeated else order[~later & ~repeat]
            out = {"doc_id": batch.column("doc_id").take(pa.array(row[take])), "part": pa.array(part[take])}
            out |= {"start": pa.array(start[take].astype(np.int32)), "size": pa.array(size[take].astype(np.int32))}
            if not repeated:
                out |= {"anchor": pa.array(anchor[take].view(np.int64)), "span": pa.array(span[take].view(np.int64))}
            yield pa.RecordBatch.from_pydict(out)

    return run


def _windows(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The single windows of the spans of each text, by two hashes.

    Windows with an earlier equal one in the batch are known repeats. They get a key of their
    own, so that no key gathers more rows than there are batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(lower=False)
        for batch in batches:
            spans = batch.column("spans").to_pylist()
            found = []
            for at, upto, data, offsets in chunks(batch.column("data")):
                words = hasher.words(data, offsets)
                one, two = (hasher.runs(words.hashes, window, which) for which in (0, 1))
                for i in range(at, upto):
                    starts = np.unique(np.concatenate([np.arange(s["start"], s["start"] + s["size"]) for s in spans[i]]))
                    here = starts + words.first[i - at]
                    found.append((np.full(len(starts), i), starts, one[here], two[here]))
            if not found:
                continue
            row, start, one, two = (np.concatenate(x) for x in zip(*found, strict=True))
            part = np.asarray(batch.column("part"))[row]
            order, later, repeat = _earlier_first([two, one], batch.column("doc_id"), row, part, start)
            take, later = order[~repeat], later[~repeat]
            one, two = one[take].view(np.int64), two[take].view(np.int64)
            own = row[take] * np.int64(1 << 32) + start[take]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").take(pa.array(row[take])),
                    "part": pa.array(part[take]),
                    "start": pa.array(start[take].astype(np.int32)),
                    "one": pa.array(np.where(later, own, one)),
                    "two": pa.array(np.where(later, part[take], two)),
                    "later": pa.array(later),
                }
            )

    return run


def _cut(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column("data"), batch.column("spans").to_pylist()
            counts, removed, kept = [], [], []
            for text, cuts in zip(texts, spans, strict=True):
                words = (text.as_py() or b"").split()
                counts.append(len(words))
                if cuts:
                    edges = np.zeros(len(words) + 1, np.int64)
                    for c in cuts:
                        edges[c["start"]] += 1
                        edges[c["start"] + c["size"] + window - 1] -= 1
                    stay = np.flatnonzero(np.cumsum(edges[:-1]) == 0)
                    words = [words[i] for i in stay]
                removed.append(counts[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_words": pa.array(counts, pa.int64()),
                    "n_removed": pa.array(removed, pa.int64()),
                    "kept": pa.array(kept, pa.binary()),
                }
            )

    return run


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = [hashlib.sha256(x.as_py()).hexdigest() for x in batch.column("kept")]
        yield pa.RecordBatch.from_pydict(
            {n: batch.column(n) for n in ("doc_id", "n_words", "n_removed")}
            | {"kept_sha256": pa.array(digests, pa.string())}
        )


PLACE = "doc_id {}, part long, start int"


def _sources(docs: DataFrame) -> tuple[DataFrame, str]:
    kind = docs.select("doc_id").dtypes[0][1]
    if kind not in ("int", "bigint"):
        raise TypeError("doc_id must be an integer")
    data = F.coalesce("text", F.lit("")).cast("binary")
    # Null ids are marked in the part, so that rows can be matched by plain equality.
    part = F.crc32(data) + F.when(F.col("doc_id").isNull(), F.lit(1 << 33)).otherwise(F.lit(0))
    return docs.select("doc_id", part.alias("part"), data.alias("data")), kind


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, part, start, size``: runs of ``size`` windows that all begin earlier too.

    Earlier means a smaller doc_id, or the same row and an earlier word; among rows that share
    a doc_id the smaller checksum (``part``) of the text is earlier, and equal rows do not
    precede each other. Null ids precede all others. Runs may overlap.
    """
    rows, kind = _sources(docs)
    place = PLACE.format(kind)
    firsts = rows.mapInArrow(_occurrences(window, False), f"{place}, size int, anchor long, span long")
    in_batch = rows.mapInArrow(_occurrences(window, True), f"{place}, size int")

    # Anchors that occur once cannot repeat.
    shared = firsts.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    found = firsts.join(shared, "anchor").repartition("anchor", "span")
    by_place = (F.asc_nulls_first("doc_id"), F.asc("part"), F.asc("start"))
    lead = F.struct("doc_id", "part", "start")
    # A key has one row per batch at most.
    same_span = W.Window.partitionBy("anchor", "span")
    later = (~lead.eqNullSafe(F.first(lead).over(same_span.orderBy(*by_place)))).alias("later")
    # Whether the anchor also has another span.
    differ = (F.count("*").over(same_span) < F.col("n")).alias("differ")
    # Written once, since both whole and extended spans come from it.
    ranked = keep(found.select("doc_id", "part", "start", "size", differ, later), "spans")
    whole = ranked.where("later").select("doc_id", "part", "start", "size")

    texts = _by_row(rows).join(_spans_of(ranked.where("NOT later AND differ")), ["row", "part"])
    single = texts.select("doc_id", "part", "data", "spans").mapInArrow(
        _windows(window), f"{place}, one long, two long, later boolean"
    )
    in_window = W.Window.partitionBy("one", "two").orderBy(*by_place)
    ranked = single.select(
        "doc_id", "part", "start", F.lit(1).alias("size"),
        (F.col("later") | ~lead.eqNullSafe(F.first(lead).over(in_window))).alias("again"),
    )
    return in_batch.unionByName(whole).unionByName(ranked.where("again").drop("again"))


def _by_row(rows: DataFrame) -> DataFrame:
    """The texts dealt by row; both joins that need them share this shuffle."""
    return rows.withColumn("row", F.coalesce("doc_id", F.lit(0))).repartition("row", "part")


def _spans_of(places: DataFrame) -> DataFrame:
    """The distinct spans of each row, whose number the text bounds."""
    by_row = places.groupBy(F.coalesce("doc_id", F.lit(0)).alias("row"), "part")
    return by_row.agg(F.collect_set(F.struct("start", "size")).alias("spans"))


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: every text without the words of repeated windows.

    A word goes if a window that covers it begins earlier as well, judged on the input.
    ``kept`` are the words that stay, joined by single blanks, as UTF-8. Null and empty texts
    have no words; texts shorter than the window stay. Repeated rows each give a row.
    """
    rows, kind = _sources(docs)
    texts = _by_row(rows).join(_spans_of(repeated_spans(docs, window)), ["row", "part"], "left")
    return texts.select("doc_id", "data", "spans").mapInArrow(
        _cut(window), f"doc_id {kind}, n_words long, n_removed long, kept binary"
    )


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract columns for all documents."""
    kept = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    kind = dict(kept.dtypes)["doc_id"]
    return kept.mapInArrow(_digest, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")


OP10_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), t AS (
    SELECT doc_id, unnest(generate_series(1, len(w) - 19)) AS s,
           unnest(list_transform(generate_series(1, len(w) - 19), lambda i: md5(array_to_string(w[i:i + 19], ' ')))) AS gram
    FROM d WHERE len(w) >= 20
), g AS (
    SELECT doc_id, s, row_number() OVER (PARTITION BY gram ORDER BY doc_id, s) AS nth FROM t
), r AS (
    SELECT DISTINCT doc_id, unnest(generate_series(s, s + 19)) AS p FROM g WHERE nth > 1
), k AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept
    FROM (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d)
    ANTI JOIN r USING (doc_id, p) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM r GROUP BY doc_id) USING (doc_id)
"""

"""Phrase collocations by prefix-free parsing.

Texts are read as rows of symbols, words and marks between pieces. A window of symbols whose hash
is divisible by ``MODULUS`` triggers a cut, so equal passages are cut alike wherever they stand.
Chunks run from one trigger window to the end of the next and overlap by that window. The distinct
chunks with their frequencies are a dictionary, from which word runs are counted: a run belongs to
the chunk in which it starts before the overlap, so each occurrence counts once.

Runs are counted shortest first. A longer run can only be frequent if both runs inside it are, and
a bitmap of fixed size over the hashes of the frequent ones lets the others pass unseen.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.store import keep
from wattloom.llm.wordhash import BLANKS, Hasher, chunks, mix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LONGEST, LEAST, TOP = 4, 30, 2000
#: One symbol in so many begins a chunk.
MODULUS = 32
#: Bytes between the pieces of a text; blanks and tabs stand between words.
MARKS = b".,;:!?\x0a\x0b\x0c\x0d"
#: Bytes of text that a task combines at a time.
GATHER = 2 << 20
#: Bits of the bitmap over frequent runs, as a power of two: 8 MB whatever the corpus.
FILTER_BITS = 26
#: Parts in which the phrases of a language are ranked before the last ranking.
RANK_PARTS = 64


def _ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers ``begin[i] .. begin[i] + length[i] - 1``, one range after the other."""
    ends = np.cumsum(length)
    return np.repeat(begin - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)


def _slices(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """Parts of a byte array as strings."""
    length = end - begin
    offsets = np.zeros(len(begin) + 1, np.int64)
    np.cumsum(length, out=offsets[1:])
    taken = data[_ranges(begin, length)]
    return pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(taken))).cast(pa.string())


def _lang_hash(lang: str) -> np.uint64:
    return np.frombuffer(hashlib.md5(lang.encode()).digest()[:8], np.uint64)[0]


def _lang_hashes(langs: list[str], known: dict[str, np.uint64]) -> np.ndarray:
    return np.array([known.setdefault(x, _lang_hash(x)) for x in langs], np.uint64)


def _parser(overlap: int, modulus: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(lower=True, blanks=BLANKS + MARKS)
        mark = np.zeros(256, bool)
        mark[list(MARKS)] = True
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        known: dict[str, np.uint64] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for at, upto, data, offsets in chunks(batch.column("data"), GATHER):
                words = hasher.words(data, offsets)
                n, texts = len(words.begin), upto - at
                if not n:
                    continue
                text = np.repeat(np.arange(texts), np.diff(words.first))
                marks = np.zeros(len(data) + 1, np.int64)
                np.cumsum(mark[data], out=marks[1:])
                inside = text[1:] == text[:-1]
                parted = inside & (marks[words.begin[1:]] > marks[words.end[:-1]])
                # Symbols: the words, and a mark after each word that ends a piece before the next.
                place = np.arange(n)
                place[1:] += np.cumsum(parted)
                total = place[-1] + 1
                symbols = np.full(total, 0x5851F42D4C957F2D, np.uint64)
                symbols[place] = words.hashes
                size = np.ones(total, np.int64)
                size[place] = words.end - words.begin
                begin = np.cumsum(size + 1) - (size + 1)
                end = begin + size
                out = np.full(end[-1] + 1, 32, np.uint8)
                is_word = np.zeros(total, bool)
                is_word[place] = True
                out[begin[~is_word]] = 46
                out[_ranges(begin[place], size[place])] = lower[data[~hasher.blank[data]]]
                of = np.empty(total, np.int64)
                of[place] = text
                of[~is_word] = text[:-1][parted]
                # A chunk begins with a text and with a trigger window inside one.
                starts = np.ones(total, bool)
                starts[1:] = of[1:] != of[:-1]
                edges = np.append(np.flatnonzero(starts), total)
                triggers = hasher.runs(symbols, overlap)
                if len(triggers):
                    hit = (triggers >> np.uint64(32)) % np.uint64(modulus) == 0
                    hit &= of[: len(hit)] == of[overlap - 1 :]
                    starts[: len(hit)] |= hit
                first = np.flatnonzero(starts)
                following = np.append(first[1:], total)
                final = np.isin(following, edges)
                last = np.where(final, following, np.minimum(following + overlap, total))
                owned = np.concatenate([[0], np.cumsum(is_word)])
                own = owned[following] - owned[first]
                tongue = _lang_hashes(langs[at:upto], known)[of[first]]
                key = mix(hasher.spans(symbols, first, last) + tongue + final.astype(np.uint64))
                _, one, times = np.unique(key, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([langs[at + i] for i in of[first[one]]], pa.string()),
                        "chunk": _slices(out, begin[first[one]], end[last[one] - 1]),
                        "final": pa.array(final[one]),
                        "own": pa.array(own[one]),
                        "n": pa.array(times),
                    }
                )

    return run


def parse(texts: DataFrame, *, longest: int = LONGEST, modulus: int = MODULUS) -> DataFrame:
    """The dictionary of a corpus ``lang, text``: ``lang, chunk, final, own, n``.

    A chunk is written as its words and ``.`` for the marks between pieces, with single blanks.
    ``final`` chunks end with their text; the others end with ``longest - 1`` symbols that the
    next chunk begins with. ``own`` counts the words before these, ``n`` the occurrences.
    """
    rows = texts.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("data"))
    found = rows.mapInArrow(
        _parser(max(longest - 1, 1), modulus), "lang string, chunk string, final boolean, own long, n long"
    )
    return found.groupBy("lang", "chunk", "final").agg(F.min("own").alias("own"), F.sum("n").alias("n"))


def _combined(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, where each stands, and the sum of its times."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], order[first], np.add.reduceat(times[order], first)


def _marked(bitmap: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    cell = keys >> np.uint64(64 - bits)
    return (bitmap[cell >> np.uint64(6)] >> (cell & np.uint64(63)) & np.uint64(1)).astype(bool)


class _Rows:
    """Words of some rows of the dictionary, and the keys of the runs that they own."""

    def __init__(self, hasher: Hasher, data: np.ndarray, offsets: np.ndarray, final: np.ndarray, tongues: np.ndarray, overlap: int):
        self.hasher, self.words = hasher, hasher.words(data, offsets)
        words = self.words
        self.row = np.repeat(np.arange(len(final)), np.diff(words.first))
        self.bound = words.first[1:] - np.where(final, 0, overlap)
        self.marks = np.zeros(len(words.begin) + 1, np.int64)
        np.cumsum((words.end - words.begin == 1) & (data[words.begin] == 46), out=self.marks[1:])
        self.tongue = tongues[self.row]

    def keys(self, k: int) -> np.ndarray:
        """A number for the run of ``k`` words from each word, by language."""
        return mix(self.hasher.runs(self.words.hashes, k) + self.tongue[: len(self.tongue) - k + 1])

    def whole(self, k: int) -> np.ndarray:
        """Whether these runs lie in one piece and belong to their row."""
        m = len(self.row) - k + 1
        inside = (self.row[:m] == self.row[k - 1 :]) & (self.marks[k:] == self.marks[:m])
        return inside & (np.arange(m) < self.bound[self.row[:m]])


def _read(batches: Iterator[pa.RecordBatch], overlap: int) -> Iterator[tuple[_Rows, np.ndarray, list[str], np.ndarray]]:
    """Rows, times by row, languages by row, and the bytes of runs of dictionary rows."""
    hasher, known = Hasher(lower=False, blanks=b" "), {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        final = batch.column("final").to_numpy(zero_copy_only=False)
        times = batch.column("n").to_numpy()
        for at, upto, data, offsets in chunks(batch.column("data"), GATHER):
            tongues = _lang_hashes(langs[at:upto], known)
            yield _Rows(hasher, data, offsets, final[at:upto], tongues, overlap), times[at:upto], langs[at:upto], data


def _key_counter(k: int, overlap: int, bitmap: np.ndarray | None, bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``key, f`` of the runs of ``k`` words whose two shorter runs are in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, times, _, _ in _read(batches, overlap):
            if len(rows.row) < k:
                continue
            fits = rows.whole(k)
            if bitmap is not None:
                frequent = _marked(bitmap, rows.keys(k - 1), bits)
                fits &= frequent[:-1] & frequent[1:]
            at = np.flatnonzero(fits)
            if len(at):
                keys, _, f = _combined(rows.keys(k)[at], times[rows.row[at]])
                yield pa.RecordBatch.from_pydict({"key": pa.array(keys.view(np.int64)), "f": pa.array(f)})

    return run


def _speller(overlap: int, bitmaps: list[np.ndarray], bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``lang, k, phrase, f`` of the runs whose key is in the bitmap of their length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, times, langs, data in _read(batches, overlap):
            words = rows.words
            for k, bitmap in enumerate(bitmaps, 1):
                if len(rows.row) < k:
                    continue
                keys = rows.keys(k)
                at = np.flatnonzero(rows.whole(k) & _marked(bitmap, keys, bits))
                if not len(at):
                    continue
                _, one, f = _combined(keys[at], times[rows.row[at]])
                one = at[one]
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([langs[i] for i in rows.row[one]], pa.string()),
                        "k": pa.array(np.full(len(one), k, np.int32)),
                        "phrase": _slices(data, words.begin[one], words.end[one + k - 1]),
                        "f": pa.array(f),
                    }
                )

    return run


def _bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """A bit for every cell that a key falls in; ``2**bits`` bits at any size."""
    cell = F.shiftrightunsigned("key", 64 - bits)
    words = keys.groupBy(F.shiftright(cell, 6).alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), cell.bitwiseAND(63).cast("int"))).alias("bits")
    )
    found = words.toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def frequent_runs(
    dictionary: DataFrame, *, longest: int = LONGEST, least: int = LEAST, bits: int = FILTER_BITS
) -> DataFrame:
    """``lang, k, phrase, f`` of the runs of ``k`` = 1, 2 .. ``longest`` words seen ``least`` times or more.

    Runs are counted by 64-bit keys, a pass for each length; one more pass spells those whose key
    is in a cell of a frequent one, and their texts decide.
    """
    rows = dictionary.select("lang", F.col("chunk").cast("binary").alias("data"), "final", "n")
    overlap, bitmaps = max(longest - 1, 1), []
    for k in range(1, longest + 1):
        counter = _key_counter(k, overlap, bitmaps[-1] if bitmaps else None, bits)
        counted = rows.mapInArrow(counter, "key long, f long").groupBy("key").agg(F.sum("f").alias("f"))
        bitmaps.append(_bitmap(counted.where(F.col("f") >= least), bits))
    spelled = rows.mapInArrow(_speller(overlap, bitmaps, bits), "lang string, k int, phrase string, f long")
    return spelled.groupBy("lang", "k", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def collocations(
    texts: DataFrame, *, longest: int = LONGEST, least: int = LEAST, top: int = TOP, modulus: int = MODULUS
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends and into words at
    blanks and tabs; a null text is empty, a null ``lang`` is ``und``. ``n`` counts a language's
    words, ``a`` a phrase's occurrences inside pieces. A phrase of 2 to ``longest`` words with
    ``least`` occurrences or more is cut in two, its parts occur ``l`` and ``r`` times, and
    ``floor(2000000 * a / (l + r))`` of the worst cut is its score (of equal ones the earliest). A
    phrase inside a longer one that occurs at least 80 percent as often is left out.

    Ranked by score and occurrences, both descending, then by the phrase's bytes; no two rows tie.
    Repeated rows count as often as they come. Other columns are ignored. An empty table gives
    none. Counts are exact integers, compared in decimals of 38 digits; runs are put together by
    their text, and 64-bit hashes tell them apart inside one batch of a task.
    """
    dictionary = keep(parse(texts, longest=longest, modulus=modulus), "dictionary")
    every = keep(frequent_runs(dictionary, longest=longest, least=least), "frequent-runs")
    words = dictionary.groupBy("lang").agg(F.sum(F.col("own") * F.col("n")).alias("n"))

    longer = every.where("k > 1").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"), "k")

    at = F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    cuts = longer.select("lang", "phrase", "a", "w", "k", at).select(
        "lang", "phrase", "a", "cut",
        F.array_join(F.slice("w", 1, F.col("cut")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("right"),
    )
    of = lambda part, name: every.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
    cuts = cuts.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"])
    # ``div`` on decimals divides whole numbers exactly.
    score = F.expr("(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(20,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    worst = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("worst")
    )

    spans = F.explode(F.expr(
        "flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), s -> array_join(slice(w, s, m), ' '))))"
    )).alias("phrase")
    inside = longer.where("k > 2").select("lang", spans, F.col("a").alias("f"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = worst.join(inside, ["lang", "phrase"], "left")
    ample = 100 * F.col("longer").cast("decimal(20,0)") >= 80 * F.col("a").cast("decimal(20,0)")
    kept = kept.where(F.col("longer").isNull() | ~ample)
    kept = kept.select("lang", "phrase", "a", F.col("worst.l").alias("l"), F.col("worst.r").alias("r"), F.col("worst.score").alias("score"))

    # A language may own most phrases, so each part of it is cut to the length of the report first.
    by = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)).alias("part")
    ranked = kept.select("*", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*by)))
    ranked = ranked.where(F.col("rank") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by))).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def op13_phrases(spark, sf_dir: str) -> DataFrame:
    """Contract columns for all documents."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents WHERE text IS NOT NULL
), w AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), g AS (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda s: list_slice(w, s, s + k - 1))) AS g
    FROM w, range(1, 5) t(k) WHERE len(w) >= k
), f AS (
    SELECT lang, k, g, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY ALL
), total AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang
), cand AS (
    SELECT * FROM f WHERE k > 1 AND f >= 30
), cuts AS (
    SELECT c.lang, c.g, c.f AS a, i, x.f AS l, y.f AS r, 2000000 * c.f // (x.f + y.f) AS score
    FROM (SELECT *, unnest(range(1, k)) AS i FROM cand) c
    JOIN f x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, i)
    JOIN f y ON y.lang = c.lang AND y.g = list_slice(c.g, i + 1, c.k)
), worst AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, i) = 1
), inner_parts AS (
    SELECT lang, list_slice(g, s, s + m - 1) AS g, f FROM (
        SELECT *, unnest(range(1, k - m + 2)) AS s FROM (SELECT *, unnest(range(2, k)) AS m FROM cand WHERE k > 2)
    )
), longer AS (
    SELECT lang, g, max(f) AS f FROM inner_parts GROUP BY ALL
), kept AS (
    SELECT w.*, array_to_string(w.g, ' ') AS phrase FROM worst w LEFT JOIN longer USING (lang, g)
    WHERE longer.f IS NULL OR 100 * longer.f < 80 * w.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
    CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM kept JOIN total USING (lang) QUALIFY rank <= 2000
"""

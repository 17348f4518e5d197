"""Toxicity by compression distance: two zstandard dictionaries, one of toxic and one of ordinary text.

Both dictionaries hold the same frequent words, so they differ only in what is typical of one
side. Windows are single words. Each is compressed with both, and the lengths that the toxic
dictionary saves, counted at several thresholds, are calibrated to a probability.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Labelled documents that the dictionaries are trained on, at most, by a hash of doc_id.
TOXIC_SAMPLE, ORDINARY_SAMPLE = 1000, 2000
#: A longer text is scored like any other but left out of the sample, which so is bounded in bytes.
SAMPLE_BYTES = 1 << 17
#: Typical word beginnings per dictionary, and frequent words in both.
TYPICAL, FREQUENT = 64, 600
#: Saved bytes at which windows are counted.
STEPS = (2, 4, 6, 7, 8, 9, 10, 12)
#: Longest window; longer words are several windows.
WINDOW = 48
#: Words whose saving a task remembers.
CACHE = 200_000
LEVEL, WIDTH = 6, 3
#: Bytes before each window, in both dictionaries, that absorb the cost of a first match.
LEAD = bytes(range(1, 13))


def widen(text: bytes) -> bytes:
    """Each byte as ``WIDTH`` bytes that depend on it and the one before.

    A match of few letters then pays for itself, as zstandard matches need some bytes.
    """
    now = np.frombuffer(text, np.uint8).astype(np.uint32)
    before = np.concatenate([[32], now[:-1]]).astype(np.uint32)
    out = np.empty(len(now) * WIDTH, np.uint8)
    out[0::WIDTH] = now
    for i in range(1, WIDTH):
        out[i::WIDTH] = (now * (167 + 22 * i) + before * (59 + 44 * i) + 77 * i) % 65536 % 251
    return out.tobytes()


@dataclass
class Dictionaries:
    """Content of both dictionaries and the calibration."""

    toxic: bytes = b""
    ordinary: bytes = b""
    weights: list[float] = field(default_factory=list)


class Scorer:
    """Features of texts under a pair of dictionaries."""

    def __init__(self, model: Dictionaries):
        def compressor(content: bytes) -> zstandard.ZstdCompressor:
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            plain = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, **plain)

        self.model = model
        self.toxic, self.ordinary = compressor(model.toxic), compressor(model.ordinary)
        self.saved: dict[bytes, int] = {}

    def _learn(self, windows: list[bytes]) -> None:
        wide = widen(b"".join(b" " + w + b" " for w in windows))
        ends = np.cumsum([WIDTH * (len(w) + 2) for w in windows]).tolist()
        data = [LEAD + wide[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        toxic, ordinary = (c.multi_compress_to_buffer(data) for c in (self.toxic, self.ordinary))
        for i, w in enumerate(windows):
            self.saved[w] = len(ordinary[i]) - len(toxic[i])

    def features(self, texts: list[bytes | None]) -> np.ndarray:
        rows = np.zeros((len(texts), len(STEPS) + 2))
        for i, text in enumerate(texts):
            windows = _windows(text)
            distinct = set(windows)
            if len(self.saved) + len(distinct) > CACHE:
                self.saved.clear()
            if new := distinct.difference(self.saved):
                self._learn(list(new))
            savings = np.sort(np.fromiter((self.saved[w] for w in windows), np.int64, len(windows)))
            rows[i, 0] = 1.0
            rows[i, 1] = math.log1p(len(windows))
            rows[i, 2:] = np.log1p(len(windows) - np.searchsorted(savings, STEPS))
        return rows

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        if not self.model.weights:
            return np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ np.array(self.model.weights), -40, 40)))


def _windows(text: bytes | None) -> list[bytes]:
    words = (text or b"").lower().split()
    if any(len(w) > WINDOW for w in words):
        words = [w[i : i + WINDOW] for w in words for i in range(0, len(w), WINDOW)]
    return words


def _without_copies(texts: list[bytes]) -> list[list[bytes]]:
    """Words of the texts that share few runs of three words with those before."""
    seen: set[int] = set()
    same: dict[bytes, bytes] = {}
    kept = []
    for text in texts:
        words = [same.setdefault(w, w) for w in _windows(text)]
        runs = {hash(tuple(words[i : i + 3])) for i in range(max(1, len(words) - 2))}
        some = {r for r in runs if r % 8 == 0} or runs
        if words and 5 * len(some & seen) <= len(some):
            kept.append(words)
        seen |= some
    return kept


def _beginnings(texts: list[list[bytes]], n: int, wanted: set[bytes] | None = None) -> Counter:
    """In how many texts a word begins so, over beginnings of ``n`` bytes."""
    counts: Counter = Counter()
    for words in texts:
        found = {w[:n] for w in words if len(w) >= n}
        counts.update(found if wanted is None else found & wanted)
    return counts


def _typical(mine: list[list[bytes]], other: list[list[bytes]]) -> list[bytes]:
    """Word beginnings of 4 to 12 bytes more frequent in one class than chance allows, the most so first."""
    n, m = len(mine), len(other)

    def z(a: int, b: int) -> float:
        p = (a + b) / (n + m)
        return (a / n - b / m) / math.sqrt(p * (1 - p) * (1 / n + 1 / m) + 1e-12)

    least, often, ranked = max(3, n / 100), {}, []
    for length in range(4, 13):
        frequent = {s: c for s, c in _beginnings(mine, length).items() if c >= least}
        against = _beginnings(other, length, set(frequent))
        often |= frequent
        ranked += [(z(c, against[s]), length, s) for s, c in frequent.items()]
    ranked = sorted((r for r in ranked if r[0] >= 5), reverse=True)
    found: list[bytes] = []
    for _, _, s in ranked:
        if len(found) == TYPICAL:
            break
        if not any(s.startswith(f) or f.startswith(s) for f in found):
            longer = [t for _, _, t in ranked if t.startswith(s) and often[t] >= 0.9 * often[s]]
            found.append(max(longer, key=len))
    return found


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T * (p * (1 - p)) @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(toxic: list[bytes], ordinary: list[bytes]) -> Dictionaries:
    """Dictionaries and calibration from labelled texts; without both kinds every score is 0."""
    bad, good = _without_copies(toxic), _without_copies(ordinary)
    if not bad or not good:
        return Dictionaries()
    typical = [_typical(bad, good), _typical(good, bad)]
    words: Counter = Counter()
    for text in bad + good:
        words.update(set(text))
    marks = tuple(typical[0] + typical[1])
    shared = [w for w, _ in words.most_common(FREQUENT) if not (marks and w.startswith(marks))]
    common = widen(b"\0 " + b" ".join(reversed(shared))) + LEAD
    model = Dictionaries(*(widen(b"".join(b"\0 " + s for s in reversed(t))) + common for t in typical))
    x = Scorer(model).features([b" ".join(t) for t in bad + good])
    y = np.array([1.0] * len(bad) + [0.0] * len(good))
    model.weights = _logistic(x, y).tolist()
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Dictionaries:
    """Trains on rows with a label that are not held out, a bounded sample of each kind.

    The sample is ``TOXIC_SAMPLE`` and ``ORDINARY_SAMPLE`` doc_ids by a hash, less texts of more
    than ``SAMPLE_BYTES``. A doc_id with several labels counts as toxic if one says so; null labels do not count.
    """
    marks = labels.select("doc_id", "toxic").where("toxic IS NOT NULL AND doc_id IS NOT NULL")
    marks = marks.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = []
    for label, most in ((1, TOXIC_SAMPLE), (0, ORDINARY_SAMPLE)):
        picked = marks.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        ids = [r.doc_id for r in picked.select("doc_id").collect()]
        some = docs.where(F.col("doc_id").isin(ids) & (F.coalesce(F.octet_length("text"), F.lit(0)) <= SAMPLE_BYTES))
        rows = some.select("doc_id", F.col("text").cast("binary").alias("data"))
        found = {r.doc_id: bytes(r.data or b"") for r in rows.orderBy("data").collect()} if ids else {}
        texts.append([found[i] for i in ids if i in found])
    return train(*texts)


def _score(model: Dictionaries) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            texts = [t.as_py() for t in batch.column("data")]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "score": pa.array(scorer.scores(texts))}
            )

    return run


def _pass(model: Dictionaries, threshold: float, text: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            texts = [t.as_py() for t in batch.column(text).cast(pa.binary())]
            yield batch.filter(pa.array(scorer.scores(texts) < threshold))

    return run


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, score`` of every row: the probability that the text is toxic.

    Only the text counts; null and empty texts get the score of no windows at all. ASCII
    letters are lower-cased. Repeated rows each get their score.
    """
    kind = docs.select("doc_id").dtypes[0][1]
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("data"))
    return rows.mapInArrow(_score(fit(docs, labels)), f"doc_id {kind}, score double")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents scored below the threshold, with all their columns whatever their names.

    Null and empty texts are scored as texts without windows, repeated rows stay or go together,
    and a score equal to the threshold goes. Without labels of both kinds every document stays.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    kept = plain.mapInArrow(_pass(fit(docs, labels), threshold, f"c{names.index('text')}"), plain.schema)
    return kept.toDF(*names)


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    """Contract columns for all documents; a fifth of the doc_ids is held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )

"""LM scoring with a class-based bigram model: exchange clustering, transitions, emissions.

Every word seen often enough in training is clustered by itself; the rarer words are clustered
by their last bytes. The table of these units grows with the vocabulary, not with the text. A
word's probability is that of its class after the class before, times its share in the class.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.store import keep
from wattloom.llm.wordhash import Hasher, chunks, mix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A word is clustered by itself if the training texts have it so many times or more.
LEAST = 10
#: Units whose moves one task decides.
PART = 2048
#: A word's count travels to all tasks if the word is clustered by itself or is one in so many tokens or more.
HEAD = 65536
CLASSES, ROUNDS, SMOOTH = 64, 8, 20.0
#: One unit in so many may move in a round: where all do, each by the places that the others had,
#: they overshoot together.
TURNS = 2
#: Words that a task combines at a time.
GATHER = 1 << 20
#: Pairs of words that a task combines at a time.
PAIRS = 1 << 20


@dataclass
class Model:
    """Tables that all tasks get. Those by unit grow with the vocabulary, all others are bounded.

    Unit 0 is the end of a text. Then come the endings of the rarer training words, one unit for
    all endings that they do not have, and the words that are clustered by themselves.
    """

    endings: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))  # ascending
    unit_hashes: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))  # ascending
    head_hashes: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))  # ascending
    head_counts: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    classes: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))  # by unit; the end has class 0
    transition: np.ndarray = field(default_factory=lambda: np.zeros((1, 1)))  # log10, [before, after]
    known: np.ndarray = field(default_factory=lambda: np.zeros(1))  # log10((1 - unseen) / size) by class
    unseen: np.ndarray = field(default_factory=lambda: np.zeros(1))  # log10 of the unseen mass by class

    @property
    def width(self) -> int:
        return 2 + len(self.endings) + len(self.unit_hashes)


def _find(sorted_hashes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Index of each hash in an ascending table, -1 where it is missing."""
    if not len(sorted_hashes):
        return np.full(len(hashes), -1)
    at = np.searchsorted(sorted_hashes, hashes)
    at[at == len(sorted_hashes)] = 0
    return np.where(sorted_hashes[at] == hashes, at, -1)


def _endings(words, lower: np.ndarray) -> np.ndarray:
    """The last three bytes of each word as a number; shorter words have numbers of their own."""
    code = np.zeros(len(words.begin), np.uint64)
    for back in (1, 2, 3):
        at = words.end - back
        inside = at >= words.begin
        code = code * np.uint64(257) + np.where(inside, lower[words.data[np.where(inside, at, 0)]] + np.uint64(1), np.uint64(0))
    return code.astype(np.int64)


def _lower() -> np.ndarray:
    codes = np.arange(256, dtype=np.uint64)
    codes[65:91] += np.uint64(32)
    return codes


def _gathered(parts: Iterator[tuple[np.ndarray, ...]], most: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays of a few chunks put together, up to about ``most`` numbers at a time."""
    found, size = [], 0
    for part in parts:
        found.append(part)
        size += len(part[0])
        if size >= most:
            yield tuple(np.concatenate(x) for x in zip(*found, strict=True))
            found, size = [], 0
    if found:
        yield tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, ending, train, held`` counts, combined over ``GATHER`` words."""
    hasher, lower = Hasher(lower=True), _lower()

    def parts() -> Iterator[tuple[np.ndarray, ...]]:
        for batch in batches:
            held = np.asarray(batch.column("held").fill_null(False).to_numpy(zero_copy_only=False))
            for at, upto, data, offsets in chunks(batch.column("data")):
                words = hasher.words(data, offsets)
                yield words.hashes, _endings(words, lower), np.repeat(held[at:upto], np.diff(words.first))

    for hashes, endings, marks in _gathered(parts(), GATHER):
        values, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        every = np.bincount(place, minlength=len(values))
        later = np.bincount(place, weights=marks, minlength=len(values)).astype(np.int64)
        yield pa.RecordBatch.from_pydict(
            {
                "word": pa.array(values.view(np.int64)),
                "ending": pa.array(endings[first].astype(np.int32)),
                "train": pa.array(every - later),
                "held": pa.array(later),
            }
        )


def _unit_run(hasher: Hasher, lower: np.ndarray, model: Model, data: np.ndarray, offsets: np.ndarray):
    """Words, their units, and the units in one row with an end after each text."""
    words = hasher.words(data, offsets)
    units, other = _find(model.unit_hashes, words.hashes), len(model.endings) + 1
    endings = _find(model.endings, _endings(words, lower))
    units = np.where(units >= 0, units + 1 + other, np.where(endings >= 0, endings + 1, other))
    texts = len(offsets) - 1
    text = np.repeat(np.arange(texts), np.diff(words.first))
    run = np.zeros(len(units) + texts, np.int64)
    run[np.arange(len(units)) + text] = units
    return words, units, text, run


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on in as many bytes as the largest needs; all lowest bytes come first."""
    size = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    spread = np.ascontiguousarray(numbers.astype("<u8")).view(np.uint8).reshape(-1, 8)
    return bytes([size]) + np.ascontiguousarray(spread[:, :size].T).tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    size = planes[0]
    found = np.frombuffer(planes, np.uint8, offset=1).reshape(size, -1)
    spread = np.zeros((found.shape[1], 8), np.uint8)
    spread[:, :size] = found.T
    return spread.view("<i8").ravel()


def _shift(width: int) -> int:
    """Bits of a unit's number in a key."""
    return max(1, (width - 1).bit_length())


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(n[order], first)


def _dealt(a: np.ndarray, b: np.ndarray, n: np.ndarray, width: int, parts: int) -> pa.RecordBatch:
    """Pairs as neighbours of both their units: ``part, keys, counts``, one row a part.

    Unit ``u`` is number ``u // parts`` of part ``u % parts``. A key is that number, the side (1
    for units before) and the other unit.
    """
    unit, other = np.concatenate([a, b]), np.concatenate([b, a])
    side = np.repeat(np.array([0, 1]), len(a))
    part = unit % parts
    key = (unit // parts * 2 + side << _shift(width)) + other
    order = np.argsort((part * (-(-width // parts) * 2) << _shift(width)) + key)
    part, key, n = part[order], key[order], np.concatenate([n, n])[order]
    at = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.empty(0, np.int64)
    rows = [
        (int(part[i]), _planes(np.diff(key[i:j], prepend=0)), _planes(n[i:j]))
        for i, j in zip(at, [*at[1:], len(part)], strict=True)
    ]
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    types = (pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["part", "keys", "counts"]
    )


_DEALT = "part long, keys binary, counts binary"


def _bigrams(model: Model, parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, lower = Hasher(lower=True), _lower()
        width = model.width

        def gathered() -> Iterator[tuple[np.ndarray, ...]]:
            for batch in batches:
                for _, _, data, offsets in chunks(batch.column("data")):
                    units = _unit_run(hasher, lower, model, data, offsets)[3]
                    yield (np.append(0, units[:-1]) * width + units,)

        for (codes,) in _gathered(gathered(), PAIRS):
            pairs, counts = np.unique(codes, return_counts=True)
            yield _dealt(pairs // width, pairs % width, counts, width, parts)

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a part from rows that come ordered by part, with the frequency of its units."""

    def made(part: int, keys: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        key, n = _summed(np.concatenate(keys), np.concatenate(counts))
        return pa.RecordBatch.from_arrays(
            [pa.array([part]), pa.array([_planes(np.diff(key, prepend=0))]), pa.array([_planes(n)])], ["part", "keys", "counts"]
        )

    now, keys, counts, held = None, [], [], 0
    for batch in batches:
        for part, k, n in zip(*(batch.column(c).to_pylist() for c in ("part", "keys", "counts")), strict=True):
            if part != now:
                if now is not None:
                    yield made(now, keys, counts)
                now, keys, counts, held = part, [], [], 0
            keys.append(np.cumsum(_numbers(k)))
            counts.append(_numbers(n))
            held += len(keys[-1])
            if held > 2 * GATHER:  # equal pairs of other tasks are added up as they come
                key, total = _summed(np.concatenate(keys), np.concatenate(counts))
                keys, counts, held = [key], [total], len(key) // 2
    if now is not None:
        yield made(now, keys, counts)


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def _side_gain(n: np.ndarray, fn: np.ndarray, mine: np.ndarray, other: np.ndarray, now: np.ndarray, own: np.ndarray) -> np.ndarray:
    """What the counts ``mine`` after (or before) each unit add to every class, by row of ``n``.

    ``n`` counts class pairs, the units' own among them, transposed for the side after; those of
    a unit are taken out of its class first. Only classes that a unit has a neighbour in matter.
    """
    unit, at = np.nonzero(mine)
    x = mine[unit, at]
    a = now[unit]
    base, f_base = n[at], fn[at]  # copies
    entry = np.arange(len(unit))
    base[entry, a] -= x
    same = np.flatnonzero(at == a)
    base[same] = n[a[same]] - other[unit[same]]
    base[same, a[same]] += own[unit[same]] - x[same]
    x[same] -= own[unit[same]]
    f_base[entry, a] = _f(base[entry, a])
    f_base[same] = _f(base[same])
    base += x[:, None]
    added = _f(base) - f_base
    out = np.zeros((len(mine), n.shape[1]))
    first = np.flatnonzero(np.append(True, unit[1:] != unit[:-1])) if len(unit) else unit
    out[unit[first]] = np.add.reduceat(added, first, axis=0) if len(unit) else 0.0
    return out


def exchange(n: np.ndarray, now: np.ndarray, after: np.ndarray, before: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The best class of each unit, all against the same counts.

    ``n`` counts class pairs with all units in it. A unit has its class ``now``, its counts by
    class of what comes after and before it, and its pairs with itself, which are in both. The
    goal is the likelihood of the class bigrams, ``sum N(c,d) log N(c,d) - sum N(c) log N(c) -
    sum N(d) log N(d)``. Class 0, the end of a text, takes no part.
    """
    row = np.arange(len(now))
    fn = _f(n)
    gain = _side_gain(n.T, fn.T, after, before, now, own) + _side_gain(n, fn, before, after, now, own)
    rest_after, rest_before = after.copy(), before.copy()
    rest_after[row, now] -= own
    rest_before[row, now] -= own
    corner = np.repeat(np.diagonal(n)[None], len(now), axis=0)
    corner[row, now] += own - after[row, now] - before[row, now]
    both = corner + rest_after + rest_before + own[:, None]
    gain += _f(both) + _f(corner) - _f(corner + rest_after) - _f(corner + rest_before)
    for total, mine in ((n.sum(axis=1), after.sum(axis=1)), (n.sum(axis=0), before.sum(axis=1))):
        without = np.repeat(total[None], len(now), axis=0)
        without[row, now] -= mine
        gain -= _f(without + mine[:, None]) - _f(without)
    gain[:, 0] = -np.inf
    best = gain.argmax(axis=1)
    return np.where(gain[row, best] > gain[row, now] + 1e-9, best, now)


def _moved(n: np.ndarray, now: np.ndarray, to: np.ndarray, after: np.ndarray, before: np.ndarray, own: np.ndarray) -> None:
    """Takes the counts of units that change their class along, in place."""
    at = np.flatnonzero(now != to)
    a, c, p, q, o = now[at], to[at], after[at].copy(), before[at].copy(), own[at]
    np.add.at(n, a, -p)
    np.add.at(n.T, a, -q)
    np.add.at(n, (a, a), o)
    p[np.arange(len(at)), a] -= o
    q[np.arange(len(at)), a] -= o
    np.add.at(n, c, p)
    np.add.at(n.T, c, q)
    np.add.at(n, (c, c), o)


def _round(now: np.ndarray, guess: np.ndarray | None, width: int, parts: int, k: int, moving: int):
    """The class pair counts, and with a guess of them the units that move.

    Rows ``key, n, change``: a class pair ``c * k + d`` as ``-1 - key`` with its count now and
    its change by moves, and a unit with its new class. The units of a part move the most
    frequent first, one by one and then in growing groups that see each other's places before.
    """

    shift = _shift(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, change = np.zeros((k, k)), np.zeros((k, k))
        for batch in batches:
            for part, keys, counts in zip(*(batch.column(c).to_pylist() for c in ("part", "keys", "counts")), strict=True):
                key, times = np.cumsum(_numbers(keys)), _numbers(counts)
                place, other = key >> shift, key & (1 << shift) - 1
                local = place[-1] // 2 + 1
                sides = np.bincount(place * k + now[other], weights=times, minlength=local * 2 * k).reshape(local, 2, k)
                after, before = sides[:, 0], sides[:, 1]
                unit = np.arange(local) * parts + part
                self_pair = (place % 2 == 0) & (other == unit[place // 2])
                own = np.bincount(place[self_pair] // 2, weights=times[self_pair], minlength=local)
                np.add.at(count, now[unit], after)
                if guess is None:
                    continue
                n, done = guess.copy(), 0
                size = after.sum(axis=1) + before.sum(axis=1)
                order = np.lexsort((unit, -size))
                order = order[(size[order] > 0) & (unit[order] > 0) & ((order + moving) % TURNS == 0)]
                new = now[unit].copy()
                while done < len(order):
                    some = order[done : done + max(1, done // 8)]
                    done += len(some)
                    args = (new[some], after[some], before[some], own[some])
                    to = exchange(n, *args)
                    _moved(n, args[0], to, *args[1:])
                    np.maximum(n, 0, out=n)
                    new[some] = to
                change += n - guess
                at = np.flatnonzero(new != now[unit])
                yield _changes(unit[at], new[at], np.zeros(len(at)))
        pair = np.flatnonzero((count != 0) | (change != 0))
        yield _changes(-1 - pair, count.ravel()[pair], change.ravel()[pair])

    return run


def _changes(key: np.ndarray, n: np.ndarray, change: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"key": pa.array(key.astype(np.int64)), "n": pa.array(n.astype(np.int64)), "change": pa.array(change.astype(float))}
    )


def _likelihood(matrix: np.ndarray) -> float:
    return float(_f(matrix).sum() - _f(matrix.sum(axis=0)).sum() - _f(matrix.sum(axis=1)).sum())


def _clustered(
    dealt: DataFrame, frequency: np.ndarray, parts: int, classes: int, rounds: int
) -> tuple[np.ndarray, np.ndarray]:
    k, width = classes + 1, len(frequency)
    # A part's rows, one from each task that had some, are put together one after the other.
    ordered = dealt.repartition(parts, "part").sortWithinPartitions("part")
    table = keep(ordered.mapInArrow(_merge, _DEALT), "unit-neighbours")
    now = np.zeros(max(width, k), np.int64)
    now[1:] = 1 + np.arange(len(now) - 1) % classes
    rest = np.arange(1, width)
    now[rest[np.lexsort((rest, -frequency[1:]))]] = 1 + np.arange(width - 1) % classes

    best: tuple[float, np.ndarray, np.ndarray] | None = None
    guess = None
    for moving in range(rounds + 2):
        # The first pass and the last only count, the others move by what the pass before expects.
        expected = guess if moving <= rounds else None
        result = table.mapInArrow(_round(now, expected, width, parts, k, moving), "key long, n long, change double")
        rows = result.groupBy("key").agg(F.sum("n").alias("n"), F.sum("change").alias("change")).toArrow()
        key, n, change = (rows.column(c).to_numpy() for c in ("key", "n", "change"))
        pair = key < 0
        matrix, delta = np.zeros(k * k), np.zeros(k * k)
        matrix[-1 - key[pair]], delta[-1 - key[pair]] = n[pair], change[pair]
        matrix, delta = matrix.reshape(k, k), delta.reshape(k, k)
        likelihood = _likelihood(matrix)
        if best is None or likelihood > best[0]:
            best = likelihood, now, matrix
        if guess is not None and pair.all():
            break  # nothing moves any more
        guess = np.maximum(matrix + delta, 0)
        now = now.copy()
        now[key[~pair]] = n[~pair]
    return best[1], best[2]


def cluster(pairs: DataFrame, classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Class of each unit of ``pairs(a, b, n)`` by exchange clustering, and the class pair counts.

    The neighbours of a unit are brought together once. Each round is one pass over them: a task
    sums a unit's neighbours by class and moves the units of a part, ``PART`` of them, which see
    each other's moves and those of the round before. One unit in ``TURNS`` may move in a round,
    and the classes of the likeliest round are returned. Parts and turns depend on the units alone.
    Units start dealt to the classes by frequency. Unit 0 is the end of a text, alone in class 0.
    All tasks and the driver hold a number per unit. No pairs give classes without counts.
    """
    counted = pairs.groupBy("b").agg(F.sum("n").alias("n"), F.max("a").alias("a")).toArrow()
    unit, n, before = (counted.column(c).to_numpy() for c in ("b", "n", "a"))
    width = int(max(unit.max(initial=0), before.max(initial=0))) + 1
    frequency = np.zeros(width, np.int64)
    frequency[unit] = n
    parts = -(-width // PART)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _dealt(*(batch.column(c).to_numpy() for c in "abn"), width, parts)

    dealt = pairs.select("a", "b", "n").mapInArrow(deal, _DEALT)
    return _clustered(dealt, frequency, parts, classes, rounds)


def _score(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per text a row of sums, and a row for each of its words whose count is not in the model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, lower = Hasher(lower=True), _lower()
        for batch in batches:
            ids = batch.column("doc_id")
            for at, upto, data, offsets in chunks(batch.column("data")):
                words, units, text, run_of = _unit_run(hasher, lower, model, data, offsets)
                texts = upto - at
                classes = model.classes[run_of]
                steps = model.transition[np.append(0, classes[:-1]), classes]
                owner = np.repeat(np.arange(texts), np.diff(words.first) + 1)
                score = np.bincount(owner, weights=steps, minlength=texts)
                head = _find(model.head_hashes, words.hashes)
                count = np.where(head >= 0, model.head_counts[head], 0) if len(model.head_counts) else np.zeros(len(head))
                of = model.classes[units]
                seen = count > 0
                emitted = np.where(seen, np.log10(np.maximum(count, 1)) + model.known[of], model.unseen[of])
                inside = head >= 0
                score += np.bincount(text[inside], weights=emitted[inside], minlength=texts)
                base = np.bincount(text[inside], weights=np.log10(count[inside] + 1.0), minlength=texts)
                known = np.bincount(text[seen], minlength=texts)
                size = np.diff(words.first) + 1

                tail = np.flatnonzero(~inside)
                order = tail[np.lexsort((words.hashes[tail], text[tail]))]
                new = np.ones(len(order), bool)
                new[1:] = (text[order][1:] != text[order][:-1]) | (words.hashes[order][1:] != words.hashes[order][:-1])
                first = np.flatnonzero(new)
                often = np.diff(np.append(first, len(order)))
                lead = order[first]
                rows = np.concatenate([np.arange(texts), text[lead]]) + at
                none, pad = np.zeros(len(lead), np.int64), np.zeros(texts, np.int64)
                # A text's own row gets a spread key; it matches nothing that counts.
                own = mix(np.arange(at, upto).astype(np.uint64) + mix(words.hashes[:1]).sum(dtype=np.uint64))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": ids.take(pa.array(rows)),
                        "word": pa.array(np.concatenate([own, words.hashes[lead]]).view(np.int64)),
                        "times": pa.array(np.concatenate([pad, often])),
                        "class": pa.array(np.concatenate([pad, of[lead]]).astype(np.int32)),
                        "size": pa.array(np.concatenate([size, none])),
                        "known": pa.array(np.concatenate([known, none])),
                        "base": pa.array(np.concatenate([base, none])),
                        "score": pa.array(np.concatenate([score, none])),
                    }
                )

    return run


def _pick(values: np.ndarray, at: Column) -> Column:
    return F.get(F.array(*[F.lit(float(v)) for v in values]), at)


def score_documents(docs: DataFrame, held_out: Column) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity`` of each doc_id.

    The model learns from the rows for which ``held_out`` is false or null. Scores are log10
    probabilities of the words and the end of each text; an unseen word counts as its class's
    one unseen word. ``base_score`` is the add-one unigram score. Null and empty texts consist
    of their end. Rows that share a doc_id (null too) are parts of one document whose figures
    add up. Without training texts every score is 0. Words are told apart by 64-bit hashes.
    """
    kind = docs.select("doc_id").dtypes[0][1]
    rows = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held"), F.col("text").cast("binary").alias("data"))
    counted = rows.mapInArrow(_counts, "word long, ending int, train long, held long")
    counted = counted.groupBy("word", "ending").agg(F.sum("train").alias("train"), F.sum("held").alias("held"))
    counts = keep(counted, "word-counts")
    totals = counts.agg(
        F.coalesce(F.sum("train"), F.lit(0)).alias("train"),
        F.coalesce(F.sum(F.col("train") + F.col("held")), F.lit(0)).alias("every"),
        F.count_if(F.col("train") > 0).alias("distinct"),
    ).first()
    ends = rows.where("NOT held").count()
    n_train, n_distinct = totals.train + ends, totals.distinct + (ends > 0)
    model = Model()
    # Words clustered by themselves, and at most HEAD rows over a share of all tokens.
    in_head = (F.col("train") >= LEAST) | ((F.col("train") + F.col("held")) * HEAD >= totals.every)
    head = counts.where(in_head).select("word", "train").toArrow()
    hashes, seen = head.column("word").to_numpy().view(np.uint64), head.column("train").to_numpy()
    order = np.argsort(hashes)
    model.head_hashes, model.head_counts = hashes[order], seen[order]
    model.unit_hashes = model.head_hashes[model.head_counts >= LEAST]
    rarer = counts.where((F.col("train") > 0) & (F.col("train") < LEAST)).groupBy("ending").agg(F.sum("train").alias("n"))
    rarer = rarer.toArrow()
    order = np.argsort(rarer.column("ending").to_numpy())
    model.endings = rarer.column("ending").to_numpy()[order].astype(np.int64)
    width = model.width
    often = model.head_counts[model.head_counts >= LEAST]
    frequency = np.concatenate([[ends], rarer.column("n").to_numpy()[order], [0], often]).astype(np.int64)

    parts = -(-width // PART)
    dealt = rows.where("NOT held").mapInArrow(_bigrams(model, parts), _DEALT)
    now, matrix = _clustered(dealt, frequency, parts, CLASSES, ROUNDS)
    k = len(matrix)
    model.classes = np.zeros(max(width, len(now)), np.int64)
    model.classes[: len(now)] = now

    size = matrix.sum(axis=0)
    share = (size + 1) / (size.sum() + k)
    transition = (matrix + SMOOTH * share) / (matrix.sum(axis=1, keepdims=True) + SMOOTH)
    model.transition = np.log10(transition)
    single = np.zeros(k)
    alone = counts.where("train = 1").groupBy("ending").count().toArrow()  # a row per ending
    at = np.searchsorted(model.endings, alone.column("ending").to_numpy())
    np.add.at(single, model.classes[at + 1], alone.column("count").to_numpy())
    # Nothing is known of other endings; new words are likeliest where most words came once.
    model.classes[len(model.endings) + 1] = 1 + single[1:].argmax()
    unseen = np.minimum((single + 0.5) / (size + 1), 0.5)
    model.known, model.unseen = np.log10((1 - unseen) / np.maximum(size, 1)), np.log10(unseen)
    if not n_train:
        model.transition, model.unseen = np.zeros((k, k)), np.zeros(k)

    scored = rows.select("doc_id", "data").mapInArrow(
        _score(model), f"doc_id {kind}, word long, times long, class int, size long, known long, base double, score double"
    )
    rare = counts.where(~in_head).where("train > 0")
    scored = scored.join(rare.select("word", F.col("train").alias("c")), "word", "left")
    count = F.coalesce("c", F.lit(0))
    emitted = F.when(count > 0, F.log10(count) + _pick(model.known, F.col("class"))).otherwise(_pick(model.unseen, F.col("class")))
    summed = scored.groupBy("doc_id").agg(
        F.sum("size").alias("n_tokens"),
        F.sum(F.col("known") + F.when(count > 0, F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + F.col("times") * F.log10(count + 1)).alias("base"),
        F.sum(F.col("score") + F.when(F.col("times") > 0, F.col("times") * emitted).otherwise(0.0)).alias("score"),
        F.sum(F.when(F.col("size") > 0, 1).otherwise(0)).alias("texts"),
    )
    # The end of a text is a token too, seen in every training text.
    base = F.col("base") + F.col("texts") * F.log10(F.lit(float(ends + 1)))
    return summed.select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + (F.col("texts") if ends else F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (base - F.col("n_tokens") * F.log10(F.lit(float(n_train + n_distinct + 1)))).alias("base_score"),
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


def op2_lm_score(spark, sf_dir: str) -> DataFrame:
    """Contract columns for all documents; a seventh of the doc_ids is held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")

    def held_out() -> Column:
        return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))

    scored = score_documents(docs, held_out())
    return scored.select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"
    )

"""N-gram Jaccard join: globally ordered n-gram sets in tries, probed with shared partial overlaps.

Sets that can be similar at all are brought together first. Every set's rarest n-grams are its
prefix, and two sets over the threshold share a token of their prefixes. N-grams of a fixed
hash range are ordered by their number of sets, the others follow by hash. Sets tied by prefix
tokens form a block, and each block is joined in a trie.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.components import components
from wattloom.llm.store import keep
from wattloom.llm.wordhash import Hasher, chunks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRAM, PERCENT = 4, 85
#: N-grams in one piece of a block; larger blocks are joined piece by piece.
PIECE = 1_000_000
#: Cells of the probe matrix in a trie.
CELLS = 1 << 25


def _sets(hasher: Hasher, data: np.ndarray, offsets: np.ndarray, gram: int) -> list[np.ndarray]:
    """Distinct n-gram hashes of each text, ascending; all words as one if there are fewer."""
    words = hasher.words(data, offsets)
    runs = hasher.runs(words.hashes, gram)
    found = []
    for first, last in zip(words.first[:-1], words.first[1:], strict=True):
        if last - first >= gram:
            found.append(np.unique(runs[first : last - gram + 1]))
        elif last > first:
            found.append(hasher.spans(words.hashes, np.array([first]), np.array([last])))
        else:
            found.append(np.empty(0, np.uint64))
    return found


def _set_id(grams: np.ndarray) -> int:
    # Order does not matter, so equal sets have equal ids; the size is mixed in.
    total = grams * np.uint64(0x9E3779B97F4A7C15) ^ (grams >> np.uint64(29))
    return int(np.uint64(total.sum(dtype=np.uint64) ^ (np.uint64(len(grams)) << np.uint64(40))).view(np.int64))


def _counted(percent: int) -> int:
    """N-grams whose hash is below are ordered by frequency, five thirds of a set's prefix.

    With as many as the prefix or fewer, a set whose share is small by chance fills its prefix
    with n-grams that any document may have, and blocks grow together.
    """
    return min((1 << 64) * 5 * (100 - percent) // 300, (1 << 64) - 1)


def _prefix(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _profiles(gram: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    bound = np.uint64(_counted(percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(lower=True)
        for batch in batches:
            sizes, ids, counted = [], [], []
            for _, _, data, offsets in chunks(batch.column("data")):
                for grams in _sets(hasher, data, offsets, gram):
                    sizes.append(len(grams))
                    ids.append(_set_id(grams) if len(grams) else None)
                    counted.append(int(np.searchsorted(grams, bound)))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n": pa.array(sizes, pa.int32()),
                    "set": pa.array(ids, pa.int64()),
                    "counted": pa.array(counted, pa.int32()),
                }
            )

    return run


def _tokens(gram: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The n-grams that may be in a set's prefix; a set appears once per batch."""
    bound = np.uint64(_counted(percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(lower=True)
        for batch in batches:
            seen: set[int] = set()
            for _, _, data, offsets in chunks(batch.column("data")):
                tokens, owners = [], []
                for grams in _sets(hasher, data, offsets, gram):
                    if not len(grams) or (owner := _set_id(grams)) in seen:
                        continue
                    seen.add(owner)
                    upto = max(int(np.searchsorted(grams, bound)), _prefix(len(grams), percent))
                    tokens.append(grams[:upto])
                    owners.append(np.full(upto, owner, np.int64))
                if tokens:
                    yield pa.RecordBatch.from_pydict(
                        {
                            "token": pa.array(np.concatenate(tokens).view(np.int64)),
                            "set": pa.array(np.concatenate(owners)),
                        }
                    )

    return run


def _members(gram: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The n-grams of the texts whose set is the wanted one, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(lower=True)
        for batch in batches:
            wanted, grams_of = batch.column("set").to_pylist(), []
            for at, _, data, offsets in chunks(batch.column("data")):
                for i, grams in enumerate(_sets(hasher, data, offsets, gram), at):
                    grams_of.append(grams.tobytes() if len(grams) and _set_id(grams) == wanted[i] else None)
            columns = {n: batch.column(n) for n in ("block", "units", "ties", "set", "n", "copies")}
            yield pa.RecordBatch.from_pydict(columns | {"grams": pa.array(grams_of, pa.binary())})

    return run


def _ordered(sets: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """Sets as ascending ranks of their shared n-grams, the most frequent first; number of ranks."""
    every = np.concatenate(sets)
    values, place, counts = np.unique(every, return_inverse=True, return_counts=True)
    order = np.lexsort((values, -counts))
    rank = np.empty(len(values), np.int64)
    rank[order] = np.arange(len(values))
    shared = int((counts > 1).sum())
    ranks = np.split(rank[place], np.cumsum([len(s) for s in sets])[:-1])
    return [np.sort(r[r < shared]) for r in ranks], shared


def trie_join(
    sets: list[np.ndarray], probes: list[int], stored: list[int], percent: int = PERCENT
) -> Iterator[tuple[int, np.ndarray]]:
    """For each stored set, the probes that it links with (indexes into ``sets``).

    The stored sets, sorted, are the paths of a trie. Going down, every node adds its n-grams
    to the overlaps of all probes still alive, so sets that share a path share the work. A
    probe dies at a node where even all remaining n-grams cannot reach the overlap it needs
    with the smallest set below.
    """
    paths, width = _ordered(sets)
    sizes = np.array([len(s) for s in sets])
    stored = sorted(stored, key=lambda i: paths[i].astype(">u4").tobytes())
    total = len(stored)
    shared = np.zeros(total + 1, np.int64)  # n-grams that a path has in common with the one before
    shared[total] = -1
    for k in range(1, total):
        a, b = paths[stored[k - 1]], paths[stored[k]]
        m = min(len(a), len(b))
        other = np.flatnonzero(a[:m] != b[:m])
        shared[k] = other[0] if len(other) else m
    lower = np.full(total + 1, total)  # the next path that branches off higher up
    for k in range(total - 1, -1, -1):
        j = k + 1
        while j < total and shared[j] >= shared[k]:
            j = lower[j]
        lower[k] = j
    size = sizes[stored]
    lengths = np.array([len(paths[i]) for i in stored])
    step = max(1, CELLS // max(width, 1))
    for at in range(0, len(probes), step):
        some = np.array(probes[at : at + step])
        matrix = np.zeros((width, len(some)), np.uint8)
        for j, i in enumerate(some):
            matrix[paths[i], j] = 1
        probe_size = sizes[some]
        stack = [(0, np.arange(len(some)), np.zeros(len(some), np.int64))]
        k = 0
        while k < total:
            while stack[-1][0] > shared[k]:
                stack.pop()
            depth, alive, overlap = stack[-1]
            path, stops, j = paths[stored[k]], [], k + 1
            while j < total and shared[j] > depth:
                stops.append(int(shared[j]))
                j = lower[j]
            skip = 0
            for stop in [*reversed(stops), len(path)]:
                if stop > depth:
                    overlap = overlap + matrix[path[depth:stop]][:, alive].sum(axis=0, dtype=np.int64)
                    depth = stop
                end = k + 1
                while end < total and shared[end] >= depth:
                    end = lower[end] if shared[end] > depth else end + 1
                below = slice(k, end)
                reach = overlap + np.minimum(probe_size[alive] - overlap, int(lengths[below].max()) - depth)
                need = percent * (probe_size[alive] + int(size[below].min()))
                live = (100 + percent) * reach >= need
                alive, overlap = alive[live], overlap[live]
                if not len(alive):
                    skip = end
                    break
                if depth < len(path):
                    stack.append((depth, alive, overlap))
            if skip:
                k = skip
                continue
            ends = (100 + percent) * overlap >= percent * (probe_size[alive] + size[k])
            yield stored[k], some[alive[ends]]
            k += 1


def _join_block(
    sets: list[np.ndarray],
    copies: np.ndarray,
    first: list[int],
    second: list[int],
    percent: int,
    tie: int = 0,
    ties: list[np.ndarray] | None = None,
):
    """Component labels and weighted link counts of one piece or pair of pieces.

    With ``ties``, the sorted ties of each set, only pairs whose first common one is ``tie`` count.
    """
    label, links = np.arange(len(sets)), np.zeros(len(sets), np.int64)
    for i, found in trie_join(sets, first, second, percent):
        found = found[found != i]
        if ties is not None and len(found):
            found = found[[np.intersect1d(ties[i], ties[j], assume_unique=True)[0] == tie for j in found]]
        if not len(found):
            continue
        links[i] += copies[found].sum()
        if first is not second:
            links[found] += copies[i]
        if (label[found] != label[i]).any():
            old = np.unique(np.append(label[found], label[i]))
            label[np.isin(label, old)] = old[0]
    return label, links


_JOINED = ("block", "tie", "one", "two", "piece", "set", "copies", "grams", "pieces", "ties")


def _blocks(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Joins the units of a partition sorted by block, tie and pair of pieces, one at a time."""

    def joined(rows: list[dict]) -> pa.RecordBatch | None:
        tie, one, two = (rows[0][c] for c in ("tie", "one", "two"))
        rows = list({r["set"]: r for r in rows}.values())
        sets = [np.frombuffer(r["grams"], np.uint64) for r in rows]
        first = [i for i, r in enumerate(rows) if r["piece"] == one]
        second = first if one == two else [i for i, r in enumerate(rows) if r["piece"] == two]
        ties = [np.sort(np.array(r["ties"], np.int64)) for r in rows] if tie is not None else None
        copies = np.array([r["copies"] for r in rows])
        label, links = _join_block(sets, copies, first, second, percent, tie, ties)
        ids, whole = [r["set"] for r in rows], tie is None and rows[0]["pieces"] == 1
        return pa.RecordBatch.from_pydict(
            {
                "a": pa.array(ids, pa.int64()),
                "b": pa.array([ids[x] for x in label], pa.int64()),
                "links": pa.array(links),
                "whole": pa.array([whole] * len(ids), pa.bool_()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            for values in zip(*(batch.column(n).to_pylist() for n in _JOINED), strict=True):
                if values[:4] != key:
                    if rows:
                        yield joined(rows)
                    key, rows = values[:4], []
                rows.append(dict(zip(_JOINED, values, strict=True)))
        if rows:
            yield joined(rows)

    return run


def _ties(tokens: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """``set, tie, head``: sets by the tokens of their prefixes and by size, where several share one.

    Sets that can link have a tie in common; ``head`` is the smallest set of a tie.
    """
    counts = tokens.groupBy("token").agg(F.count("*").alias("rows")).where("rows > 1")
    shared = tokens.join(counts, "token")
    # The tokens of one set; bounded by its text.
    per_set = shared.groupBy("set").agg(F.collect_set(F.struct("rows", "token")).alias("shared"))
    sizes = profiles.where("n > 0").groupBy(F.col("set").alias("id")).agg(
        F.min("n").alias("n"), F.min("counted").alias("counted")
    )
    known = per_set.join(sizes, F.col("set") == F.col("id"))
    # Hashes are unsigned: negative longs are the upper half.
    bound = _counted(percent)
    if bound < 1 << 63:
        below = lambda t: (t["token"] >= 0) & (t["token"] < F.lit(bound))
    else:
        below = lambda t: (t["token"] >= 0) | (t["token"] < F.lit(bound - (1 << 64)))
    prefix = F.col("n") - F.expr(f"({percent} * n + 99) div 100") + 1
    early = F.array_sort(F.filter("shared", below))
    unique = F.col("counted") - F.size(early)
    take = F.greatest(F.lit(0), F.least(prefix, F.col("counted")) - unique).cast("int")
    chosen = F.concat(F.slice(early, 1, take), F.filter("shared", lambda t: ~below(t)))
    # Sets of similar size are in the same band or the next.
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(100 / (percent - 1)))))
    tied = known.select("set", band.alias("band"), F.explode(chosen["token"]).alias("token"))
    tied = tied.select("set", "token", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"))
    tied = keep(tied, "prefix-tokens")
    heads = tied.groupBy("token", "band").agg(F.min("set").alias("b"), F.max("set").alias("last")).where("b != last")
    return tied.join(heads, ["token", "band"]).select("set", F.xxhash64("token", "band").alias("tie"), F.col("b").alias("head"))


def _units(placed: DataFrame, ties: DataFrame) -> DataFrame:
    """``placed`` with the units in which each set is joined, ``tie, pieces``, and its ties if needed.

    A block within ``PIECE`` n-grams is one unit. A larger one is cut into pieces that all meet
    each other, or, if that sends fewer n-grams, into one unit for each tie.
    """
    sizes = keep(placed.groupBy(F.col("block").alias("of")).agg(F.sum("n").alias("grams")), "block-sizes")
    nothing = F.lit(None).cast("array<long>")
    one = F.array(F.struct(F.lit(None).cast("long").alias("tie"), F.lit(1).alias("pieces")))
    large = sizes.where(F.col("grams") > PIECE)
    if large.isEmpty():
        return placed.select("*", one.alias("units"), nothing.alias("ties"))
    pieces = lambda grams: F.ceil(F.col(grams) / PIECE).cast("int")
    members = placed.join(large, F.col("block") == F.col("of")).select("set", "n", "block", "grams")
    # The ties of a set are bounded by its text.
    own = ties.join(members.withColumnRenamed("set", "member"), F.col("set") == F.col("member"))
    own = keep(own.groupBy("set", "n", "block", "grams").agg(F.collect_set("tie").alias("ties")), "large-blocks")
    by_tie = own.groupBy(F.col("block").alias("of")).agg(
        (F.sum(F.col("n") * F.size("ties")) < F.max("grams") * F.max(pieces("grams"))).alias("by_tie")
    )
    own = own.join(by_tie, F.col("block") == F.col("of")).drop("of")
    each = own.where("by_tie").select("set", "block", "n", F.explode("ties").alias("tie"))
    of_tie = each.groupBy(F.col("block").alias("of"), F.col("tie").alias("by")).agg(F.sum("n").alias("tie_grams"))
    each = each.join(of_tie, (F.col("block") == F.col("of")) & (F.col("tie") == F.col("by")))
    each = each.groupBy("set").agg(F.collect_list(F.struct("tie", pieces("tie_grams").alias("pieces"))).alias("units"))
    each = each.join(own.where("by_tie").select("set", "ties"), "set")
    cut = F.array(F.struct(F.lit(None).cast("long").alias("tie"), pieces("grams").alias("pieces")))
    plans = each.unionByName(own.where("NOT by_tie").select("set", cut.alias("units"), nothing.alias("ties")))
    plans = keep(plans, "units").withColumnRenamed("set", "planned").withColumnRenamed("units", "several")
    found = placed.join(plans, F.col("set") == F.col("planned"), "left").drop("planned")
    return found.withColumn("units", F.coalesce("several", one)).drop("several")


def jaccard_components(docs: DataFrame, gram: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of every row.

    A text's set holds its distinct runs of ``gram`` words, ASCII letters lower-cased; a shorter
    text is one run. Rows link when ``100 * intersection >= percent * union``. ``component_id``
    is the smallest doc_id reachable over links, ``n_links`` the number of rows linked with.
    Null and empty texts have empty sets and link with nothing; their component is their own
    doc_id. A null doc_id links like others but is nobody's component unless alone (then null).
    Repeated rows link with each other. Sets are told apart by 64-bit hashes.
    """
    kind = docs.select("doc_id").dtypes[0][1]
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("data"))
    profiles = keep(rows.mapInArrow(_profiles(gram, percent), f"doc_id {kind}, n int, set long, counted int"), "set-profiles")
    tokens = rows.mapInArrow(_tokens(gram, percent), "token long, set long")
    ties = _ties(tokens, profiles, percent)
    blocks = components(ties.where("set != head").select(F.col("set").alias("a"), F.col("head").alias("b")).distinct())
    classes = profiles.where("n > 0").groupBy("set").agg(
        F.min("doc_id").alias("id"), F.min("n").alias("n"), F.count("*").alias("copies")
    )
    placed = classes.join(blocks, F.col("set") == F.col("node")).drop("node").withColumnRenamed("root", "block")
    placed = keep(placed, "blocks")
    placed = _units(placed, ties)

    # The number of classes grows with the documents, so this is never a broadcast.
    texts = rows.join(placed.hint("merge"), F.col("doc_id").eqNullSafe(F.col("id")))
    members = texts.mapInArrow(
        _members(gram),
        "block long, units array<struct<tie: long, pieces: int>>, ties array<long>, set long, n int, copies long, grams binary",
    )
    members = members.where("grams IS NOT NULL").select("*", F.inline("units"))
    members = members.withColumn("piece", F.pmod(F.xxhash64("set"), F.col("pieces")).cast("int"))
    # A unit in g pieces is joined as all pairs of pieces, so each member is sent g times.
    paired = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    paired = paired.select(
        "block", "tie", F.least("piece", "other").alias("one"), F.greatest("piece", "other").alias("two"),
        "piece", "set", "copies", "grams", "pieces", "ties",
    )
    units = ("block", "tie", "one", "two")
    paired = paired.repartition(*units).sortWithinPartitions(*units)
    joined = keep(paired.mapInArrow(_blocks(percent), "a long, b long, links long, whole boolean"), "set-links")
    # A block joined as one has its components already; those of other units are put together.
    roots = joined.where("whole").select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = roots.unionByName(components(joined.where("NOT whole").select("a", "b")))
    links = joined.groupBy(F.col("a").alias("linked")).agg(F.sum("links").alias("others"))

    whole = classes.select("set", "id", "copies")
    whole = whole.join(roots, F.col("set") == F.col("node"), "left").join(links, F.col("set") == F.col("linked"), "left")
    whole = whole.select(
        "set", "id", F.coalesce("root", "set").alias("root"),
        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
    )
    least = whole.groupBy(F.col("root").alias("of")).agg(F.min("id").alias("component_id"))
    whole = whole.join(least, F.col("root") == F.col("of")).select(F.col("set").alias("in_set"), "component_id", "n_links")
    return profiles.join(whole, F.col("set") == F.col("in_set"), "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def drop_near_copies(docs: DataFrame, gram: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with all its columns.

    Rows that share a doc_id stay or go together, and null ids stay.
    """
    found = jaccard_components(docs, gram, percent)
    gone = found.where("doc_id != component_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def op3_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """Contract columns for all documents, and the number of links."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP3_SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), g AS (
    SELECT DISTINCT doc_id, md5(array_to_string(list_slice(w, s, s + 3), ' ')) AS gram
    FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS s FROM d WHERE len(w) > 0)
), n AS (
    SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
), o AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id != b.doc_id GROUP BY a.doc_id, b.doc_id
), l AS (
    SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
    WHERE 100 * common >= 85 * (x.n + y.n - common)
), r AS (
    SELECT doc_id, doc_id AS root FROM d UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.doc_id
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c.root AS component_id, coalesce(k.n_links, 0) AS n_links
FROM d JOIN (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id) c USING (doc_id)
LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM l GROUP BY a) k USING (doc_id)
"""

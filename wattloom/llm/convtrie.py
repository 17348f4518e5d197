"""Conversation prefix trie by fixed-length block hashing.

A conversation is cut into blocks of a fixed number of turns. A block's chained digest stands for
all turns up to its end, so conversations are grouped by the digests of their blocks first, level
by level in one aggregation. A turn boundary inside a block is a node of the trie as well: where a
group of conversations goes on in one block only, all boundaries inside have its members; where it
goes on in several, one copy of each block is cut into turns and the cuts are grouped.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.scan import running
from wattloom.llm.store import keep

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Turns in a block.
BLOCK = 4
#: Turns that a conversation may take over from the head of its hundred.
HEADS = 6
NODE = ["depth", "n1", "n2"]


def hashed_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, h1, h2, chars``: 128 bits of role and text, and the text's code points."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 63))).alias("turn"),
        F.xxhash64(role, text).alias("h1"),
        F.xxhash64(F.lit(7), text, role).alias("h2"),
        F.char_length(text).cast("long").alias("chars"),
    )


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, pos, h1, h2, chars`` with the place of each turn, from 1 on."""
    marked = hashed_turns(turns).withColumn("one", F.lit(1).cast("long"))
    placed = running(marked, "conv_id", ["turn", "h1", "h2"], sums=["one"], name="turn-places")
    return placed.select("conv_id", F.col("run_one").alias("pos"), "h1", "h2", "chars")


def _xor(of: Column) -> Column:
    return F.aggregate(of, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))


def _cuts(blocks: DataFrame, *carried: str) -> DataFrame:
    """A row per turn of each block: depth, digests up to it and up to the turn before, characters."""
    at = F.posexplode("turns").alias("i", "t")
    rows = blocks.select("k", "p1", "p2", "q", "size", *carried, F.col("turns").alias("all"), at)
    upto, before = F.slice("all", 1, F.col("i") + 1), F.slice("all", 1, F.col("i"))
    return rows.select(
        (F.col("k") * size_of_block() + F.col("i") + 1).alias("depth"),
        *[F.col(f"p{s}").bitwiseXOR(_xor(upto[f"x{s}"])).alias(f"n{s}") for s in (1, 2)],
        *[F.col(f"p{s}").bitwiseXOR(_xor(before[f"x{s}"])).alias(f"u{s}") for s in (1, 2)],
        F.col("t.chars").alias("chars"),
        (F.col("q") + F.aggregate(before["chars"], F.lit(0).cast("long"), lambda a, x: a + x)).alias("before"),
        "size",
        *carried,
    )


def size_of_block() -> Column:
    return F.lit(BLOCK).cast("long")


def _blocks(turns: DataFrame) -> DataFrame:
    """Blocks of all conversations: digests before and after, turns, characters before."""
    keyed = turns.select(
        "conv_id",
        F.floor((F.col("pos") - 1) / size_of_block()).alias("k"),
        F.struct(
            "pos",
            F.xxhash64("h1", "h2", "pos").alias("x1"),
            F.xxhash64("pos", "h2", "h1").alias("x2"),
            "chars",
        ).alias("t"),
    )
    # At most BLOCK turns each.
    cut = keyed.groupBy("conv_id", "k").agg(
        F.sort_array(F.collect_list("t")).alias("turns"),
        F.bit_xor("t.x1").alias("b1"),
        F.bit_xor("t.x2").alias("b2"),
        F.sum("t.chars").alias("c"),
    )
    chained = running(cut, "conv_id", ["k"], sums=["c"], xors=["b1", "b2"], name="block-digests")
    return chained.select(
        "conv_id",
        "k",
        F.transform("turns", lambda t: F.struct(t["x1"].alias("x1"), t["x2"].alias("x2"), t["chars"].alias("chars"))).alias("turns"),
        F.size("turns").alias("m"),
        F.col("run_b1").bitwiseXOR(F.col("b1")).alias("p1"),
        F.col("run_b2").bitwiseXOR(F.col("b2")).alias("p2"),
        F.col("run_b1").alias("d1"),
        F.col("run_b2").alias("d2"),
        (F.col("run_c") - F.col("c")).alias("q"),
        "c",
    )


def _grouped(blocks: DataFrame, *more: Column) -> DataFrame:
    """One row per distinct block after the same blocks: members, smallest member, and ``more``."""
    grouped = blocks.groupBy("k", "p1", "p2", "d1", "d2", "m").agg(
        F.count("*").alias("size"),
        F.min("conv_id").alias("member"),
        F.min_by("turns", "conv_id").alias("turns"),
        F.min("q").alias("q"),
        *more,
    )
    ways = grouped.groupBy("k", "p1", "p2").agg(F.count("*").alias("ways"))
    return grouped.join(ways, ["k", "p1", "p2"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each node, comma-joined; rows come ordered by node and id."""
    now, digest = None, None

    def made(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [*NODE, "ends_sha256"])

    for batch in batches:
        done = []
        for *node, conv_id in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv_id")), strict=True):
            if node != now:
                if now is not None:
                    done.append((*now, digest.hexdigest()))
                now, digest = node, hashlib.sha256(str(conv_id).encode())
            else:
                digest.update(f",{conv_id}".encode())
        if done:
            yield made(done)
    if now is not None:
        yield made([(*now, digest.hexdigest())])


def _merged(blocks: DataFrame, carried: list[str], sums: list[str], firsts: list[str]) -> DataFrame:
    """Nodes of grouped blocks: straight runs as they are, boundaries where groups part combined."""
    cuts = keep(_cuts(blocks, *carried, "ways"), "turn-cuts")
    keys = [*NODE, "u1", "u2", "chars", "before", "size", *carried]
    straight = cuts.where("ways = 1").select(*keys)
    parted = cuts.where("ways > 1").groupBy(*NODE).agg(
        *[F.min(c).alias(c) for c in ("u1", "u2", "chars", "before")],
        F.sum("size").alias("size"),
        *[F.sum(c).alias(c) for c in sums],
        F.min("member").alias("member"),
        *[F.min_by(c, "member").alias(c) for c in firsts],
    )
    return straight.unionByName(parted)


def trie_of(turns: DataFrame, conv_ids: DataFrame) -> DataFrame:
    """The trie of numbered turns, see ``prefix_trie``; ``conv_ids`` are all its members."""
    blocks = keep(_blocks(turns), "blocks")
    totals = blocks.groupBy("conv_id").agg(
        F.sum("c").alias("total"),
        F.max_by(F.struct((F.col("k") * BLOCK + F.col("m")).cast("long").alias("depth"), F.col("d1").alias("n1"), F.col("d2").alias("n2")), "k").alias("end"),
    )
    nothing = F.lit(0).cast("long")
    members = keep(
        conv_ids.select("conv_id").distinct().join(totals, "conv_id", "left").select(
            "conv_id",
            F.coalesce("total", nothing).alias("total"),
            *[F.coalesce(f"end.{c}", nothing).alias(c) for c in NODE],
        ),
        "members",
    )

    # Members and children of every node; the root has no turns.
    nodes = _merged(_grouped(blocks), ["member"], [], [])
    root = members.agg(F.count("*").alias("size"), F.min("conv_id").alias("member")).where("size > 0")
    root = root.select(
        *[nothing.alias(c) for c in NODE], *[F.lit(None).cast("long").alias(c) for c in ("u1", "u2")],
        nothing.alias("chars"), nothing.alias("before"), "size", "member",
    )
    nodes = keep(nodes.unionByName(root), "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("u1").alias("n1"), F.col("u2").alias("n2"))
    children = children.agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", nothing))
    nodes = keep(nodes, "nodes-children")

    # A conversation owns the nodes whose smallest member it is: the last ones of its path.
    owned = nodes.groupBy(F.col("member").alias("conv_id")).agg(
        F.sum("chars").alias("own"), F.max(F.when(F.col("n_children") == 0, 1).otherwise(0)).cast("long").alias("leaf")
    )
    stats = members.join(owned, "conv_id", "left").select(
        "conv_id", "total", F.coalesce("own", nothing).alias("own"), F.coalesce("leaf", nothing).alias("leaf")
    )
    stats = keep(stats, "members-owned")

    # Totals over the members of every node, in the same way, and those of its smallest member.
    sums, firsts = ["totals", "owns", "leaves"], ["total", "own"]
    weighed = _grouped(
        blocks.join(stats, "conv_id"),
        F.sum("total").alias("totals"), F.sum("own").alias("owns"), F.sum("leaf").alias("leaves"),
        *[F.min_by(c, "conv_id").alias(c) for c in firsts],
    )
    weighed = _merged(weighed, ["member", *sums, *firsts], sums, firsts)
    at_root = stats.agg(
        F.count("*").alias("size"), F.sum("total").alias("totals"), F.sum("own").alias("owns"), F.sum("leaf").alias("leaves"),
        *[F.min_by(c, "conv_id").alias(c) for c in firsts],
    ).where("size > 0")
    at_root = at_root.select(*[nothing.alias(c) for c in [*NODE, "before"]], "size", *sums, *firsts)
    weighed = weighed.select(*at_root.columns).unionByName(at_root)
    # Over a subtree, the members' characters from here on, less those of every node once.
    spared = (F.col("totals") - F.col("size") * F.col("before")) - (
        F.col("owns") - F.col("own") + F.col("total") - F.col("before")
    )
    weighed = weighed.select(*NODE, F.col("leaves").alias("n_leaves"), spared.alias("saved_tokens"))

    ordered = members.select(*NODE, "conv_id").repartition(*NODE).sortWithinPartitions(*NODE, "conv_id")
    ends = ordered.mapInArrow(_digests, "depth long, n1 long, n2 long, ends_sha256 string")
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("n1").alias("u1"), F.col("n2").alias("u2"), F.col("member").alias("parent_conv_id")
    )
    return (
        nodes.join(weighed, NODE)
        .join(ends, NODE, "left")
        .join(parents, ["depth", "u1", "u2"], "left")
        .select(
            F.col("member").alias("conv_id"),
            "depth",
            "parent_conv_id",
            F.col("size").alias("n_convs"),
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of all conversations, a node being a sequence of first turns.

    ``conv_id`` is the node's smallest member and ``depth`` its number of turns, which name it
    together; ``parent_conv_id`` is the parent's ``conv_id``, null for the root. ``n_convs``
    counts members, ``n_children`` children, ``n_leaves`` the childless nodes of the subtree (the
    node itself if childless). ``saved_tokens`` sums, over the subtree, the code points of a
    node's last text for every member but one. ``ends_sha256`` digests the ids of the members
    that end here, ascending, comma-joined.

    Turns are compared by role and text, null being empty; they come by ``turn``, null first, and
    equal numbers in the order of a hash of role and text, so the result does not depend on the
    order of rows. A repeated row is a repeated turn. Rows without ``conv_id`` belong to no
    conversation. Other columns are ignored. An empty table has no nodes. Turns are told apart
    by 128-bit hashes; texts are read whole and never shuffled.
    """
    return trie_of(numbered_turns(turns), turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id")))


def with_shared_heads(turns: DataFrame) -> DataFrame:
    """Numbered turns of conversations that start like the first one of their hundred.

    Conversation c takes the first h turns of c - c % 100, as many as there are, in place of its
    own first h; h is the unsigned CRC-32 of its decimal id modulo ``HEADS``.
    """
    lengths = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    wanted = lengths.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 100).alias("base"), h.alias("h"))
    wanted = wanted.join(lengths.select(F.col("conv_id").alias("base"), "n"), "base", "left")
    wanted = keep(wanted.select("conv_id", "base", "h", F.least("h", F.coalesce("n", F.lit(0))).alias("taken")), "heads")
    shift = F.col("pos") - F.col("h") + F.col("taken")
    own = turns.join(wanted, "conv_id").where("pos > h").select("conv_id", shift.alias("pos"), "h1", "h2", "chars")
    # Few turns of one conversation in a hundred.
    first = turns.where((F.col("pos") < HEADS) & (F.col("conv_id") % 100 == 0)).withColumnRenamed("conv_id", "base")
    taken = first.join(wanted, "base").where("pos <= taken").select("conv_id", "pos", "h1", "h2", "chars")
    return own.unionByName(taken)


def op12_conversation_trie(spark, sf_dir: str) -> DataFrame:
    """Contract columns for the trie of all rebuilt conversations."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    numbered = numbered_turns(turns)
    return trie_of(with_shared_heads(numbered), numbered.select("conv_id"))


OP12_SQL = r"""
WITH t AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
        coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), c AS (
    SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(
        list_concat([4294967295], list_transform(range(strlen(CAST(conv_id AS VARCHAR))),
            lambda i: CAST(ascii(substr(CAST(conv_id AS VARCHAR), i + 1, 1)) AS BIGINT))),
        lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))
    ), 4294967295) % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)
), s AS (
    SELECT c.conv_id, h, least(h, count(t.pos)) AS taken FROM c LEFT JOIN t ON t.conv_id = c.base GROUP BY c.conv_id, h
), r AS (
    SELECT c.conv_id, t.pos, role, text FROM c JOIN t ON t.conv_id = c.base WHERE t.pos <= c.h
    UNION ALL
    SELECT conv_id, pos - h + taken, role, text FROM t JOIN s USING (conv_id) WHERE pos > h
), path AS (
    SELECT conv_id, pos AS depth, length(text) AS chars, md5(string_agg(md5(length(role) || ':' || role || text), '')
        OVER (PARTITION BY conv_id ORDER BY pos)) AS key FROM r
    UNION ALL SELECT conv_id, 0, 0, '' FROM c
), up AS (
    SELECT *, lag(key) OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
        depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM path
), node AS (
    SELECT depth, key, min(conv_id) AS conv_id, any_value(parent) AS parent, any_value(chars) AS chars, count(*) AS n_convs,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
    FROM up GROUP BY depth, key
), child AS (
    SELECT depth - 1 AS depth, parent AS key, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL
), full_node AS (
    SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (depth, key)
), tree AS (
    SELECT p.depth, p.key, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
        sum((f.n_convs - 1) * f.chars) AS saved_tokens
    FROM full_node f JOIN path p ON p.conv_id = f.conv_id AND p.depth <= f.depth GROUP BY p.depth, p.key
)
SELECT f.conv_id, f.depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
    CAST(saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_node f JOIN tree USING (depth, key) LEFT JOIN node u ON u.depth = f.depth - 1 AND u.key = f.parent
"""

"""Sharding on a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import window as W

from wattloom.llm.store import keep

#: Cells of the ring. Texts fall on cells, and cells are what is placed.
CELLS = 2**14
#: Parts into which a text is split whose copies hold more than 1/64 of a shard, and a cell that
#: holds so much is split by its other texts.
SPLITS = 256


def _ring(n_shards: int, vnodes: int) -> list[list[int]]:
    """For each cell, the shards in the order in which their virtual nodes come clockwise."""
    nodes = sorted(
        (zlib.crc32(f"shard {s} node {v}".encode()) % CELLS, s) for s in range(n_shards) for v in range(vnodes)
    )
    after: list[tuple[int, ...]] = [()] * len(nodes)
    order: tuple[int, ...] = tuple(dict.fromkeys(s for _, s in nodes))
    for i in range(len(nodes) - 1, -1, -1):
        order = (nodes[i][1], *(s for s in order if s != nodes[i][1]))
        after[i] = order
    # A second turn makes the order right for the nodes before the wrap.
    for i in range(len(nodes) - 1, -1, -1):
        order = (nodes[i][1], *(s for s in order if s != nodes[i][1]))
        after[i] = order
    found, i = [], 0
    for cell in range(CELLS):
        while i < len(nodes) and nodes[i][0] < cell:
            i += 1
        found.append(list(after[i % len(nodes)]))
    return found


def place(units: list[Row], n_shards: int, vnodes: int, slack: float) -> list[tuple[int, int, int, int]]:
    """``cell, split, shard, first slot`` of each unit, the largest units first.

    A unit goes to the first shard clockwise that has room; where none has, to the least
    loaded. The load bound is the mean plus ``slack``.
    """
    ring, load, slots = _ring(n_shards, vnodes), [0] * n_shards, [0] * n_shards
    bound = sum(u.bytes for u in units) * (1 + slack) / n_shards
    placed = []
    for u in sorted(units, key=lambda u: (-u.bytes, u.cell, u.split)):
        shard = next((s for s in ring[u.cell] if load[s] + u.bytes <= bound), None)
        if shard is None:
            shard = min(ring[u.cell], key=load.__getitem__)
        placed.append((u.cell, u.split, shard, slots[shard]))
        load[shard] += u.bytes
        slots[shard] += u.rows
    return placed


def shard_documents(docs: DataFrame, n_shards: int = 8, vnodes: int = 128, slack: float = 0.002) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: shards of nearly equal bytes.

    The place of a text on the ring is a hash of the text, so equal texts share a shard unless
    they alone are over 1/64 of one; then they are split by a hash of doc_id. The other texts of
    a cell over 1/64 of a shard are placed apart from each other, the copies of each together.
    ``size`` is the UTF-8 bytes plus 1, a null text counts as an empty one, and a null doc_id is
    an id like others. Repeated rows each get a slot. The driver handles one total per cell and
    per part of a large one, a number that does not grow with the data.
    """
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = docs.select(
        "doc_id",
        (F.length(data).cast("long") + 1).alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.pmod(F.xxhash64(data), F.lit(CELLS)).cast("int").alias("cell"),
        F.xxhash64(data, F.lit("order")).alias("text_hash"),
    )
    rows = keep(rows, "shard-rows")
    totals = (F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    cells = rows.groupBy("cell").agg(*totals).collect()
    share = 64 * n_shards
    most_bytes, most_rows = sum(c.bytes for c in cells) / share, sum(c.rows for c in cells) / share
    heavy = F.col("cell").isin([c.cell for c in cells if c.bytes > most_bytes])
    by_text = rows.where(heavy).groupBy("cell", "text_hash").agg(F.sum("size").alias("bytes"))
    hot = by_text.where(F.col("bytes") > most_bytes).select("cell", "text_hash").collect()  # fewer than share rows
    hot = [(*r, i) for i, r in enumerate(sorted(hot), 1)]
    hot = F.broadcast(docs.sparkSession.createDataFrame(hot, "cell int, text_hash long, hot int"))
    by_doc = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(SPLITS)).cast("int")
    split = F.when(F.col("hot").isNotNull(), F.col("hot") * SPLITS + by_doc)
    split = split.when(heavy, F.pmod("text_hash", F.lit(SPLITS)).cast("int")).otherwise(0)
    rows = rows.join(hot, ["cell", "text_hash"], "left").withColumn("split", split)
    # At most CELLS + 2 * share * SPLITS units.
    units = rows.groupBy("cell", "split").agg(*totals).collect()

    # Units of many rows are numbered in pieces; they are placed whole.
    unit = F.col("split").cast("long") * CELLS + F.col("cell")
    crowded = unit.isin([u.split * CELLS + u.cell for u in units if u.rows > max(most_rows, 1)])
    rows = rows.withColumn("salt", F.when(crowded, by_doc).otherwise(0))
    pieces: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for r in rows.where(crowded).groupBy("cell", "split", "salt").agg(F.count("*").alias("rows")).collect():
        pieces.setdefault((r.cell, r.split), []).append((r.salt, r.rows))
    placed = []
    for cell, at, shard, first in place(units, n_shards, vnodes, slack):
        for salt, n in sorted(pieces.get((cell, at), [(0, 0)])):
            placed.append((cell, at, salt, shard, first))
            first += n
    placed = docs.sparkSession.createDataFrame(placed, "cell int, split int, salt int, shard int, first long")
    in_piece = W.Window.partitionBy("cell", "split", "salt").orderBy("text_hash", "doc_id", "size")
    numbered = rows.withColumn("nth", F.row_number().over(in_piece))
    # At most CELLS + 3 * share * SPLITS rows.
    return numbered.join(F.broadcast(placed), ["cell", "split", "salt"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("nth") - 1).alias("slot")
    )


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    """Contract columns for all documents in 8 shards by the law ``bytes``."""
    sharded = shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

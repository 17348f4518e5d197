"""Total order with a position, as sorted outputs need it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.lineage import cut

PART, PLACE = "_part", "_place"


def with_position(df: DataFrame, keys: Sequence[str], *, name: str = "position") -> DataFrame:
    """``df`` in the order of ``keys``, nulls first, with the 0-based rank of every row.

    Rows that agree in ``keys`` are ordered by the remaining columns, so equal rows are the only
    ones that may change places, and a key that many rows share is spread like any other. The
    result is partitioned by range and sorted inside partitions: written as it is, its files read
    one after the other are the sorted table.

    A window over everything would be one task. Here rows are counted per range after one
    shuffle, and the count of all ranges before is added: one number per partition passes
    through the driver. The sorted rows are kept, so that both steps see the same ranges. An
    empty table stays empty.
    """
    if name in df.columns or PART in df.columns or PLACE in df.columns:
        raise ValueError(f"the columns {name}, {PART} and {PLACE} must be free")
    order = [*keys, *(c for c in df.columns if c not in keys)]
    columns = [F.col(f"`{c}`") for c in order]
    ranged = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    # The id holds the partition above 33 bits and the place in it below.
    number = F.monotonically_increasing_id()
    placed = cut(
        ranged.withColumn(PART, F.shiftright(number, 33).cast("int")).withColumn(
            PLACE, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
        )
    )
    sizes = {r[PART]: r["count"] for r in placed.groupBy(PART).count().collect()}
    before, total = [], 0
    for part in range(max(sizes, default=-1) + 1):
        before.append(total)
        total += sizes.get(part, 0)
    offsets = F.expr(f"array({', '.join(f'{n}L' for n in before) or '0L'})")
    position = F.get(offsets, F.col(PART)) + F.col(PLACE)
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], position.alias(name))

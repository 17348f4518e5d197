"""Running totals inside ordered groups, without a task that holds a group.

Rows are range-partitioned by group and order, each partition is read once in order, and what a
group has gathered in earlier partitions is added afterwards: one small row per partition.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.store import keep

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PART, ROW, OPEN = "scan_part", "scan_row", "scan_open"


def _scan(
    group: str, sums: Sequence[str], xors: Sequence[str]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen, last, first_group = 0, None, True
        carried = {c: np.zeros(1, np.int64)[0] for c in (*sums, *xors)}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column(group)
            begins = np.zeros(n, bool)
            begins[1:] = pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            begins[0] = seen > 0 and keys[0].as_py() != last
            starts = np.flatnonzero(begins)
            owner = np.cumsum(begins)  # 0 for rows of the group that the batch before ended in
            columns = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            for c in (*sums, *xors):
                values = batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                total = np.cumsum(values) if c in sums else np.bitwise_xor.accumulate(values)
                before = np.empty(len(starts) + 1, np.int64)
                before[1:] = total[starts - 1] if len(starts) else 0
                if len(starts) and starts[0] == 0:
                    before[1] = 0
                if c in sums:
                    before[0] = -carried[c]
                    total = total - before[owner]
                else:
                    before[0] = carried[c]
                    total = total ^ before[owner]
                carried[c] = total[-1]
                columns[f"run_{c}"] = pa.array(total)
            columns[PART] = pa.array(np.full(n, part, np.int32))
            columns[ROW] = pa.array(np.arange(seen, seen + n, dtype=np.int64))
            columns[OPEN] = pa.array((owner == 0) & first_group)
            first_group = first_group and not len(starts)
            seen, last = seen + n, keys[n - 1].as_py()
            yield pa.RecordBatch.from_pydict(columns)

    return run


def running(
    df: DataFrame, group: str, order: Sequence[str], *, sums: Sequence[str] = (), xors: Sequence[str] = (), name: str = "scan"
) -> DataFrame:
    """``df`` with ``run_<c>`` of each named long column: its total up to and with the row.

    Totals are sums or exclusive ors over the rows of the same ``group`` (not null) in ``order``.
    Rows that are equal in group and order count in any order, so ``order`` should tell rows
    apart where it matters. No column may be null. Columns ``scan_*`` are taken.

    The rows of a large group are spread over partitions; the driver sees two short rows for
    each partition. The rows are written once.
    """
    spark, totals = df.sparkSession, [*sums, *xors]
    ordered = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    added = ", ".join([*(f"run_{c} long" for c in totals), f"{PART} int", f"{ROW} long", f"{OPEN} boolean"])
    declared = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    local = keep(ordered.mapInArrow(_scan(group, sums, xors), f"{declared}, {added}"), name)
    ends = local.groupBy(PART).agg(
        F.min_by(group, ROW).alias("first"),
        F.max_by(F.struct(F.col(group).alias("last"), F.col(OPEN).alias("whole"), *[f"run_{c}" for c in totals]), ROW).alias("end"),
    )
    carry, carries = None, []  # (group, totals so far)
    for r in sorted(ends.collect(), key=lambda r: r[PART]):
        came = carry[1] if carry is not None and carry[0] == r["first"] else None
        if came is not None:
            carries.append((r[PART], *came))
        end = [r["end"][f"run_{c}"] for c in totals]
        if came is not None and r["end"]["whole"]:
            end = [a + b if c in sums else a ^ b for c, a, b in zip(totals, came, end, strict=True)]
        carry = (r["end"]["last"], end)
    if not carries:
        return local.drop(PART, ROW, OPEN)
    schema = f"part int, {', '.join(f'carry_{i} long' for i in range(len(totals)))}"
    # A row per partition at most.
    joined = local.join(F.broadcast(spark.createDataFrame(carries, schema)), (F.col(PART) == F.col("part")) & F.col(OPEN), "left")
    fixed = {}
    for i, c in enumerate(totals):
        came = F.coalesce(f"carry_{i}", F.lit(0))
        fixed[f"run_{c}"] = F.col(f"run_{c}") + came if c in sums else F.col(f"run_{c}").bitwiseXOR(came)
    return joined.withColumns(fixed).select(*df.columns, *[f"run_{c}" for c in totals])

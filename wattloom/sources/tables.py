"""Table sources and sinks: JDBC and file formats behind one pair of functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Fixed value: rows per JDBC insert batch for the large outputs.
BATCH_ROWS = 10_000_000


@dataclass(frozen=True)
class RangePartition:
    """Splits a scan into ``count`` strides of a numeric column. The bounds do not filter."""

    column: str
    lower: int
    upper: int
    count: int


def read_options(
    table: str,
    *,
    url: str,
    partition: RangePartition | None = None,
    options: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a JDBC scan. ``table`` may be a parenthesised query with an alias."""
    merged = {"url": url, "dbtable": table, **(options or {})}
    if partition is not None:
        merged |= {
            "partitionColumn": partition.column,
            "lowerBound": str(partition.lower),
            "upperBound": str(partition.upper),
            "numPartitions": str(partition.count),
        }
    return merged


def read_table(
    spark: SparkSession,
    table: str,
    *,
    format: str = "parquet",
    url: str | None = None,
    partition: RangePartition | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table as a DataFrame: ``table`` is a path, or a table or query for JDBC.

    Filters and column choices made later reach the scan in both cases. A large JDBC table
    should always come with a ``partition``, since a scan without one is a single task.
    """
    if format != "jdbc":
        if url is not None or partition is not None:
            raise ValueError("url and partition belong to the jdbc format")
        return spark.read.format(format).options(**(options or {})).load(table)
    if url is None:
        raise ValueError("the jdbc format needs a url")
    scan = read_options(table, url=url, partition=partition, options=options)
    return spark.read.format("jdbc").options(**scan).load()


def write_table(
    df: DataFrame,
    table: str,
    *,
    format: str = "parquet",
    url: str | None = None,
    mode: str = "errorifexists",
    width: int | None = None,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    batch_rows: int | None = None,
    replace_partitions: bool = False,
    options: Mapping[str, str] | None = None,
) -> int:
    """Writes a DataFrame and returns its number of rows, which the writing job itself counts.

    ``replace_partitions`` overwrites only the directories that ``df`` has rows for, so a write
    that is repeated leaves the same table; it needs ``partition_by``.

    ``width`` is the number of writers, which matters for a database with few connections; the
    stage before keeps its tasks, and files are best left to AQE. ``partition_by`` lays files out in directories and brings the
    rows of a directory together first, so that each task does not open every directory.
    ``sort_by`` gives a total order by range partitioning.
    """
    if replace_partitions and (not partition_by or format == "jdbc"):
        raise ValueError("partitions can only be replaced in a partitioned file table")
    if partition_by and format != "jdbc":
        # The rebalance splits a large directory over several tasks.
        df = df.hint("rebalance", *partition_by)
    if width is not None:
        # A shuffle, since narrowing the last stage would also narrow the work before the sink.
        df = df.repartitionByRange(width, *sort_by) if sort_by else df.repartition(width)
        df = df.sortWithinPartitions(*sort_by) if sort_by else df
    elif sort_by:
        df = df.sortWithinPartitions(*sort_by) if partition_by else df.orderBy(*sort_by)
    if format == "jdbc" and url is None:
        raise ValueError("the jdbc format needs a url")
    seen = Observation()
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = df.write.mode("overwrite" if replace_partitions else mode).format(format).options(**(options or {}))
    if format != "jdbc":
        if replace_partitions:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(table)
        return seen.get["rows"]
    writer = writer.option("url", url).option("dbtable", table)
    if batch_rows is not None:
        writer = writer.option("batchsize", batch_rows)
    writer.save()
    return seen.get["rows"]

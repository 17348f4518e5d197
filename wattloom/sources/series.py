"""Plain ``id,value`` series files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Text of a missing value and the number that stands for one.
NULL_TEXT = "null"
SENTINEL = -999.0


def _without_sentinel(value: Column, sentinel: float | None) -> Column:
    return value if sentinel is None else F.when(value != sentinel, value)


def read_series_csv(
    spark: SparkSession,
    path: str,
    *,
    value: str = "value",
    with_id: bool = True,
    sentinel: float | None = SENTINEL,
) -> DataFrame:
    """Series files with ``id,value`` lines, or values only, with ``null`` for a missing value.

    Large files are split by range, and a filter on ``id`` reaches the parser, which then leaves
    other lines unread beyond their first field.
    """
    schema = f"id long, {value} double" if with_id else f"{value} double"
    rows = spark.read.csv(path, schema=schema, nullValue=NULL_TEXT)
    return rows.withColumn(value, _without_sentinel(F.col(value), sentinel))


def write_series_csv(rows: DataFrame, path: str, *, key: str = "id", value: str = "value") -> None:
    """``id,value`` lines of two columns, a null value as ``null``."""
    text = F.coalesce(F.col(value).cast("string"), F.lit(NULL_TEXT))
    rows.select(F.concat_ws(",", F.col(key).cast("string"), text).alias("value")).write.text(path)


def series_from_lines(
    lines: DataFrame, column: str, *, value: str = "value", sentinel: float | None = SENTINEL
) -> DataFrame:
    """The same parse for lines that are already a column, for example from a log table."""
    parsed = F.from_csv(F.col(column), f"id long, {value} double", {"nullValue": NULL_TEXT})
    rows = lines.select(parsed.alias("_row")).select("_row.id", f"_row.{value}")
    return rows.withColumn(value, _without_sentinel(F.col(value), sentinel))

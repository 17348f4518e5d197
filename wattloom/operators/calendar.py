"""Calendar dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.timegrid import slot_dti, timestamp_of
from wattloom.settings import DAYTYPES, DEFAULTS, LOAD_TYPES, SEASONS, SLOTS_PER_DAY


#: A hundred years.
MOST_DAYS = 36_525


def _intervals(ids: DataFrame, epoch: dt.date) -> DataFrame:
    return ids.select(
        "datetimeintervalid",
        F.lit(None).cast("timestamp_ntz").alias("start"),
        timestamp_of(F.col("datetimeintervalid"), epoch).alias("end"),
    )


def interval_calendar(
    spark: SparkSession,
    days: int = DEFAULTS.calendar_days,
    epoch: dt.date = DEFAULTS.epoch,
) -> DataFrame:
    """Interval dimension of ``days`` whole days from the epoch, generated on the executors."""
    ids = spark.range(1, days * SLOTS_PER_DAY + 1).withColumnRenamed("id", "datetimeintervalid")
    return _intervals(ids, epoch)


def interval_calendar_of(
    readings: DataFrame,
    epoch: dt.date = DEFAULTS.epoch,
    *,
    first: dt.date | None = None,
    last: dt.date | None = None,
    most_days: int = MOST_DAYS,
) -> DataFrame:
    """Interval dimension for every whole day between the first and last reading.

    The span is one aggregated row, exploded to days, dealt out and exploded to slots, so
    nothing is collected and the calendar always covers the fact table it is joined with.
    ``first`` and ``last`` bound the span. Without them a span of more than ``most_days`` is an
    error when the calendar is read, so one bad timestamp cannot stretch it unseen.
    """
    day = F.col("ts").cast("date")
    if first is not None:
        readings = readings.filter(day >= F.lit(first))
    if last is not None:
        readings = readings.filter(day <= F.lit(last))
    span = readings.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    too_long = F.raise_error(F.concat_ws(" ", F.lit("the readings span"), "first", F.lit("to"), "last"))
    dates = F.when(F.date_diff("last", "first") < most_days, F.sequence("first", "last"))
    dates = dates.otherwise(too_long.cast("array<date>"))
    days = span.filter("first IS NOT NULL").select(F.explode(dates).alias("day"))
    days = days.repartition("day")
    slots = days.select("day", F.explode(F.sequence(F.lit(1), F.lit(SLOTS_PER_DAY))).alias("idx"))
    ids = slots.select(slot_dti(F.col("day"), F.col("idx"), epoch).alias("datetimeintervalid"))
    return _intervals(ids, epoch)


def _names(values: tuple[str, ...], position: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), position.cast("int"))


def season_daytype_labels(spark: SparkSession) -> DataFrame:
    """The 12 season-daytype labels keyed by ``sdti``."""
    n = len(DAYTYPES)
    base = spark.range(len(SEASONS) * n)
    se, dy = F.floor(F.col("id") / n), F.col("id") % n
    return base.select(
        (F.col("id") + 1).cast("int").alias("sdti"),
        (se + 1).cast("int").alias("season"),
        (dy + 1).cast("int").alias("daytype"),
        F.concat_ws("-", _names(SEASONS, se), _names(DAYTYPES, dy)).alias("label"),
    )


def calendar_labels(spark: SparkSession) -> DataFrame:
    """The 36 load type x season x daytype labels."""
    kinds = F.posexplode(F.array(*[F.lit(v) for v in LOAD_TYPES])).alias("pos", "kind")
    return season_daytype_labels(spark).select("*", kinds).select(
        (F.col("pos") + 1).alias("loadtype"),
        "sdti",
        "season",
        "daytype",
        F.concat_ws("-", "kind", "label").alias("label"),
    )

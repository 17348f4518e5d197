"""Wide day curves to long readings and back, and long readings to phase-wide readings."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.codes import date_text
from wattloom.functions.timegrid import bucket, slot_dti, slot_timestamp
from wattloom.settings import (
    CURVE_FAMILIES,
    DAY_CURVES,
    DEFAULTS,
    POWER_TYPES,
    SLOTS_PER_DAY,
)


def unpivot_curve(
    wide: DataFrame,
    value: str,
    *,
    prefix: str | None = None,
    flag: str | None = None,
    date: str = "data_date",
    epoch: dt.date = DEFAULTS.epoch,
) -> DataFrame:
    """96 slot columns to rows ``id, ts, dti, flag, value``.

    One scan of the wide table and no shuffle: ``stack`` emits the slot number as an integer
    next to the value inside whole-stage codegen. Null slots are kept, so a missing reading
    stays visible to the quality rules.
    """
    family_prefix, family_flag = CURVE_FAMILIES.get(value, (prefix, flag))
    prefix, flag = prefix or family_prefix, flag or family_flag
    cells = ", ".join(f"{n}, {prefix}{n}" for n in range(1, SLOTS_PER_DAY + 1))
    stacked = f"stack({SLOTS_PER_DAY}, {cells}) AS (_idx, {value})"
    day, idx = F.col(date), F.col("_idx")
    return wide.selectExpr("id", date, flag, stacked).select(
        "id",
        slot_timestamp(day, idx).alias("ts"),
        slot_dti(day, idx, epoch).alias("dti"),
        flag,
        value,
    )


def phase_pivot(
    long: DataFrame, value: str, columns: Mapping[int, str], *, flag: str = "phase_flag"
) -> DataFrame:
    """One row per ``id, ts, dti`` with the largest reading of each flag in its own column.

    Partial maxima are built before the shuffle, so copies of one reading never travel.
    """
    cells = [F.max(F.when(F.col(flag) == n, F.col(value))).alias(name) for n, name in columns.items()]
    return long.groupBy("id", "ts", "dti").agg(*cells)


def power_pivot(power: DataFrame) -> DataFrame:
    """Power types 1..8 as ``psum, pa..pc, qsum, qa..qc``."""
    return phase_pivot(power, "power", POWER_TYPES, flag="data_type")


def slot_columns(
    rows: DataFrame, by: Sequence[str], slot: str, value: str, names: Mapping[int, str]
) -> DataFrame:
    """Largest value per slot number for each ``by``, one column per entry of ``names``.

    Each cell is reduced to its largest value first, as a narrow row, and the cells of a group are
    brought together before they are laid out. Wide partial rows would fill the memory of a task
    that meets many groups with few readings each, as when the readings of many meters come mixed.
    ``pivot`` would scatter the slots over all reducers and shuffle mostly empty wide rows.
    """
    cells = rows.groupBy(*by, slot).agg(F.max(value).alias(value)).repartition(*by)
    columns = [F.expr(f"max(CASE WHEN {slot} = {n} THEN {value} END) AS {c}") for n, c in names.items()]
    return cells.groupBy(*by).agg(*columns)


def day_curve_pivot(summary: DataFrame, code: str, *, first_bucket: int = 2) -> DataFrame:
    """Reading summary of one measurement code to one row per meter and date, 96 columns.

    Column ``n`` holds the largest value whose bucket is ``(n + first_bucket) mod 96``.
    ``first_bucket=1`` lines column ``n`` up with slot ``n + 1`` of ``unpivot_curve``.
    """
    prefix, flag, flag_value = DAY_CURVES[code]
    names = {n: f"{prefix}{n}" for n in range(SLOTS_PER_DAY)}
    rows = summary.filter(F.col("code") == code).select(
        "meterid",
        F.col("mtime").cast("date").alias("mdate"),
        bucket(F.col("datetimeintervalid") - first_bucket).cast("int").alias("_slot"),
        "value",
    )
    cells = slot_columns(rows, ["meterid", "mdate"], "_slot", "value", names)
    return cells.select(
        "meterid",
        date_text(F.col("mdate")).alias("mdate"),
        F.lit(flag_value).alias(flag),
        F.lit(1).alias("data_point_flag"),
        F.lit(1).alias("data_whole_flag"),
        *names.values(),
    )

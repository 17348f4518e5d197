"""The star schema: reading types, base readings, meter dimensions, reading summary."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.settings import BASEREADING_CHANNELS, DEFAULTS, FAMILY_COLUMNS

_KEYS = (("meter", "long"), ("timeperiod", "long"), ("value", "double"))

# Phase names are told apart by this pattern.
_PHASE_PATTERNS = {"none": "%none%", "A": "%A", "B": "%B", "C": "%C"}


def _channels() -> list[tuple[str, int, str, str]]:
    return [
        (family, flag, code, phase)
        for family, flags in BASEREADING_CHANNELS.items()
        for flag, (code, phase) in flags.items()
    ]


def reading_types(readingtype: DataFrame, phase: DataFrame, measurementkind: DataFrame) -> DataFrame:
    """Reading type id of each of the 20 channels: ``family, flag, code, phase, readingtypeid``.

    Only types without a time of use count. The smallest id wins when several match.
    """
    spark = readingtype.sparkSession
    # An inline table: Spark knows its size and needs no job to ship it.
    rows = ", ".join(
        f"('{family}', {flag}, '{code}', '{phase}', '{_PHASE_PATTERNS[phase]}')"
        for family, flag, code, phase in _channels()
    )
    wanted = spark.sql(f"SELECT * FROM VALUES {rows} AS t(family, flag, code, phase, pattern)")
    named = (
        readingtype.filter("tou IS NULL")
        .join(phase.select(F.col("phasecode").alias("phases"), F.col("code").alias("phasename")), "phases")
        .join(
            measurementkind.select(F.col("measurementkindid").alias("measurementkind"), "code"),
            "measurementkind",
        )
    )
    matched = named.join(F.broadcast(wanted), "code").filter("phasename LIKE pattern")
    return matched.groupBy("family", "flag", "code", "phase").agg(
        F.min("readingtypeid").cast("long").alias("readingtypeid")
    )


def _channel_rows(long: DataFrame, family: str) -> DataFrame:
    value, flag = FAMILY_COLUMNS[family]
    return long.select(
        F.lit(family).alias("family"),
        F.col(flag).cast("int").alias("flag"),
        F.col("id").cast("long").alias("meter"),
        F.col("dti").cast("long").alias("timeperiod"),
        F.col(value).cast("double").alias("value"),
    ).na.drop("any")


def stacked_basereading(
    rows: DataFrame, types: DataFrame, families: Iterable[str] = tuple(FAMILY_COLUMNS)
) -> DataFrame:
    """The fact table of rows that carry several quantities at once, in one scan.

    ``rows`` has ``id, dti``, the flags and the value columns of the families.
    """
    wanted = [f for f in families if f in FAMILY_COLUMNS]
    cells = ", ".join(
        f"'{f}', CAST({flag} AS INT), CAST({value} AS DOUBLE)" for f in wanted for value, flag in [FAMILY_COLUMNS[f]]
    )
    long = rows.selectExpr(
        "CAST(id AS LONG) AS meter", "CAST(dti AS LONG) AS timeperiod", f"stack({len(wanted)}, {cells}) AS (family, flag, value)"
    )
    return _facts(long.na.drop("any"), types)


def basereading(families: Mapping[str, DataFrame], types: DataFrame) -> DataFrame:
    """Long readings by family (V, A, PF, P, E) as rows of the fact table.

    The families are stacked and meet ``types``, the at most 20 rows of ``reading_types``,
    in one broadcast join, so the facts are not shuffled. Null values and flags without a
    type give no row; neither does an unknown family.
    """
    known = [_channel_rows(long, family) for family, long in families.items() if family in FAMILY_COLUMNS]
    if not known:
        # No channel of the map matches, so nothing can come out of the join.
        known = [types.select("family", "flag", *[F.lit(None).cast(t).alias(n) for n, t in _KEYS]).limit(0)]
    return _facts(reduce(DataFrame.union, known), types)


def _facts(long: DataFrame, types: DataFrame) -> DataFrame:
    """Channel rows with their reading type; there are at most 20 types."""
    joined = long.join(F.broadcast(types.select("family", "flag", "readingtypeid")), ["family", "flag"])
    return joined.select(
        "meter",
        "timeperiod",
        F.col("readingtypeid").alias("readingtype"),
        F.lit(None).cast("long").alias("reason"),
        F.lit(None).cast("timestamp_ntz").alias("reporteddatatime"),
        "value",
        F.lit(None).cast("string").alias("source"),
    )


def to_basereading(long: DataFrame, family: str, types: DataFrame) -> DataFrame:
    """One family of ``basereading``."""
    return basereading({family: long}, types)


def meter_dims(readings: DataFrame) -> dict[str, DataFrame]:
    """Dimension tables of the distinct meter ids: ``identifiedobject, enddevice, meter``."""
    ids = readings.select(F.col("id").cast("long").alias("id")).distinct()

    def blank(name: str, kind: str):
        return F.lit(None).cast(kind).alias(name)

    return {
        "identifiedobject": ids.select(
            F.col("id").alias("identifiedobjectid"),
            blank("aliasname", "string"),
            F.lit("meter").alias("description"),
            blank("mrid", "string"),
            blank("name", "string"),
        ),
        "enddevice": ids.select(
            F.col("id").alias("enddeviceid"),
            blank("ispan", "boolean"),
            blank("isvirtual", "boolean"),
            blank("timezoneoffset", "double"),
            blank("usagepoint", "long"),
            blank("enddeviceinfo", "long"),
            blank("servicelocation", "long"),
            blank("customer", "long"),
            blank("assetcontainerid", "long"),
            blank("installcode", "string"),
            blank("amrsystem", "string"),
        ),
        "meter": ids.select(
            F.col("id").alias("meterid"), blank("formnumber", "string"), blank("description", "string")
        ),
    }


def meter_range(
    rows: DataFrame,
    column: str = "meterid",
    *,
    first: int = DEFAULTS.station_first_meter,
    count: int = DEFAULTS.station_meters,
) -> DataFrame:
    """Rows of ``count`` consecutive meter ids."""
    return rows.filter(F.col(column).between(first, first + count - 1))


def for_meters(rows: DataFrame, meters: DataFrame | Iterable[int], column: str = "id") -> DataFrame:
    """Rows of the given meters: a short list of ids, or a table with an id column.

    A table of any size becomes a semi join, and Spark broadcasts it only when it is small.
    """
    if isinstance(meters, DataFrame):
        key = meters.columns[0]
        return rows.join(meters.select(F.col(key).alias(column)), column, "left_semi")
    return rows.filter(F.col(column).isin(list(meters)))


def star_readings(
    fact: DataFrame,
    meter: DataFrame,
    identifiedobject: DataFrame,
    readingtype: DataFrame,
    measurementkind: DataFrame,
    datetimeinterval: DataFrame,
    *,
    types: DataFrame | None = None,
) -> DataFrame:
    """Reading summary: ``meterid, datetimeintervalid, mtime, value, code, phases``.

    ``types``, the at most 20 rows of ``reading_types`` that the facts were built with, cuts the
    reading types before they meet the facts, so that join is a broadcast at any size and the
    facts are never dealt out by their few types.

    Valid meters are those known both as a meter and as an identified object. The small type
    dimensions are joined with each other first, so the fact table meets three inputs instead
    of five. Spark broadcasts each of them when its measured size allows and else shuffles,
    with skewed meters split by AQE.
    """
    valid = meter.select("meterid").join(
        identifiedobject.select(F.col("identifiedobjectid").alias("meterid")), "meterid", "left_semi"
    )
    kinds = readingtype.select(
        F.col("readingtypeid").alias("readingtype"), "phases", F.col("measurementkind").alias("_kind")
    ).join(
        measurementkind.select(F.col("measurementkindid").alias("_kind"), "code"), "_kind"
    )
    if types is not None:
        used = types.select(F.col("readingtypeid").alias("readingtype"))
        kinds = F.broadcast(kinds.join(F.broadcast(used), "readingtype", "left_semi"))
    intervals = datetimeinterval.select(
        F.col("datetimeintervalid").alias("timeperiod"), F.col("end").alias("mtime")
    )
    readings = fact.select(F.col("meter").alias("meterid"), "timeperiod", "readingtype", "value")
    return (
        readings.join(valid, "meterid")
        .join(kinds, "readingtype")
        .join(intervals, "timeperiod")
        .select(
            "meterid",
            F.col("timeperiod").alias("datetimeintervalid"),
            "mtime",
            "value",
            "code",
            "phases",
        )
    )

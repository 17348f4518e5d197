"""Meter tables derived from the benchmark tables.

``lineitem`` becomes a set of 15, 30 and 60 minute meters, one per ten suppliers, so the
density per meter is the same at every scale. Values are exact decimals, as meter feeds
deliver them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.timegrid import daytype, sdti, season, slot_dti, slot_timestamp
from wattloom.operators.calendar import interval_calendar_of
from wattloom.operators.reshape import slot_columns
from wattloom.settings import CURVE_FAMILIES, SLOTS_PER_DAY

EPOCH = dt.date(2013, 1, 1)

# Small dimensions of the star schema.
MEASUREMENT_KINDS = {1: "V", 2: "A", 3: "P", 4: "Q", 5: "PF", 6: "EP", 7: "EQ"}
PHASE_NAMES = {0: "none", 1: "phaseA", 2: "phaseB", 3: "phaseC"}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Ten suppliers share a meter; ids start at 1.
_METER = "(suppkey - 1) div 10 + 1"


def _level(quantity: int) -> int:
    """Tenths of a volt of a quantity of 0 to 50: dead, the 110 V system, low, or normal."""
    if quantity <= 12:
        return 0
    if quantity <= 16:
        return 600 + 10 * quantity
    return 1200 + 20 * quantity if quantity <= 20 else 1800 + 14 * quantity


# Both are constants of the plan. Operators filter on what follows from them, and a lookup stays
# small however often a filter repeats it.
_VOLTS = f"array({', '.join(f'CAST({_level(q) / 10} AS DECIMAL(8,4))' for q in range(51))})"
_DAYS = f"array({', '.join(f'{n // 7 * 91 + n % 7}' for n in range(28))})"


def readings(spark: SparkSession, sf_dir: str, *, folded: bool = True) -> DataFrame:
    """One row per line item: ``id, day, idx, ts, dti``, flags and all five quantities.

    Every 97th reading has no voltage and every 89th no power, as meter feeds have gaps.
    ``folded`` puts the ship dates into one full week in each of four months; otherwise the
    days run on as the ship dates do.
    """
    day = f"get({_DAYS}, dd)" if folded else "dd"
    dd = "datediff(l_shipdate, DATE '1992-01-01')"
    dd = "pmod(datediff(l_shipdate, DATE '1995-01-01'), 28)" if folded else dd
    full = _table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS orderkey",
        "l_partkey AS partkey",
        "l_suppkey AS suppkey",
        "l_linenumber AS line",
        "CAST(l_quantity AS INT) AS q",
        "CAST(l_extendedprice AS DECIMAL(10,2)) AS price",
        "CAST(l_discount AS DECIMAL(4,2)) AS discount",
        "CAST(l_tax AS DECIMAL(4,2)) AS tax",
        f"{dd} AS dd",
    )
    flagged = full.selectExpr(
        f"{_METER} AS id",
        "7 * orderkey + 13 * line AS h",
        f"date_add(DATE '2013-01-01', CAST({day} AS INT)) AS day",
        "CAST(line % 4 AS INT) AS phase_flag",
        "CAST(partkey % 8 + 1 AS INT) AS data_type",
        f"get({_VOLTS}, q) AS volt",
        "CAST(price * 0.0001 AS DECIMAL(8,6)) AS power",
        "CAST(0.1 * q AS DECIMAL(8,4)) AS cur",
        "CAST(1 - discount AS DECIMAL(8,4)) AS pf",
        "CAST(price * (1 + tax) * 0.001 AS DECIMAL(12,7)) AS energy",
    )
    placed = flagged.selectExpr(
        "id",
        "day",
        # A slot, every second or every fourth one, by meter.
        "CAST(h * get(array(1, 4, 2), CAST(id % 3 AS INT)) % 96 + 1 AS INT) AS idx",
        "phase_flag",
        "data_type",
        "CASE WHEN h % 97 <> 0 THEN volt END AS volt",
        "CASE WHEN h % 89 <> 1 THEN power END AS power",
        "cur",
        "pf",
        "energy",
    )
    day, idx = F.col("day"), F.col("idx")
    return placed.select("*", slot_timestamp(day, idx).alias("ts"), slot_dti(day, idx, EPOCH).alias("dti"))


def family(rows: DataFrame, value: str) -> DataFrame:
    """Long reading of one quantity: ``id, ts, dti, flag, value``."""
    return rows.select("id", "ts", "dti", CURVE_FAMILIES[value][1], value)


def direct_curve(rows: DataFrame) -> DataFrame:
    """Readings themselves as the analysis curve: ``volt_c`` is ``volt``."""
    day = F.col("day")
    return rows.select(
        "id",
        "ts",
        F.col("volt").alias("volt_c"),
        "power",
        "dti",
        sdti(day).alias("sdti"),
        season(day).alias("season"),
        daytype(day).alias("daytype"),
    )


def wide_curve(rows: DataFrame, value: str) -> DataFrame:
    """Readings as a wide day curve: ``id, data_date``, flag and 96 slot columns."""
    prefix, flag = CURVE_FAMILIES[value]
    names = {n: f"{prefix}{n}" for n in range(1, SLOTS_PER_DAY + 1)}
    return slot_columns(rows.withColumnRenamed("day", "data_date"), ["id", "data_date", flag], "idx", value, names)


def weekly_volts(rows: DataFrame) -> DataFrame:
    """Largest voltage per meter, week and slot in wide form, so that complete rows exist."""
    names = {n: f"U{n}" for n in range(1, SLOTS_PER_DAY + 1)}
    week = F.date_trunc("week", "day").cast("date").alias("data_date")
    return slot_columns(rows.select("id", week, "idx", "volt"), ["id", "data_date"], "idx", "volt", names)


def meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meter dimension: the meters that the suppliers stand for."""
    suppliers = _table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS suppkey")
    return suppliers.selectExpr(f"{_METER} AS meterid").distinct()


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One category code per meter."""
    code = F.get(F.array(*[F.lit(t) for t in ("01", "02", "11", "99")]), (F.col("meterid") % 4).cast("int"))
    return meters(spark, sf_dir).select(F.col("meterid").alias("mped_id"), code.alias("mp_attr_code"))


def reading_type_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading types derived from the parts: several types per channel, some with time of use."""
    key = F.col("p_partkey")
    return _table(spark, sf_dir, "part").select(
        (key + 1).alias("readingtypeid"),
        (F.floor(key / 7) % 4).cast("int").alias("phases"),
        F.when(F.col("p_size") > 25, F.col("p_type")).alias("tou"),
        (key % 7 + 1).cast("int").alias("measurementkind"),
    )


def _inline(spark: SparkSession, values: dict[int, str], columns: str) -> DataFrame:
    rows = ", ".join(f"({number}, '{text}')" for number, text in values.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({columns})")


def measurement_kinds(spark: SparkSession) -> DataFrame:
    return _inline(spark, MEASUREMENT_KINDS, "measurementkindid, code")


def phases(spark: SparkSession) -> DataFrame:
    return _inline(spark, PHASE_NAMES, "phasecode, code")


def with_strangers(facts: DataFrame) -> DataFrame:
    """The facts, and readings of meters and of intervals that no dimension knows."""
    meter = facts.filter("timeperiod % 50 = 7").withColumn("meter", F.col("meter") + 1_000_000_000)
    period = facts.filter("timeperiod % 50 = 8").withColumn("timeperiod", F.col("timeperiod") + 100_000_000)
    return facts.unionByName(meter).unionByName(period)


def intervals(rows: DataFrame) -> DataFrame:
    return interval_calendar_of(rows, EPOCH)

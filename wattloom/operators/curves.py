"""Analysis curves: voltage against power, and the wide cross-validation table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.timegrid import daytype, sdti, season
from wattloom.settings import CURRENT_PHASES, FACTOR_PHASES, POWER_TYPES, VOLT_PHASES


def active_power(power: DataFrame) -> DataFrame:
    """Valid readings of total active power."""
    return power.filter("data_type = 1 AND power IS NOT NULL")


def reactive_power(power: DataFrame) -> DataFrame:
    """Valid readings of total reactive power."""
    return power.filter("data_type = 5 AND power IS NOT NULL")


def with_season(curve: DataFrame) -> DataFrame:
    """Season columns ``sdti, season, daytype`` of the timestamp."""
    ts = F.col("ts")
    return curve.withColumns({"sdti": sdti(ts), "season": season(ts), "daytype": daytype(ts)})


def _volt_power_curve(volts: DataFrame, power: DataFrame) -> DataFrame:
    # Both sides arrive at the join through a shuffle on (id, dti) that Spark adds itself, so
    # AQE can split a key with many power copies. They are all kept.
    joined = volts.select("id", "ts", "dti", "volt_c").join(
        power.select("id", "dti", "power"), ["id", "dti"]
    )
    return with_season(joined).select(
        "id", "ts", "volt_c", "power", "dti", "sdti", "season", "daytype"
    )


def pv_curve(volts: DataFrame, power: DataFrame) -> DataFrame:
    """Phase-wide voltage joined with total active power."""
    return _volt_power_curve(volts, active_power(power))


def qv_curve(volts: DataFrame, power: DataFrame) -> DataFrame:
    """Phase-wide voltage joined with total reactive power."""
    return _volt_power_curve(volts, reactive_power(power))


def _cells(flag: str, value: str, columns: dict[int, str]) -> list:
    return [F.max(F.when(F.col(flag) == n, F.col(value))).alias(c) for n, c in columns.items()]


def pqvcf(
    volt: DataFrame,
    power: DataFrame,
    cur: DataFrame,
    pf: DataFrame,
    *,
    phases: Sequence[str] = ("a", "c"),
) -> DataFrame:
    """Voltage, current, power and power factor of an interval in one row, 21 columns.

    Takes the four long readings. An interval needs voltage, power and current rows; power
    factor may be absent. Pivoting each input and joining the results would shuffle four
    tables and sort them for three joins. Here the inputs are stacked and one aggregation on
    ``(id, dti)`` does the pivots and the joins together, with partial maxima before the only
    shuffle. ``ts`` is a function of ``dti``, as ``unpivot_curve`` builds it.

    ``phases`` names the phases whose activity keeps a row.
    """
    stacked = (
        volt.select("id", "ts", "dti", F.col("phase_flag").alias("_v"), "volt")
        .withColumn("_has_volt", F.lit(True))
        .unionByName(
            power.select("id", "ts", "dti", F.col("data_type").alias("_p"), "power").withColumn(
                "_has_power", F.lit(True)
            ),
            allowMissingColumns=True,
        )
        .unionByName(
            cur.select("id", "ts", "dti", F.col("phase_flag").alias("_c"), "cur").withColumn(
                "_has_cur", F.lit(True)
            ),
            allowMissingColumns=True,
        )
        .unionByName(
            pf.select("id", "ts", "dti", F.col("phase_flag").alias("_f"), "pf"),
            allowMissingColumns=True,
        )
    )
    rows = stacked.groupBy("id", "dti").agg(
        F.min("ts").alias("ts"),
        F.max("_has_volt").alias("_has_volt"),
        F.max("_has_power").alias("_has_power"),
        F.max("_has_cur").alias("_has_cur"),
        *_cells("_v", "volt", VOLT_PHASES),
        *_cells("_c", "cur", CURRENT_PHASES),
        *_cells("_p", "power", POWER_TYPES),
        *_cells("_f", "pf", FACTOR_PHASES),
    )
    watched = ["psum", *[f"{kind}{p}" for p in phases for kind in ("volt_", "p", "cur_")]]
    active = " OR ".join(f"{c} > 0" for c in watched)
    return rows.filter(f"_has_volt AND _has_power AND _has_cur AND ({active})").select(
        "id",
        "ts",
        "dti",
        *VOLT_PHASES.values(),
        *CURRENT_PHASES.values(),
        *POWER_TYPES.values(),
        *FACTOR_PHASES.values(),
    )

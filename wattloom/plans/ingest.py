"""Wide day curves to star schema, quality tables and analysis curves."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from wattloom.operators.calendar import interval_calendar
from wattloom.operators.curves import pqvcf, pv_curve, qv_curve
from wattloom.operators.quality import dead_points, outage_points, volt_quality
from wattloom.operators.reshape import phase_pivot, unpivot_curve
from wattloom.operators.star import basereading, meter_dims, reading_types
from wattloom.settings import DEFAULTS, VOLT_PHASES, MeterSettings


def ingest(
    wide: Mapping[str, DataFrame],
    readingtype: DataFrame,
    measurementkind: DataFrame,
    phase: DataFrame,
    settings: MeterSettings = DEFAULTS,
) -> dict[str, DataFrame]:
    """All outputs of the ingest job by output name, as lazy plans.

    ``wide`` holds the five curve tables under ``volt, power, cur, pf, energy``. Nothing runs
    until an output is written, so a run mode pays only for its own tables.
    """
    spark = readingtype.sparkSession
    long = {value: unpivot_curve(wide[value], value, epoch=settings.epoch) for value in wide}
    volts = phase_pivot(long["volt"], "volt", VOLT_PHASES)
    types = reading_types(readingtype, phase, measurementkind)
    families = {
        "V": long["volt"],
        "P": long["power"],
        "A": long["cur"],
        "PF": long["pf"],
        "E": long["energy"],
    }
    pv, qv = pv_curve(volts, long["power"]), qv_curve(volts, long["power"])
    return {
        "datetimeinterval": interval_calendar(spark, settings.calendar_days, settings.epoch),
        **volt_quality(long["volt"], settings),
        "basereading": basereading(families, types),
        **meter_dims(long["volt"]),
        "voltoutsum": outage_points(dead_points(volts)),
        "pvcurve": pv,
        "qvcurve": qv,
        "pvsd": pv,
        "qvsd": qv,
        "pqvcf": pqvcf(long["volt"], long["power"], long["cur"], long["pf"]),
    }

"""Star-schema readings of a simulated station to 96-column day curves."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from wattloom.operators.reshape import day_curve_pivot
from wattloom.operators.star import meter_range, star_readings
from wattloom.settings import DAY_CURVES, DEFAULTS, MeterSettings


def day_curves(
    tables: Mapping[str, DataFrame], settings: MeterSettings = DEFAULTS
) -> dict[str, DataFrame]:
    """Reading summary under ``summary`` and one day curve per measurement code.

    ``tables`` holds ``basereading, meter, identifiedobject, readingtype, measurementkind``
    and ``datetimeinterval``. The meter range is applied to the fact table and to the meter
    dimension before they meet, so it reaches both scans.
    """
    limits = {"first": settings.station_first_meter, "count": settings.station_meters}
    summary = star_readings(
        meter_range(tables["basereading"], "meter", **limits),
        meter_range(tables["meter"], **limits),
        tables["identifiedobject"],
        tables["readingtype"],
        tables["measurementkind"],
        tables["datetimeinterval"],
    )
    return {"summary": summary, **{code: day_curve_pivot(summary, code) for code in DAY_CURVES}}

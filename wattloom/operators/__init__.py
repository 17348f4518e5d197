"""Operators: every public function takes DataFrames and returns a lazy DataFrame."""

from wattloom.operators.calendar import (
    calendar_labels,
    interval_calendar,
    interval_calendar_of,
    season_daytype_labels,
)
from wattloom.operators.curves import (
    active_power,
    pqvcf,
    pv_curve,
    qv_curve,
    reactive_power,
    with_season,
)
from wattloom.operators.fit import fit_curve
from wattloom.operators.groups import (
    draw_rows,
    elbow_cost,
    hour_group_curve,
    hour_groups,
    label_hour_groups,
    store_curve,
)
from wattloom.operators.histograms import (
    adaptive_histograms,
    hour_histograms,
    hour_start_vectors,
    smallest_histograms,
)
from wattloom.operators.order import with_position
from wattloom.operators.profiles import (
    hour_curves,
    hour_features,
    hour_start_power,
    hourly_profile,
    in_band,
    irregular_groups,
    load_category,
    meter_ids,
    meter_profile,
)
from wattloom.operators.quality import (
    dead_points,
    outage_events,
    outage_points,
    quality_tags,
    slot_stats,
    volt_high,
    volt_low,
    volt_out,
    volt_quality,
)
from wattloom.operators.reshape import (
    day_curve_pivot,
    phase_pivot,
    power_pivot,
    slot_columns,
    unpivot_curve,
)
from wattloom.operators.star import (
    basereading,
    for_meters,
    meter_dims,
    meter_range,
    reading_types,
    stacked_basereading,
    star_readings,
    to_basereading,
)

__all__ = [
    "active_power",
    "adaptive_histograms",
    "basereading",
    "calendar_labels",
    "day_curve_pivot",
    "dead_points",
    "draw_rows",
    "elbow_cost",
    "fit_curve",
    "for_meters",
    "hour_curves",
    "hour_features",
    "hour_group_curve",
    "hour_groups",
    "hour_histograms",
    "hour_start_power",
    "hour_start_vectors",
    "hourly_profile",
    "in_band",
    "interval_calendar",
    "interval_calendar_of",
    "irregular_groups",
    "label_hour_groups",
    "load_category",
    "meter_dims",
    "meter_ids",
    "meter_profile",
    "meter_range",
    "outage_events",
    "outage_points",
    "phase_pivot",
    "power_pivot",
    "pqvcf",
    "pv_curve",
    "quality_tags",
    "qv_curve",
    "reactive_power",
    "reading_types",
    "season_daytype_labels",
    "slot_columns",
    "slot_stats",
    "smallest_histograms",
    "stacked_basereading",
    "star_readings",
    "store_curve",
    "to_basereading",
    "unpivot_curve",
    "volt_high",
    "volt_low",
    "volt_out",
    "volt_quality",
    "with_position",
    "with_season",
]

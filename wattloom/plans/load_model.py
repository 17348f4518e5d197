"""Analysis curves to hour groups and labelled curves."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wattloom.operators.groups import hour_group_curve, hour_groups, label_hour_groups
from wattloom.operators.profiles import hourly_profile, irregular_groups, meter_ids
from wattloom.operators.star import for_meters
from wattloom.lineage import cut
from wattloom.settings import DEFAULTS, MeterSettings


def load_model(
    pv: DataFrame,
    qv: DataFrame,
    settings: MeterSettings = DEFAULTS,
    *,
    meters: DataFrame | None = None,
    seed: int | None = None,
) -> dict[str, DataFrame]:
    """All outputs of the modelling job by output name.

    ``meters`` limits the grouping to the meters of a table. The profile and the hour groups
    feed several outputs each and are small next to the curves, so they are the two places
    where the lineage is cut.
    """
    rows = pv if meters is None else for_meters(pv, meters)
    profile = cut(hourly_profile(rows, settings))
    groups = cut(hour_groups(profile, settings, seed=seed))
    grouped_meters = meter_ids(groups)
    return {
        "meterids": meter_ids(profile),
        "hourgroup": groups,
        "hourgroup2": groups,
        "irregular": irregular_groups(profile, min_points=settings.min_points),
        "pvsdhg": label_hour_groups(pv, groups),
        "pvsdhg2": label_hour_groups(for_meters(pv, grouped_meters), groups),
        "qvsdhg2": label_hour_groups(for_meters(qv, grouped_meters), groups),
        "pvhg": hour_group_curve(pv, groups, settings),
    }

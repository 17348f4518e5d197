"""Load profiles per meter, season and day type, and the 24-hour feature points."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.codes import load_type, mean
from wattloom.functions.timegrid import bucket, is_hour_start
from wattloom.operators.curves import active_power
from wattloom.settings import DEFAULTS, HOURS_PER_DAY, SLOTS_PER_DAY, MeterSettings

GROUP = ["id", "season", "daytype"]
#: Columns that ``with_season`` derives from the timestamp.
SEASON_COLUMNS = ("sdti", "season", "daytype")


def in_band(curve: DataFrame, low: float, high: float) -> DataFrame:
    """Complete curve rows whose voltage lies in ``low..high``, bounds included.

    One test per column instead of ``na.drop``, whose counting predicate stays above the scan.
    The season columns follow from ``ts`` and are null only with it; a filter that named them
    would be pushed below their derivation and carry it along in every row. The band drops a
    null voltage by itself.
    """
    implied = {"volt_c", *(SEASON_COLUMNS if "ts" in curve.columns else ())}
    tests = [F.col(name).isNotNull() for name in curve.columns if name not in implied]
    return curve.filter(reduce(and_, tests, F.col("volt_c").between(low, high)))


def meter_profile(power: DataFrame) -> DataFrame:
    """Total, average and largest active power per meter."""
    p = F.col("power")
    return active_power(power).groupBy("id").agg(
        F.sum(p).alias("totp"), mean(p).alias("avgp"), F.max(p).alias("maxp")
    )


def hour_start_power(power: DataFrame) -> DataFrame:
    """Active power at the first slot of every hour."""
    return active_power(power).filter(is_hour_start(F.col("dti"))).select("id", "dti", "power")


def load_category(power: DataFrame, categories: DataFrame) -> DataFrame:
    """Active power readings with the category code and load type of their meter."""
    coded = categories.select(F.col("mped_id").alias("id"), "mp_attr_code")
    return (
        active_power(power)
        .select("id", "ts", "dti", "data_type", "power")
        .join(coded, "id")
        .withColumn("loadtype", load_type(F.col("mp_attr_code")))
    )


def hourly_profile(curve: DataFrame, settings: MeterSettings = DEFAULTS) -> DataFrame:
    """Average power and voltage per meter, season, day type and slot of the day.

    Both averages come from one pass; partial sums are built before the shuffle, so a meter
    that owns a large share of the readings costs each task at most 96 x 8 rows.
    """
    rows = in_band(curve, settings.band_low_all, settings.band_high)
    return (
        rows.select(*GROUP, bucket(F.col("dti")).cast("int").alias("bucket"), "power", "volt_c")
        .groupBy(*GROUP, "bucket")
        .agg(mean("power").alias("avg_power"), mean("volt_c").alias("avg_volt"))
    )


def meter_ids(profile: DataFrame) -> DataFrame:
    """Distinct meters of a profile."""
    return profile.select("id").distinct()


def _daily_slots(profile: DataFrame) -> DataFrame:
    """One row per group with its slots, at most 96, ordered by bucket."""
    slot = F.struct("bucket", "avg_power", "avg_volt")
    return profile.groupBy(*GROUP).agg(F.sort_array(F.collect_list(slot)).alias("slots"))


def _is_regular(size: Column) -> Column:
    return size.isin(HOURS_PER_DAY, 2 * HOURS_PER_DAY, SLOTS_PER_DAY)


def irregular_groups(profile: DataFrame, *, min_points: int = 1) -> DataFrame:
    """Groups whose number of slots is not that of a 15, 30 or 60 minute meter."""
    sizes = profile.groupBy(*GROUP).agg(F.count("*").alias("slots"))
    return sizes.filter(~_is_regular(F.col("slots")) & (F.col("slots") >= min_points)).select(*GROUP)


def hour_curves(profile: DataFrame, settings: MeterSettings = DEFAULTS) -> DataFrame:
    """Regular groups as two 24-element arrays: ``power`` and per-unit ``volt``.

    The hour point is picked by position among the slots present, so the number of slots
    decides whether a meter reads every 15, 30 or 60 minutes. The nominal voltage follows
    the mean of the second slot.
    """
    slots, size = F.col("slots"), F.size("slots")
    step = F.floor(size / HOURS_PER_DAY).cast("int")
    offset = F.when(step > 1, 1).otherwise(0)
    second = F.get(slots, F.lit(1))["avg_volt"]
    nominal = F.when(second < settings.band_low_single, settings.nominal_110).otherwise(
        settings.nominal_220
    )
    hours = F.sequence(F.lit(0), F.lit(HOURS_PER_DAY - 1))
    points = F.transform(hours, lambda h: F.get("slots", F.col("_step") * h + F.col("_offset")))
    picked = (
        _daily_slots(profile)
        .filter(_is_regular(size))
        .select(*GROUP, "slots", nominal.alias("_nominal"), step.alias("_step"), offset.alias("_offset"))
        .withColumn("_points", points)
    )
    return picked.select(
        *GROUP,
        F.col("_points.avg_power").alias("power"),
        F.transform("_points", lambda p: p["avg_volt"] / F.col("_nominal")).alias("volt"),
    )


def hour_features(profile: DataFrame, settings: MeterSettings = DEFAULTS) -> DataFrame:
    """Feature points of the regular groups: ``hourindex, power, volt`` for 24 hours each."""
    zipped = F.posexplode_outer(F.arrays_zip("power", "volt")).alias("_hour", "_point")
    return (
        hour_curves(profile, settings)
        .select(*GROUP, zipped)
        .select(
            *GROUP,
            F.col("_hour").cast("long").alias("hourindex"),
            F.col("_point.power").alias("power"),
            F.col("_point.volt").alias("volt"),
        )
    )

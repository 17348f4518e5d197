"""Voltage quality: low, high and dead readings, outage events, slot statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.settings import DEFAULTS, SLOTS_PER_DAY, MeterSettings

# Slots per chunk of the outage search: four weeks.
CHUNK_SLOTS = 28 * SLOTS_PER_DAY
# Chunks, or spans of them, that are looked at together.
FAN = 256


def is_low(volt: Column, settings: MeterSettings = DEFAULTS) -> Column:
    """Under-voltage on either nominal system, bounds excluded."""
    on_220 = (volt < settings.volt_low_220) & (volt > settings.volt_floor_220)
    on_110 = (volt < settings.volt_low_110) & (volt > settings.volt_out)
    return on_220 | on_110


def is_high(volt: Column, settings: MeterSettings = DEFAULTS) -> Column:
    return volt > settings.volt_high


def is_out(volt: Column, settings: MeterSettings = DEFAULTS) -> Column:
    return volt < settings.volt_out


def volt_low(volts: DataFrame, settings: MeterSettings = DEFAULTS) -> DataFrame:
    return volts.filter(is_low(F.col("volt"), settings))


def volt_high(volts: DataFrame, settings: MeterSettings = DEFAULTS) -> DataFrame:
    return volts.filter(is_high(F.col("volt"), settings))


def volt_out(volts: DataFrame, settings: MeterSettings = DEFAULTS) -> DataFrame:
    return volts.filter(is_out(F.col("volt"), settings))


def volt_quality(volts: DataFrame, settings: MeterSettings = DEFAULTS) -> dict[str, DataFrame]:
    """The four quality tables of a long voltage reading."""
    return {
        "volt": volts,
        "voltagelow": volt_low(volts, settings),
        "voltagehigh": volt_high(volts, settings),
        "voltageout": volt_out(volts, settings),
    }


def quality_tags(
    readings: DataFrame,
    value: str,
    kind: str,
    *,
    low: Column | None = None,
    high: Column | None = None,
    settings: MeterSettings = DEFAULTS,
) -> DataFrame:
    """Problem readings with a ``prbcode`` of ``<kind>-Missing``, ``-Low`` or ``-High``.

    ``low`` and ``high`` are conditions; a kind without such limits only gets missing tags.
    """
    tag = F.when(F.col(value) < settings.missing_below, f"{kind}-Missing")
    if low is not None:
        tag = tag.when(low, f"{kind}-Low")
    if high is not None:
        tag = tag.when(high, f"{kind}-High")
    return readings.withColumn("prbcode", tag).filter("prbcode IS NOT NULL")


def dead_points(volts: DataFrame) -> DataFrame:
    """Phase-wide readings on which all three phases are present and zero."""
    return volts.filter("volt_a = 0 AND volt_b = 0 AND volt_c = 0").select("id", "ts", "dti")


def outage_points(points: DataFrame) -> DataFrame:
    """Outage summary per point: each interval is a range of its own, with duration 1."""
    return points.groupBy("id", "ts").agg(
        F.min("dti").alias("rangestart"),
        F.max("dti").alias("rangeend"),
        (F.max("dti") - F.min("dti") + 1).alias("duration"),
    )


def _stitched(runs: DataFrame, slots: int | None) -> DataFrame:
    """Runs that follow each other inside a span of ``slots`` intervals, or anywhere, as one.

    Only runs that touch a border of the span before are ordered per meter; every other run is
    final and alone in its group.
    """
    span = F.lit(0).cast("long") if slots is None else F.floor(F.col("rangestart") / slots)
    runs = runs.withColumn("_span", span).withColumn("_alone", F.when(~F.col("_open"), F.col("rangestart")))
    along = Window.partitionBy("id", "_span", "_alone").orderBy("rangestart")
    follows = F.col("rangestart") == F.lag("rangeend").over(along) + 1
    goes_on = F.lead("rangestart").over(along) == F.col("rangeend") + 1
    never = F.lit(False)
    # An event is read off its last run: beginnings only grow along the window, so the least of
    # (beginning downwards, ts) is the first ts of the event so far. Aggregating the runs instead
    # would take several times the memory of their sort.
    downwards = F.coalesce(-F.col("_event"), F.lit(2**63 - 1))
    joined = (
        runs.withColumn("_begins", ~F.coalesce(follows, never))
        .withColumn("_ends", ~F.coalesce(goes_on, never))
        .withColumn("_event", F.max(F.when(F.col("_begins"), F.col("rangestart"))).over(along))
        .withColumn("_first", F.min(F.struct(downwards, F.col("ts").isNull(), F.col("ts").alias("ts"))).over(along))
        .filter("_ends")
        .select("id", F.col("_first.ts").alias("ts"), F.col("_event").alias("rangestart"), "rangeend", "_span")
    )
    if slots is None:
        return joined
    first = F.col("_span") * slots
    at_border = (F.col("rangestart") == first) | (F.col("rangeend") == first + slots - 1)
    return joined.select("id", "ts", "rangestart", "rangeend", at_border.alias("_open"))


def outage_events(points: DataFrame, *, chunk_slots: int = CHUNK_SLOTS, fan: int = FAN) -> DataFrame:
    """Runs of consecutive intervals per meter: ``id, ts, rangestart, rangeend, duration``.

    A window over a whole meter would put every point of a large meter in one task. Runs are
    therefore found inside chunks of ``chunk_slots`` intervals, and those that touch a border are
    put together up a tree: inside spans of ``fan`` chunks, then of ``fan`` such spans, then per
    meter. A span holds at most two open runs of each part, so no window holds more than
    ``2 * fan`` rows, and at the top few are left. Repeated points count once.
    """
    dti = F.col("dti")
    runs = (
        points.groupBy("id", "dti")
        .agg(F.min("ts").alias("ts"))
        .select("id", "ts", dti.alias("rangestart"), dti.alias("rangeend"), F.lit(True).alias("_open"))
    )
    for slots in (chunk_slots, chunk_slots * fan, chunk_slots * fan * fan, None):
        runs = _stitched(runs, slots)
    duration = F.col("rangeend") - F.col("rangestart") + 1
    return runs.select("id", "ts", "rangestart", "rangeend", duration.alias("duration"))


def slot_stats(wide: DataFrame, prefix: str = "U") -> DataFrame:
    """Column statistics of the 96 slots over the complete rows of a wide curve.

    The slots are stacked and grouped, so every task sends 96 partial rows and no more.
    """
    cells = F.array(*[F.col(f"{prefix}{n}").cast("double") for n in range(1, SLOTS_PER_DAY + 1)])
    value = F.col("value")
    return (
        wide.na.drop("any")
        .select(F.posexplode(cells).alias("place", "value"))
        .select((F.col("place") + 1).alias("idx"), "value")
        .groupBy("idx")
        .agg(
            F.count("*").alias("count"),
            F.avg(value).alias("mean"),
            F.var_samp(value).alias("variance"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            F.count_if(value != 0).alias("nonzeros"),
            F.sum(F.abs(value)).alias("norm_l1"),
            F.sqrt(F.sum(value * value)).alias("norm_l2"),
        )
    )

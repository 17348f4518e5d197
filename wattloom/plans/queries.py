"""The registered queries: each operator over the whole benchmark tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom import operators as op
from wattloom.functions import codes, timegrid
from wattloom.lineage import scratch
from wattloom.operators.profiles import GROUP
from wattloom.operators.quality import is_high, is_low
from wattloom.settings import CURRENT_PHASES, FACTOR_PHASES, VOLT_PHASES
from wattloom.sources import (
    file_sink,
    publish,
    read_series_csv,
    read_table,
    sample,
    series_from_lines,
    write_series_csv,
)

Query = Callable[[SparkSession, str], DataFrame]

EPOCH = sample.EPOCH
FAMILY_VALUES = {"V": "volt", "A": "cur", "PF": "pf", "P": "power", "E": "energy"}


def _doubles(df: DataFrame) -> DataFrame:
    """Decimal results as doubles, which is how any engine hands them out."""
    return df.select(
        *[
            F.col(name).cast("double").alias(name) if kind.startswith("decimal") else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})


def _long(spark: SparkSession, sf_dir: str, value: str) -> DataFrame:
    return sample.family(sample.readings(spark, sf_dir), value)


def _volts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.phase_pivot(_long(spark, sf_dir, "volt"), "volt", VOLT_PHASES)


def _curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.direct_curve(sample.readings(spark, sf_dir))


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.hourly_profile(_curve(spark, sf_dir))


def _types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.reading_types(
        sample.reading_type_table(spark, sf_dir),
        sample.phases(spark),
        sample.measurement_kinds(spark),
    )


# --- calendar -----------------------------------------------------------------------------


def hourly_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(spark, sf_dir)


def interval_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.interval_calendar_of(sample.readings(spark, sf_dir), EPOCH)


def calendar_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of load type, season and day type, with the power readings each one covers."""
    coded = op.load_category(_long(spark, sf_dir, "power"), sample.categories(spark, sf_dir))
    ts = F.col("ts")
    covered = (
        coded.select("loadtype", timegrid.sdti(ts).alias("sdti"))
        .groupBy("loadtype", "sdti")
        .agg(F.count("*").alias("readings"))
    )
    return (
        op.calendar_labels(spark)
        .join(covered, ["loadtype", "sdti"], "left")
        .select("loadtype", "sdti", "season", "daytype", "label", F.coalesce("readings", F.lit(0)).alias("readings"))
    )


def season_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of season and day type, with the readings each one covers."""
    covered = sample.readings(spark, sf_dir).groupBy(timegrid.sdti(F.col("ts")).alias("sdti"))
    return (
        op.season_daytype_labels(spark)
        .join(covered.agg(F.count("*").alias("readings")), "sdti", "left")
        .select("sdti", "season", "daytype", "label", F.coalesce("readings", F.lit(0)).alias("readings"))
    )


def season_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid functions on every reading: interval id both ways, hour, season, texts."""
    ts, dti = F.col("ts"), F.col("dti")
    return sample.readings(spark, sf_dir).select(
        "id",
        "dti",
        timegrid.dti_of(ts, EPOCH).alias("dti_of_ts"),
        timegrid.timestamp_of(dti, EPOCH).alias("ts_of_dti"),
        timegrid.bucket(dti).alias("bucket"),
        timegrid.hour_index(dti).alias("hourindex"),
        timegrid.sdti(ts).alias("sdti"),
        timegrid.season(ts).alias("season"),
        timegrid.daytype(ts).alias("daytype"),
        codes.timestamp_text(ts).alias("ts_text"),
        codes.date_text(ts).alias("date_text"),
    )


def edge_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Casts between decimals, integers, doubles and text on every reading."""
    power = F.col("power")
    return sample.readings(spark, sf_dir).select(
        "id",
        "dti",
        codes.decimal_to_int(power).alias("power_int"),
        codes.decimal_to_long(F.col("volt")).alias("volt_long"),
        codes.decimal_to_double(power).alias("power_double"),
        codes.to_decimal(F.col("cur"), 18, 1).cast("double").alias("cur_decimal"),
        codes.text_timestamp(codes.timestamp_text(F.col("ts"))).alias("ts_back"),
    )


# --- reshape ------------------------------------------------------------------------------


def phase_pivot_volt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(_volts(spark, sf_dir))


def phase_pivot_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(op.phase_pivot(_long(spark, sf_dir, "cur"), "cur", CURRENT_PHASES))


def phase_pivot_pf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(op.phase_pivot(_long(spark, sf_dir, "pf"), "pf", FACTOR_PHASES))


def power_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(op.power_pivot(_long(spark, sf_dir, "power")))


def _unpivot(value: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        wide = sample.wide_curve(sample.readings(spark, sf_dir), value)
        return _doubles(op.unpivot_curve(wide, value, epoch=EPOCH))

    return query


# --- star schema --------------------------------------------------------------------------


def reading_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _types(spark, sf_dir)


def _fact(spark: SparkSession, sf_dir: str, rows: DataFrame, *families: str) -> DataFrame:
    return op.stacked_basereading(rows, _types(spark, sf_dir), families)


def _basereading(family: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _fact(spark, sf_dir, sample.readings(spark, sf_dir), family)

    return query


def _star(spark: SparkSession, sf_dir: str, *families: str) -> DataFrame:
    rows = sample.readings(spark, sf_dir)
    known = sample.meters(spark, sf_dir).withColumnRenamed("meterid", "id")
    return op.star_readings(
        sample.with_strangers(_fact(spark, sf_dir, rows, *families)),
        sample.meters(spark, sf_dir),
        op.meter_dims(known)["identifiedobject"],
        sample.reading_type_table(spark, sf_dir),
        sample.measurement_kinds(spark),
        sample.intervals(rows),
        types=_types(spark, sf_dir),
    )


def star_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _star(spark, sf_dir, *FAMILY_VALUES)


def star_readings_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reading summary by meter and interval, with the place of each reading."""
    return op.with_position(star_readings(spark, sf_dir), ["meterid", "datetimeintervalid"])


def _day_curve(code: str, family: str, first_bucket: int = 2) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return op.day_curve_pivot(_star(spark, sf_dir, family), code, first_bucket=first_bucket)

    return query


def _meter_dim(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return op.meter_dims(sample.readings(spark, sf_dir))[name]

    return query


def meters_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Voltage of one station of 1,635 meters."""
    return _doubles(op.meter_range(_long(spark, sf_dir, "volt"), "id", first=2))


def meters_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curve rows of the meters that have an irregular group, which a join decides."""
    irregular = op.irregular_groups(_profile(spark, sf_dir))
    return _doubles(op.for_meters(_curve(spark, sf_dir), irregular.select("id")))


# --- quality ------------------------------------------------------------------------------


def volt_low(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(op.volt_low(_long(spark, sf_dir, "volt")))


def volt_high(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(op.volt_high(_long(spark, sf_dir, "volt")))


def volt_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(op.volt_out(_long(spark, sf_dir, "volt")))


def quality_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    volt = F.col("volt")
    tagged = op.quality_tags(
        _long(spark, sf_dir, "volt"), "volt", "Voltage", low=is_low(volt), high=is_high(volt)
    )
    return _doubles(tagged)


def quality_tags_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    power = F.col("power")
    tagged = op.quality_tags(
        _long(spark, sf_dir, "power"), "power", "Power", low=power < 0.5, high=power > 10
    )
    return _doubles(tagged)


def slot_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = op.slot_stats(sample.weekly_volts(sample.readings(spark, sf_dir)))
    return _rounded(stats, "mean", "variance", "norm_l1", "norm_l2")


def outage_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.outage_points(op.dead_points(_volts(spark, sf_dir)))


def outage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.outage_events(op.dead_points(_volts(spark, sf_dir)))


def outage_events_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by meter and beginning, with their place."""
    return op.with_position(outage_events_any(spark, sf_dir), ["id", "rangestart"])


def outage_events_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the intervals on which any reading is zero."""
    return op.outage_events(_long(spark, sf_dir, "volt").filter("volt = 0").select("id", "ts", "dti"))


def outage_events_daily_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in chunks of a day, so that many events cross a border."""
    points = _long(spark, sf_dir, "volt").filter("volt = 0").select("id", "ts", "dti")
    return op.outage_events(points, chunk_slots=96)


def outage_events_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Almost all readings in chunks of an hour and a narrow tree: long events over many borders."""
    rows = sample.readings(spark, sf_dir, folded=False).filter("volt < 190 OR pf > 0.9")
    return op.outage_events(rows.select("id", "ts", "dti"), chunk_slots=4, fan=3)


def outage_events_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events over the whole span of the ship dates, of dead or almost idle readings."""
    rows = sample.readings(spark, sf_dir, folded=False).filter("volt = 0 OR pf > 0.93")
    return op.outage_events(rows.select("id", "ts", "dti"))


# --- curves -------------------------------------------------------------------------------


def pv_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(op.pv_curve(_volts(spark, sf_dir), _long(spark, sf_dir, "power")))


def qv_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(op.qv_curve(_volts(spark, sf_dir), _long(spark, sf_dir, "power")))


def pqvcf(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sample.readings(spark, sf_dir)
    parts = [sample.family(rows, v) for v in ("volt", "power", "cur", "pf")]
    return _doubles(op.pqvcf(*parts))


def _joined(spark: SparkSession, sf_dir: str, curve: Callable) -> DataFrame:
    return curve(_volts(spark, sf_dir), _long(spark, sf_dir, "power"))


def pv_hourly_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile of the joined curve, which is what hour groups are made from."""
    return op.hourly_profile(_joined(spark, sf_dir, op.pv_curve))


def pv_hour_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.hour_groups(pv_hourly_profile(spark, sf_dir))


def pv_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = pv_hour_groups(spark, sf_dir)
    return _doubles(op.label_hour_groups(_joined(spark, sf_dir, op.pv_curve), groups))


def qv_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reactive curve labelled with the groups of the active one."""
    groups = pv_hour_groups(spark, sf_dir)
    return _doubles(op.label_hour_groups(_joined(spark, sf_dir, op.qv_curve), groups))


# --- profiles -----------------------------------------------------------------------------


def meter_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(op.meter_profile(_long(spark, sf_dir, "power")))


def meter_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.meter_ids(_profile(spark, sf_dir))


def hour_start_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(op.hour_start_power(_long(spark, sf_dir, "power")))


def load_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = op.load_category(_long(spark, sf_dir, "power"), sample.categories(spark, sf_dir))
    return _doubles(coded)


def irregular_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.irregular_groups(_profile(spark, sf_dir))


def hour_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.hour_features(_profile(spark, sf_dir))


def hour_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.hour_histograms(_curve(spark, sf_dir))


def adaptive_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All points of the adaptive histograms, one row each."""
    slots = op.adaptive_histograms(_curve(spark, sf_dir))
    kinds = F.expr("stack(2, 'power', power, 'volt', volt) AS (kind, points)")
    return (
        slots.select(*GROUP, "bucket", kinds)
        .select(*GROUP, "bucket", "kind", F.posexplode("points").alias("place", "point"))
        .select(*GROUP, "bucket", "kind", "place", "point.x", "point.y")
    )


def adaptive_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature vectors of the hours, one row per number."""
    vectors = op.hour_start_vectors(op.adaptive_histograms(_curve(spark, sf_dir)))
    return vectors.select(*GROUP, "hourindex", F.posexplode("features").alias("place", "feature"))


def adaptive_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the adaptive histograms must keep exactly: mass, weighted sum, number of points."""
    slots = op.adaptive_histograms(_curve(spark, sf_dir))

    def total(points: str, term: Callable) -> Column:
        return F.round(F.aggregate(points, F.lit(0.0), lambda a, h: a + term(h)), 6)

    return slots.select(
        *GROUP,
        "bucket",
        total("power", lambda h: h["y"] * 5.0).cast("long").alias("power_mass"),
        total("volt", lambda h: h["y"] * 100.0).cast("long").alias("volt_mass"),
        F.size("power").cast("long").alias("power_points"),
        F.size("volt").cast("long").alias("volt_points"),
        total("power", lambda h: h["x"] * h["y"] * 5.0).alias("power_sum"),
        total("volt", lambda h: h["x"] * h["y"] * 100000.0).alias("volt_sum"),
    )


def smallest_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.smallest_histograms(op.adaptive_histograms(_curve(spark, sf_dir)))


# --- hour groups --------------------------------------------------------------------------


def hour_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.hour_groups(_profile(spark, sf_dir))


def hour_groups_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best of three runs from drawn hours."""
    return op.hour_groups(_profile(spark, sf_dir), seed=7, runs=3)


def seed_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six hour points of each group, drawn by hash."""
    return op.draw_rows(op.hour_features(_profile(spark, sf_dir)), GROUP, "hourindex", 6, seed=11)


def seed_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty intervals of each season, drawn among the readings of all meters."""
    seen = _curve(spark, sf_dir).select("season", "dti").distinct()
    return op.draw_rows(seen, ["season"], "dti", 20, seed=3)


def label_hour_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = op.hour_groups(_profile(spark, sf_dir))
    return _doubles(op.label_hour_groups(_curve(spark, sf_dir), groups))


def stored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a curve that is stored by meter, season, day type and hour."""
    path = scratch(spark, "stored-curve")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = path.rsplit("/", 1)[1].replace("-", "_")
    stored = op.store_curve(_curve(spark, sf_dir), table, path, buckets=buckets)
    return _doubles(op.label_hour_groups(stored, hour_groups(spark, sf_dir)).drop("hourindex"))


def hour_group_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = op.hour_groups(_profile(spark, sf_dir))
    return _doubles(op.hour_group_curve(_curve(spark, sf_dir), groups))


def elbow_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost of 2 to 20 clusters over the hour points of all meters."""
    return _rounded(op.elbow_cost(op.hour_features(_profile(spark, sf_dir)), ["power", "volt"]), "cost")


# --- fits ---------------------------------------------------------------------------------


def _fit(degree: int, *extra: str, narrow: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        curve = _curve(spark, sf_dir)
        if narrow:
            # Voltages within half a volt of the nominal one.
            near = F.expr("CAST(219.5D + CAST(volt_c AS DOUBLE) / 300 AS DECIMAL(9,5))")
            curve = curve.withColumn("volt_c", near)
        curve = op.in_band(curve, 88.0, 300.0)
        if extra:
            groups = op.hour_groups(_profile(spark, sf_dir))
            curve = op.hour_group_curve(_curve(spark, sf_dir), groups)
        # Over a narrow band, coefficients in the voltage itself are large and cancel.
        fitted = op.fit_curve(curve, [*GROUP, *extra], degree=degree, origin=220.0 if narrow else 0.0)
        return _rounded(fitted, *[f"c{n}" for n in range(degree + 1)])

    return query


# --- series -------------------------------------------------------------------------------


def csv_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings written as ``id,value`` lines, with null and sentinel marks, parsed back."""
    text = (
        F.when(F.col("volt") == 0, "null").when(F.col("power") < 1, "-999.0").otherwise(F.col("cur").cast("string"))
    )
    lines = sample.readings(spark, sf_dir).select(F.concat_ws(",", F.col("id"), text).alias("line"))
    return series_from_lines(lines, "line")


def series_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings written as ``id,value`` files and read back."""
    path = scratch(spark, "series")
    write_series_csv(sample.readings(spark, sf_dir), path, value="power")
    return read_series_csv(spark, path)


def published_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The analysis curve after the same run was published twice, with the rows each said it wrote."""
    folder = scratch(spark, "published")
    curve = _joined(spark, sf_dir, op.pv_curve)
    sink = file_sink(folder, "first")
    said = [publish({"pvcurve": curve}, 2, sink)["pvcurve"] for _ in range(2)]
    back = read_table(spark, f"{folder}/pvcurve").drop("run")
    return _doubles(back.select(*curve.columns, F.lit(said[0]).alias("said"), F.lit(said[1]).alias("said_again")))


QUERIES: dict[str, Query] = {
    "hourly_profile": hourly_profile,
    "interval_calendar": interval_calendar,
    "calendar_labels": calendar_labels,
    "season_labels": season_labels,
    "season_columns": season_columns,
    "edge_casts": edge_casts,
    "phase_pivot_volt": phase_pivot_volt,
    "phase_pivot_current": phase_pivot_current,
    "phase_pivot_pf": phase_pivot_pf,
    "power_pivot": power_pivot,
    **{f"unpivot_{v}": _unpivot(v) for v in ("volt", "power", "cur", "pf", "energy")},
    "reading_types": reading_types,
    **{f"basereading_{f.lower()}": _basereading(f) for f in FAMILY_VALUES},
    "star_readings": star_readings,
    "star_readings_sorted": star_readings_sorted,
    "day_curve_p": _day_curve("P", "P"),
    "day_curve_q": _day_curve("Q", "P"),
    "day_curve_v": _day_curve("V", "V"),
    "day_curve_a": _day_curve("A", "A"),
    "day_curve_pf": _day_curve("PF", "PF"),
    "day_curve_ep": _day_curve("EP", "E"),
    "day_curve_eq": _day_curve("EQ", "E"),
    "day_curve_p_aligned": _day_curve("P", "P", first_bucket=1),
    "identifiedobject": _meter_dim("identifiedobject"),
    "enddevice": _meter_dim("enddevice"),
    "meter": _meter_dim("meter"),
    "meters_in_range": meters_in_range,
    "meters_selected": meters_selected,
    "volt_low": volt_low,
    "volt_high": volt_high,
    "volt_out": volt_out,
    "quality_tags": quality_tags,
    "quality_tags_power": quality_tags_power,
    "slot_stats": slot_stats,
    "outage_points": outage_points,
    "outage_events": outage_events,
    "outage_events_any": outage_events_any,
    "outage_events_sorted": outage_events_sorted,
    "outage_events_tree": outage_events_tree,
    "outage_events_daily_chunks": outage_events_daily_chunks,
    "outage_events_span": outage_events_span,
    "pv_curve": pv_curve,
    "qv_curve": qv_curve,
    "pqvcf": pqvcf,
    "pv_hourly_profile": pv_hourly_profile,
    "pv_hour_groups": pv_hour_groups,
    "pv_labelled": pv_labelled,
    "qv_labelled": qv_labelled,
    "meter_profile": meter_profile,
    "meter_ids": meter_ids,
    "hour_start_power": hour_start_power,
    "load_category": load_category,
    "irregular_groups": irregular_groups,
    "hour_features": hour_features,
    "hour_histograms": hour_histograms,
    "adaptive_histograms": adaptive_histograms,
    "adaptive_vectors": adaptive_vectors,
    "adaptive_totals": adaptive_totals,
    "smallest_histograms": smallest_histograms,
    "hour_groups": hour_groups,
    "hour_groups_seeded": hour_groups_seeded,
    "seed_points": seed_points,
    "seed_readings": seed_readings,
    "label_hour_groups": label_hour_groups,
    "stored_labels": stored_labels,
    "hour_group_curve": hour_group_curve,
    "elbow_cost": elbow_cost,
    "fit_curve_linear": _fit(1),
    "fit_curve_quadratic": _fit(2),
    "fit_narrow_quadratic": _fit(2, narrow=True),
    "fit_narrow_cubic": _fit(3, narrow=True),
    "fit_curve_cubic": _fit(3),
    "fit_curve_hour_group": _fit(1, "hourgroup"),
    "csv_series": csv_series,
    "series_files": series_files,
    "published_curve": published_curve,
}

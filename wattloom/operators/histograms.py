"""Histogram features of power and voltage per meter, season, day type and hour."""

from __future__ import annotations

import heapq
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.timegrid import bucket, hour_index, is_hour_start
from wattloom.operators.profiles import GROUP, in_band
from wattloom.settings import DEFAULTS, HOURS_PER_DAY, MeterSettings

# The helpers below travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A group with more than one in so many readings is met by its edges in ``HOT_PARTS`` places.
HOT_SHARE = 1000
HOT_PARTS = 64


def _edges(name: str, bins: int) -> list[Column]:
    """Inner edges ``<name>_1, ..`` between the smallest and the largest value.

    There are none where both are the same: a value equals none of them and is in bin 0.
    """
    low, high = f"{name}_low", f"{name}_high"
    edge = "CASE WHEN {h} > {l} THEN {l} + {i} * ({h} - {l}) / {n} END AS {c}_{i}"
    return [F.expr(edge.format(h=high, l=low, i=i, n=bins, c=name)) for i in range(1, bins)]


def _bin(value: str, name: str, bins: int) -> Column:
    """Equal-width bin of ``value``: the number of inner edges at or below it.

    Comparing with the edges keeps a value that sits on one in the upper bin, which dividing
    by the width would not always do. The last bin is closed.
    """
    reached = [f"CAST({value} >= {name}_{i} AS BIGINT)" for i in range(1, bins)]
    return F.expr(f"coalesce({' + '.join(reached) or '0L'}, 0L)")


def hour_histograms(
    curve: DataFrame,
    settings: MeterSettings = DEFAULTS,
    *,
    power_bins: int | None = None,
    volt_bins: int | None = None,
    hot_share: int = HOT_SHARE,
) -> DataFrame:
    """Bin counts ``p0.., v0..`` of the hour-start readings, 24 rows per group.

    The edges span all readings of a group in the single-meter band. They are one row per group
    and are joined back to the readings, whose counts are combined per task before they are
    shuffled. Only a group that holds more than one in ``hot_share`` readings, so at most that
    many groups, meets copies of its edges under a salt. Hours without readings enter the same
    aggregation as zero rows.
    """
    n_power = power_bins or settings.power_bins
    n_volt = volt_bins or settings.volt_bins
    rows = in_band(curve, settings.band_low_single, settings.band_high).select(
        *GROUP, "dti", F.col("power").cast("double"), F.col("volt_c").cast("double")
    )
    # The filter holds for every group. It keeps all columns alive in every use of this
    # aggregation, so that they share one pass over the readings.
    edges = (
        rows.groupBy(*GROUP)
        .agg(
            F.min("power").alias("p_low"),
            F.max("power").alias("p_high"),
            F.min("volt_c").alias("v_low"),
            F.max("volt_c").alias("v_high"),
            F.count("*").alias("_n"),
        )
        .filter("p_low <= p_high AND v_low <= v_high AND _n > 0")
    )
    total = edges.agg(F.sum("_n")).scalar()
    parted = edges.withColumn("_hot", F.col("_n") * hot_share > total)
    hot = F.broadcast(parted.filter("_hot").select(*GROUP, F.lit(HOT_PARTS).alias("_parts")))
    copies = parted.select(
        *GROUP,
        *_edges("p", n_power),
        *_edges("v", n_volt),
        F.explode(F.sequence(F.lit(0), F.when(F.col("_hot"), HOT_PARTS - 1).otherwise(0))).alias("_salt"),
    )
    samples = rows.filter(is_hour_start(F.col("dti"))).join(hot, GROUP, "left")
    samples = samples.withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64("dti", "power"), F.col("_parts")).cast("int"), F.lit(0))
    )
    binned = samples.join(copies, [*GROUP, "_salt"]).select(
        *GROUP,
        hour_index(F.col("dti")).alias("hourindex"),
        _bin("power", "p", n_power).alias("p"),
        _bin("volt_c", "v", n_volt).alias("v"),
    )
    hours = F.sequence(F.lit(0).cast("long"), F.lit(HOURS_PER_DAY - 1).cast("long"))
    nothing = F.lit(None).cast("long")
    every_hour = edges.select(
        *GROUP, F.explode(hours).alias("hourindex"), nothing.alias("p"), nothing.alias("v")
    )
    counts = [F.count_if(F.col("p") == n).alias(f"p{n}") for n in range(n_power)]
    counts += [F.count_if(F.col("v") == n).alias(f"v{n}") for n in range(n_volt)]
    return binned.unionByName(every_hour).groupBy(*GROUP, "hourindex").agg(*counts)


def condense(values: np.ndarray, counts: np.ndarray, points: int) -> list[tuple[float, float]]:
    """At most ``points`` weighted points for distinct ascending values and their counts.

    The two nearest neighbours become one at their weighted mean until few enough are left; of
    equally near pairs the lower one does. The result depends on the values and counts alone.
    """
    n = len(values)
    if n <= points:
        return list(zip(values.tolist(), counts.astype(float).tolist(), strict=True))
    x, y = values.tolist(), counts.astype(float).tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive, version = [True] * n, [0] * n
    gaps = [(x[i + 1] - x[i], i, 0, 0) for i in range(n - 1)]
    heapq.heapify(gaps)
    left = n
    while left > points:
        _, i, seen, seen_after = heapq.heappop(gaps)
        j = after[i] if alive[i] else n
        if j >= n or version[i] != seen or version[j] != seen_after:
            continue  # one of the two has changed since
        x[i] = (x[i] * y[i] + x[j] * y[j]) / (y[i] + y[j])
        y[i] += y[j]
        alive[j] = False
        version[i] += 1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            heapq.heappush(gaps, (x[k] - x[i], i, version[i], version[k]))
        h = before[i]
        if h >= 0:
            heapq.heappush(gaps, (x[i] - x[h], h, version[h], version[i]))
        left -= 1
    return [(x[i], y[i]) for i in range(n) if alive[i]]


def _condensed(keys: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Points of every run of rows that agree in ``keys``; rows come ordered by these and value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, head, open_values, open_counts = [*keys, "_points"], None, [], []
        point = pa.struct([("x", pa.float64()), ("y", pa.float64())])

        def made(done: list[tuple], types: list[pa.DataType]) -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        def closed() -> tuple:
            points = condense(np.concatenate(open_values), np.concatenate(open_counts), head[-1])
            return (*head, [{"x": x, "y": y} for x, y in points])

        types: list[pa.DataType] = []
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            columns = [batch.column(k) for k in keys]
            types = [*(c.type for c in columns), pa.list_(point)]
            new = np.zeros(n, bool)
            for c in columns:
                new[1:] |= pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            starts = np.append(np.flatnonzero(new), n)
            values = batch.column("_value").to_numpy(zero_copy_only=False)
            counts = batch.column("_count").to_numpy(zero_copy_only=False)
            done, at = [], 0
            first = tuple(c[0].as_py() for c in columns)
            if head is not None and head != first:
                done.append(closed())
                head, open_values, open_counts = None, [], []
            for upto in starts:
                if head is None:
                    head = tuple(c[at].as_py() for c in columns)
                open_values.append(values[at:upto])
                open_counts.append(counts[at:upto])
                if upto < n:
                    done.append(closed())
                    head, open_values, open_counts = None, [], []
                at = int(upto)
            if done:
                yield made(done, types)
        if head is not None:
            yield made([closed()], types)

    return run


def adaptive_histograms(curve: DataFrame, settings: MeterSettings = DEFAULTS) -> DataFrame:
    """Adaptive histograms per slot: arrays ``power`` and ``volt`` of (x, y) points.

    Weekdays get more power bins than weekends. The points are scaled to a common range:
    power (x, y / 5), voltage (x / 1000, y / 100). The arrays have as many points as the data
    supports and are keyed by bucket, so a missing slot shifts nothing.

    Readings are reduced to distinct values with counts before they are shuffled, and the
    nearest values of a slot are merged in a fixed order, see ``condense``: the points are the
    same whatever the partitioning. A task reads its slots one after the other and holds the
    distinct values of one. Values that are not numbers (NaN) are left out.
    """
    rows = in_band(curve, settings.band_low_single, settings.band_high).select(
        *GROUP,
        bucket(F.col("dti")).cast("int").alias("bucket"),
        F.col("power").cast("double").alias("power"),
        F.col("volt_c").cast("double").alias("volt"),
    )
    weekday = F.col("daytype") == 1
    bins = F.when(F.col("_kind") == "volt", settings.volt_bins).otherwise(
        F.when(weekday, settings.power_bins).otherwise(settings.power_bins_weekend)
    )
    keys = [*GROUP, "bucket"]
    values = rows.selectExpr(*keys, "stack(2, 'power', power, 'volt', volt) AS (_kind, _value)").filter(
        ~F.isnan("_value")
    )
    counted = values.groupBy(*keys, "_kind", "_value").agg(F.count("*").alias("_count"))
    order = [*keys, "_kind"]
    ordered = counted.withColumn("_bins", bins).repartition(*keys).sortWithinPartitions(*order, "_value")
    kinds = dict(ordered.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in [*order, "_bins"])
    points = ordered.mapInArrow(_condensed([*order, "_bins"]), f"{schema}, _points array<struct<x: double, y: double>>")
    power, volt = (F.max(F.when(F.col("_kind") == k, F.col("_points"))) for k in ("power", "volt"))
    slots = points.groupBy(*keys).agg(power.alias("_power"), volt.alias("_volt"))
    return slots.select(
        *keys,
        F.transform("_power", lambda h: F.struct(h["x"].alias("x"), (h["y"] / 5.0).alias("y"))).alias("power"),
        F.transform(
            "_volt", lambda h: F.struct((h["x"] / 1000.0).alias("x"), (h["y"] / 100.0).alias("y"))
        ).alias("volt"),
    )


def hour_start_vectors(histograms: DataFrame) -> DataFrame:
    """Hour-start slots of the adaptive histograms as one flat feature vector per hour."""
    flat = F.concat(*[F.flatten(F.transform(c, lambda h: F.array(h["x"], h["y"]))) for c in ("power", "volt")])
    return histograms.filter(F.col("bucket") % 4 == 1).select(
        *GROUP, F.floor(F.col("bucket") / 4).alias("hourindex"), flat.alias("features")
    )


def smallest_histograms(histograms: DataFrame) -> DataFrame:
    """Smallest number of power and voltage points over the slots of each group."""
    return histograms.groupBy(*GROUP).agg(
        F.min(F.size("power")).alias("min_power_bins"), F.min(F.size("volt")).alias("min_volt_bins")
    )

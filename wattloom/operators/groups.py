"""Hour groups: k-means over the 24 hours of each meter, season and day type."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.timegrid import hour_index
from wattloom.lineage import cut
from wattloom.operators.profiles import GROUP, hour_curves, in_band
from wattloom.settings import DEFAULTS, HOURS_PER_DAY, MeterSettings

# The helpers below travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _nearest(points: np.ndarray, centres: np.ndarray, alive: np.ndarray) -> np.ndarray:
    gaps = points[:, :, None, :] - centres[:, None, :, :]
    distance = gaps[..., 0] * gaps[..., 0] + gaps[..., 1] * gaps[..., 1]
    return np.where(alive[:, None, :], distance, np.inf).argmin(axis=2)


def _group_hours(points: np.ndarray, seeds: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Lloyd's algorithm on a batch: ``points`` is (groups, 24, 2), ``seeds`` are hours.

    Labels by hour, and the sum of squared distances of each group. Empty clusters vanish and
    ties go to the lowest centre. Labels are numbered by the first hour that carries them.
    """
    k = seeds.shape[1]
    centres = np.take_along_axis(points, seeds[:, :, None], axis=1)
    alive = np.ones(seeds.shape, dtype=bool)
    for _ in range(rounds):
        member = _nearest(points, centres, alive)[:, :, None] == np.arange(k)
        count = member.sum(axis=1)
        alive = count > 0
        total = np.einsum("ghk,ghd->gkd", member.astype(float), points)
        centres = total / np.maximum(count, 1)[:, :, None]
    label = _nearest(points, centres, alive)
    gaps = points - np.take_along_axis(centres, label[:, :, None], axis=1)
    cost = (gaps * gaps).sum(axis=(1, 2))
    member = label[:, :, None] == np.arange(k)
    first_hour = np.where(member.any(axis=1), member.argmax(axis=1), points.shape[1])
    rank = first_hour.argsort(axis=1, kind="stable").argsort(axis=1, kind="stable")
    return np.take_along_axis(rank, label, axis=1), cost


def _hour_labels(rounds: int):
    @F.pandas_udf("array<int>")
    def labels(power: pd.Series, volt: pd.Series, seeds: pd.Series) -> pd.Series:
        if power.empty:
            return pd.Series([], dtype=object)
        points = np.stack([np.stack(power.to_numpy()), np.stack(volt.to_numpy())], axis=2)
        starts = np.stack([np.stack(s) for s in seeds])
        runs = starts.shape[1]
        found, cost = _group_hours(np.repeat(points, runs, axis=0), starts.reshape(-1, starts.shape[2]), rounds)
        # Runs that end in the same groups differ in the last bits of their cost.
        best = np.round(cost, 9).reshape(-1, runs).argmin(axis=1)
        return pd.Series(list(found.reshape(len(points), runs, -1)[np.arange(len(points)), best].astype("int32")))

    return labels


def _draw(by: Sequence[Column], item: Column, seed: int, run: int) -> Column:
    """What decides whether an item is drawn: the smallest come first."""
    return F.md5(F.concat_ws("|", *by, item, F.lit(seed), F.lit(run)))


def _seed_hours(k: int, seed: int | None, runs: int) -> Column:
    """Hours that start the clusters of each run: evenly spaced, or drawn per group by a seeded hash."""
    if seed is None:
        return F.array(F.array(*[F.lit(n * HOURS_PER_DAY // k) for n in range(k)]))
    hours, by = F.sequence(F.lit(0), F.lit(HOURS_PER_DAY - 1)), [F.col(c) for c in GROUP]

    def drawn(run: int) -> Column:
        draws = F.transform(hours, lambda h: F.struct(_draw(by, h, seed, run).alias("draw"), h.alias("hour")))
        return F.slice(F.array_sort(draws), 1, k)["hour"]

    return F.array(*[drawn(run) for run in range(runs)])


def draw_rows(df: DataFrame, by: Sequence[str], item: str, k: int, *, seed: int) -> DataFrame:
    """``k`` rows of each group, drawn by a seeded hash of the group and ``item``, with their ``place``.

    The same rows whatever the partitioning, as long as ``item`` tells the rows of a group apart.
    Every task keeps the ``k`` smallest of a group before it sends them on, so a large group is
    no large partition. A smaller group is drawn whole.
    """
    draw = _draw([F.col(c) for c in by], F.col(item), seed, 0)
    place = F.row_number().over(Window.partitionBy(*by).orderBy("_draw", item))
    return df.withColumn("_draw", draw).withColumn("place", place).filter(F.col("place") <= k).drop("_draw")


def hour_groups(
    profile: DataFrame,
    settings: MeterSettings = DEFAULTS,
    *,
    k: int | None = None,
    rounds: int | None = None,
    seed: int | None = None,
    runs: int = 1,
) -> DataFrame:
    """Hour groups of all meters in one job: ``id, season, daytype, hourgroup, hourindex``.

    The clusters start from evenly spaced hours or, with ``seed``, from hours drawn for each of
    ``runs`` runs, of which the one with the smallest cost counts, the first of equal ones.

    A group is 24 points, so it is one row with two arrays. Spark spreads the rows and each
    Arrow batch of them is clustered at once; there is no job per meter or per round. Only
    regular groups take part, see ``irregular_groups``.
    """
    label = _hour_labels(rounds or settings.lloyd_rounds)
    grouped = hour_curves(profile, settings).select(
        *GROUP,
        label(F.col("power"), F.col("volt"), _seed_hours(k or settings.hour_groups, seed, runs)).alias("_labels"),
    )
    # The outer form: a plain one brings a filter on the labels, and with it a second run of the
    # clustering below the first.
    return grouped.select(*GROUP, F.posexplode_outer("_labels").alias("_hour", "hourgroup")).select(
        *GROUP, "hourgroup", F.col("_hour").cast("long").alias("hourindex")
    )


def _with_hour(curve: DataFrame) -> DataFrame:
    if "hourindex" in curve.columns:  # a stored curve
        return curve
    return curve.withColumn("hourindex", hour_index(F.col("dti")))


def store_curve(curve: DataFrame, table: str, path: str, *, buckets: int) -> DataFrame:
    """A copy of ``curve`` with its ``hourindex``, laid out by meter, season, day type and hour.

    The table is written under ``path`` in ``buckets`` files by a hash of these four, each sorted
    by them. Hour groups are keyed alike, so labels and extracts of a stored curve, now and
    later, join in place: only the groups move. A large meter falls into 192 keys.
    """
    keys = [*GROUP, "hourindex"]
    dealt = _with_hour(curve).repartition(buckets, *keys)
    writer = dealt.write.format("parquet").mode("errorifexists").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return curve.sparkSession.table(table)


def label_hour_groups(curve: DataFrame, groups: DataFrame) -> DataFrame:
    """Curve rows with the ``hourgroup`` of their hour, -1 where the hour has none.

    Joined on meter, season, day type and hour, so the rows of a large meter fall apart into
    192 keys; AQE splits what is still too large.
    """
    joined = _with_hour(curve).join(groups, [*GROUP, "hourindex"], "left")
    return joined.select(*curve.columns, F.coalesce("hourgroup", F.lit(-1)).alias("hourgroup"))


def hour_group_curve(
    curve: DataFrame, groups: DataFrame, settings: MeterSettings = DEFAULTS
) -> DataFrame:
    """In-band curve rows that belong to an hour group."""
    rows = in_band(curve, settings.band_low_single, settings.band_high)
    return (
        _with_hour(rows)
        .join(groups, [*GROUP, "hourindex"])
        .select("id", "ts", "season", "daytype", "hourgroup", "power", "volt_c")
    )


#: Points of a block, and strips per feature in which points are brought together.
BLOCK_POINTS = 256
STRIPS = 64


def _pack(d: int):
    """Points in order as blocks: their box, count and exact sums, and the points themselves.

    A decimal of twelve places is a whole number of units, here in two halves of 32 bits whose
    sums cannot overflow.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = np.stack([batch.column(f"x{j}").to_numpy(zero_copy_only=False) for j in range(d)], axis=1)
            high, low = np.empty((n, d), np.int64), np.empty((n, d), np.int64)
            for j in range(d):
                column = batch.column(f"e{j}")
                units = np.frombuffer(column.buffers()[1], np.int64)[2 * column.offset : 2 * (column.offset + n)].reshape(-1, 2)
                high[:, j] = (units[:, 1] << 32) | (units[:, 0] >> 32 & 0xFFFFFFFF)
                low[:, j] = units[:, 0] & 0xFFFFFFFF
            rows = []
            for at in range(0, n, BLOCK_POINTS):
                part = slice(at, min(at + BLOCK_POINTS, n))
                rows.append(
                    (
                        part.stop - at, x[part].min(axis=0).tolist(), x[part].max(axis=0).tolist(),
                        high[part].sum(axis=0).tolist(), low[part].sum(axis=0).tolist(),
                        x[part].tobytes(), high[part].tobytes(), low[part].tobytes(),
                    )
                )
            if rows:
                yield pa.RecordBatch.from_pydict(dict(zip(_BLOCK, map(list, zip(*rows, strict=True)), strict=True)))

    return run


_BLOCK = ("n", "least", "most", "high_sum", "low_sum", "x", "high", "low")
_BLOCK_SCHEMA = (
    "n long, least array<double>, most array<double>, high_sum array<long>, low_sum array<long>, "
    "x binary, high binary, low binary"
)


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, features added in their order."""
    total = np.zeros((len(x), len(centres)))
    for j in range(x.shape[1]):
        gap = x[:, j, None] - centres[None, :, j]
        total += gap * gap
    return total


def _undecided(least: np.ndarray, most: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """For each box, which centres may be nearest to a point in it.

    A centre farther from the whole box than another is from its farthest corner never is.
    """
    outside = np.maximum(np.maximum(least[:, None] - centres, centres - most[:, None]), 0.0)
    corner = np.maximum(np.abs(least[:, None] - centres), np.abs(most[:, None] - centres))
    bound = (corner * corner).sum(axis=2).min(axis=1) * (1 + 1e-9)
    return (outside * outside).sum(axis=2) <= bound[:, None]


def _assign(centres: dict[int, list[tuple]], d: int, *, cost: bool):
    """Counts and sums per centre of all ``k``, or the cost per ``k``: one short table a task."""
    tables = {k: np.array([c[1:] for c in found]).reshape(-1, d) for k, found in centres.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {k: np.zeros(len(t), np.int64) for k, t in tables.items()}
        sums = {k: np.zeros((2, len(t), d), np.int64) for k, t in tables.items()}
        costs = {k: [0, 0] for k in tables}
        for batch in batches:
            n = batch.column("n").to_numpy()
            if not len(n):
                continue

            def numbers(name: str, kind: type) -> np.ndarray:
                return np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(-1, d)

            def box(name: str) -> np.ndarray:
                return batch.column(name).flatten().to_numpy().reshape(-1, d)

            x, least, most = numbers("x", np.float64), box("least"), box("most")
            exact = np.stack([numbers("high", np.int64), numbers("low", np.int64)])
            whole = np.stack([box("high_sum"), box("low_sum")])
            for k, table in tables.items():
                if cost:
                    near = _squares(x, table).min(axis=1)
                    up = np.floor(near)
                    costs[k][0] += int(up.astype(np.int64).sum())
                    costs[k][1] += int(np.rint((near - up) * 2.0**40).astype(np.int64).sum())
                    continue
                may = _undecided(least, most, table)
                one = may.sum(axis=1) == 1
                to = may[one].argmax(axis=1)
                np.add.at(counts[k], to, n[one])
                for half in (0, 1):
                    np.add.at(sums[k][half], to, whole[half][one])
                if one.all():
                    continue
                left = ~np.repeat(one, n)
                to = _squares(x[left], table).argmin(axis=1)
                counts[k] += np.bincount(to, minlength=len(table))
                for half in (0, 1):
                    np.add.at(sums[k][half], to, exact[half][left])
        if cost:
            columns = {"k": list(costs), "high": [c[0] for c in costs.values()], "low": [c[1] for c in costs.values()]}
            yield pa.RecordBatch.from_pydict(columns | {"k": pa.array(columns["k"], pa.int32())})
            return
        rows = [
            (k, centres[k][i][0], int(counts[k][i]), sums[k][0, i].tolist(), sums[k][1, i].tolist())
            for k in tables
            for i in np.flatnonzero(counts[k])
        ]
        if rows:
            found = dict(zip(("k", "i", "n", "high", "low"), map(list, zip(*rows, strict=True)), strict=True))
            for name in ("k", "i"):
                found[name] = pa.array(found[name], pa.int32())
            yield pa.RecordBatch.from_pydict(found)

    return run


def elbow_cost(
    points: DataFrame,
    features: Sequence[str],
    ks: Sequence[int] = range(2, 21),
    *,
    rounds: int = DEFAULTS.elbow_rounds,
) -> DataFrame:
    """Within-cluster sum of squares for each number of clusters: ``k, cost``.

    Lloyd's rounds for all ``k`` together, one pass each. The centres start evenly spaced
    between the smallest and the largest value of every feature, empty clusters vanish and ties
    go to the lowest centre. Values count to twelve decimal places and their sums are exact, so
    neither partitioning nor a task that runs again changes a bit. One distinct point gives cost
    0, no point gives no rows; rows with a null or a value that is not a number are left out.

    Points are brought together in blocks of near ones, once. A round looks at a block's box
    first: if only one centre can be nearest anywhere in it, the block's sums count as a whole
    and its points are not visited. A task sends one row per centre, and only these sums reach
    the driver, ``sum(ks)`` rows a round.
    """
    spark, d = points.sparkSession, len(features)
    number = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c)).cast("decimal(20,12)") for c in features]
    numeric = points.select(*[c.alias(f"e{j}") for j, c in enumerate(number)]).na.drop("any")
    numeric = cut(numeric.select("*", *[F.col(f"e{j}").cast("double").alias(f"x{j}") for j in range(d)]))
    ends = [f(f"x{j}").alias(f"{n}{j}") for j in range(d) for n, f in (("low", F.min), ("high", F.max))]
    span = numeric.agg(F.count("*").alias("n"), *ends).first()
    schema = "k int, cost double"
    if not span.n:
        return spark.createDataFrame([], schema)
    wide = [max(span[f"high{j}"] - span[f"low{j}"], 1e-300) for j in range(d)]
    strips = [F.floor((F.col(f"x{j}") - span[f"low{j}"]) / wide[j] * STRIPS).alias(f"s{j}") for j in range(d - 1)]
    order = [*(f"s{j}" for j in range(d - 1)), f"x{d - 1}"]
    near = numeric.select("*", *strips).repartitionByRange(*order).sortWithinPartitions(*order)
    columns = [f"{p}{j}" for p in "ex" for j in range(d)]
    blocks = cut(near.select(*columns).mapInArrow(_pack(d), _BLOCK_SCHEMA))

    centres = {
        int(k): [
            (i, *[span[f"low{j}"] + (i + 0.5) * (span[f"high{j}"] - span[f"low{j}"]) / k for j in range(d)])
            for i in range(k)
        ]
        for k in ks
    }
    halves = [
        F.sum(F.get(half, F.lit(j)).cast("decimal(38,0)")).alias(f"{half}{j}") for half in ("high", "low") for j in range(d)
    ]
    for _ in range(rounds):
        found = blocks.mapInArrow(_assign(centres, d, cost=False), "k int, i int, n long, high array<long>, low array<long>")
        moved: dict[int, list[tuple]] = {k: [] for k in centres}
        for r in sorted(found.groupBy("k", "i").agg(F.sum("n").alias("n"), *halves).collect(), key=lambda r: (r.k, r.i)):
            units = [Decimal(int(r[f"high{j}"]) * 2**32 + int(r[f"low{j}"])) for j in range(d)]
            moved[r.k].append((r.i, *[float(u.scaleb(-12)) / r.n for u in units]))
        if moved == centres:
            break
        centres = moved
    found = blocks.mapInArrow(_assign(centres, d, cost=True), "k int, high long, low long")
    whole, part = (F.sum(F.col(c).cast("decimal(38,0)")).cast("double") for c in ("high", "low"))
    return found.groupBy("k").agg((whole + part / 2.0**40).alias("cost"))

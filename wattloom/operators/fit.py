"""Polynomial least squares per group, by triangular factors that are put together in any order.

The rows of a group, as powers of ``x`` with ``y`` beside them, have a triangular factor of their
QR decomposition that says all a fit needs to know. Factors of parts of a group, stacked and
decomposed again, give the factor of the whole. Each part counts ``x`` from its own middle and in
its own spread, which a triangular change of basis brings to those of the whole.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The helpers below travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of one decomposition at most, and rows that a task holds before it puts them together.
TILE = 64
HELD = 100_000
#: A group with more rows than this, times ``degree + 2``, among those held becomes a part.
WORTH = 4


def _grouped(columns: list, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that brings equal rows together, null being a value, and the number of each one's group."""
    code = np.zeros(rows, np.int64)
    for c in columns:
        if isinstance(c, pa.ChunkedArray):
            c = c.combine_chunks()
        index = pc.dictionary_encode(c, null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        kinds = int(index.max()) + 1
        if (int(code.max()) + 1) * kinds >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
        code = code * kinds + index
    order = np.argsort(code, kind="stable")
    code = code[order]
    return order, np.cumsum(np.concatenate([[0], code[1:] != code[:-1]]))


def _factors(rows: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """Triangular factor of the rows of each group; ``group`` ascends from 0 to ``groups`` - 1.

    Rows are decomposed in tiles and the factors are rows again, until each group has one. Tiles
    are small where groups are, so that little of them is empty.
    """
    width = rows.shape[1]
    out = np.zeros((groups, width, width))
    left = np.arange(groups)
    while True:
        count = np.bincount(group, minlength=len(left))
        tile = max(2 * width, min(TILE, 2 * len(group) // len(left)))
        number = -(-count // tile)
        place = np.arange(len(group)) - (np.cumsum(count) - count)[group]
        first = np.cumsum(number) - number
        stacked = np.zeros((number.sum(), tile, width))
        stacked[first[group] + place // tile, place % tile] = rows
        factor = np.linalg.qr(stacked, mode="r")
        out[left] = factor[first]
        more = number > 1
        if not more.any():
            return out
        rows = factor[np.repeat(more, number)].reshape(-1, width)
        group = np.repeat(np.arange(more.sum()), number[more] * width)
        left = left[more]


def _levels(values: np.ndarray, group: np.ndarray, groups: int, most: int) -> np.ndarray:
    """The smallest distinct values of each group, ``most`` at most, then NaN; rows may come in any order."""
    order = np.lexsort((values, group))
    values, group = values[order], group[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (group[1:] != group[:-1])
    values, group = values[new], group[new]
    count = np.bincount(group, minlength=groups)
    place = np.arange(len(group)) - (np.cumsum(count) - count)[group]
    out = np.full((groups, most), np.nan)
    out[group[place < most], place[place < most]] = values[place < most]
    return out


def _scale(least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    spread = (most - least) / 2
    return (least + most) / 2, np.where(spread > 0, spread, 1.0)


def _records(keys: list, names: list[str], u: pa.Array, v: pa.Array, parts: np.ndarray | None = None) -> pa.Table:
    """Rows ``_u, _v`` as they came, or parts of a group, which are numbers in one binary: their count
    of rows, least and largest ``x``, levels and factor. The JVM writes a few plain columns quickly."""
    column = pa.nulls(len(u), pa.binary())
    if parts is not None:
        ends = np.arange(len(parts) + 1, dtype=np.int32) * parts[0].nbytes
        buffers = [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(parts.tobytes())]
        column = pa.Array.from_buffers(pa.binary(), len(parts), buffers)
    return pa.Table.from_arrays([*keys, u, v, column], [*names, "_u", "_v", "_part"])


def _together(records: pa.Table, names: list[str], degree: int) -> tuple[list[pa.Array], np.ndarray, int]:
    """The records of each group as one part: keys, parts, and the place of the last record's group."""
    order, group = _grouped([records.column(c) for c in names], records.num_rows)
    start = np.flatnonzero(np.diff(group, prepend=-1))
    groups, width = len(start), degree + 2
    u, v = (records.column(c).to_numpy()[order] for c in ("_u", "_v"))
    row = ~np.isnan(u)
    n, low, high = np.ones(len(u)), u.copy(), u.copy()
    if not row.all():
        packed = records.column("_part").combine_chunks().take(pa.array(order[~row]))
        parts = np.frombuffer(packed.buffers()[2], np.float64).reshape(len(packed), -1)
        n[~row], low[~row], high[~row] = parts[:, :3].T
    least, most = np.minimum.reduceat(low, start), np.maximum.reduceat(high, start)
    middle, spread = _scale(least, most)
    values, of = u[row], group[row]
    z = (values - middle[of]) / spread[of]
    rows, rows_of = np.column_stack([*(z**k for k in range(degree + 1)), v[row]]), of
    if not row.all():
        of_part = group[~row]
        levels, flat = parts[:, 3 : 4 + degree], parts[:, 4 + degree :].reshape(-1, width, width)
        # z of the whole is a * z of the part + b.
        m, s = _scale(low[~row], high[~row])
        a, b = s / spread[of_part], (m - middle[of_part]) / spread[of_part]
        basis = np.zeros((len(flat), width, width))
        for j in range(degree + 1):
            for i in range(j + 1):
                basis[:, i, j] = comb(j, i) * a**i * b ** (j - i)
        basis[:, -1, -1] = 1.0
        rows_of = np.concatenate([of, np.repeat(of_part, width)])
        by_group = np.argsort(rows_of, kind="stable")
        rows, rows_of = np.concatenate([rows, (flat @ basis).reshape(-1, width)])[by_group], rows_of[by_group]
        there = ~np.isnan(levels)
        values = np.concatenate([values, levels[there]])
        of = np.concatenate([of, np.repeat(of_part, there.sum(1))])
    factor = _factors(rows, rows_of, groups)
    whole = [np.add.reduceat(n, start), least, most, _levels(values, of, groups, degree + 1), factor.reshape(groups, -1)]
    keys = [records.column(c).combine_chunks().take(pa.array(order[start])) for c in names]
    return keys, np.column_stack(whole), int(group[np.argmax(order)])


def _part_records(keys: list, names: list[str], parts: np.ndarray) -> pa.Table:
    none = pa.nulls(len(parts), pa.float64())
    return _records(keys, names, none, none, parts)


def _parts(names: list[str], degree: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Records of a task. Among ``HELD`` rows, a group of many is one part; rows of small groups,
    whose part would be no smaller than they are, stay as they are."""

    def records(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).combine_chunks()
        rows = _records([rows.column(c) for c in names], names, rows.column("_u"), rows.column("_v"))
        order, group = _grouped([rows.column(c) for c in names], rows.num_rows)
        many = np.bincount(group) > WORTH * (degree + 2)
        if many.any():
            mine = np.zeros(rows.num_rows, bool)
            mine[order] = many[group]
            keys, parts, _ = _together(rows.filter(pa.array(mine)), names, degree)
            yield from _part_records(keys, names, parts).to_batches()
            rows = rows.filter(pa.array(~mine))
        if rows.num_rows:
            yield from rows.combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            # A null and a value that is not a number are left out here: a filter in the plan would
            # repeat the derivation of both columns.
            u, v = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_u", "_v"))
            batch = batch.filter(pa.array(~(np.isnan(u) | np.isnan(v))))
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size >= HELD:
                yield from records(held)
                held, size = [], 0
        if held:
            yield from records(held)

    return run


def _whole(
    names: list[str], degree: int, origin: float
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows and coefficients of each group; the records of a group come together."""

    def fitted(keys: list[pa.Array], parts: np.ndarray) -> Iterator[pa.RecordBatch]:
        found = _solved(parts, degree, origin)
        columns = [*keys, pa.array(parts[:, 0].astype(np.int64)), *(pa.array(c, mask=np.isnan(parts[:, 3 + degree])) for c in found.T)]
        if len(parts):
            yield pa.RecordBatch.from_arrays(columns, [*names, "points", *(f"c{n}" for n in range(degree + 1))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            size += batch.num_rows
            if size >= HELD:
                keys, parts, last = _together(pa.concat_tables(held), names, degree)
                # The group of the last record may go on in the next batch.
                held, size = [_part_records([c.slice(last, 1) for c in keys], names, parts[last : last + 1])], 1
                done = np.arange(len(parts)) != last
                yield from fitted([c.filter(pa.array(done)) for c in keys], parts[done])
        if held:
            yield from fitted(*_together(pa.concat_tables(held), names, degree)[:2])

    return run


def _in_x(unit: np.ndarray, middle: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Coefficients in ``x`` of polynomials given in ``(x - middle) / spread``, by Horner's scheme."""
    out = np.zeros_like(unit)
    for n in range(unit.shape[1] - 1, -1, -1):
        shifted = np.pad(out[:, :-1], ((0, 0), (1, 0)))
        out = (shifted - middle[:, None] * out) / spread[:, None]
        out[:, 0] += unit[:, n]
    return out


def _solved(parts: np.ndarray, degree: int, origin: float) -> np.ndarray:
    """Coefficients of each part; those of parts with too few levels mean nothing."""
    out = np.zeros((len(parts), degree + 1))
    at = np.flatnonzero(~np.isnan(parts[:, 3 + degree]))
    if len(at):
        width = degree + 2
        r = parts[at, 4 + degree :].reshape(-1, width, width)
        matrix, right = r[:, :-1, :-1], r[:, :-1, -1]
        try:
            unit = np.linalg.solve(matrix, right[:, :, None])[:, :, 0]
        except np.linalg.LinAlgError:  # rounding has made one singular: the least-norm solutions
            unit = np.einsum("gij,gj->gi", np.linalg.pinv(matrix), right)
        middle, spread = _scale(parts[at, 1], parts[at, 2])
        out[at] = _in_x(unit, middle - origin, spread)
    return out


def fit_curve(
    curve: DataFrame,
    by: Sequence[str],
    *,
    x: str = "volt_c",
    y: str = "power",
    degree: int = 1,
    origin: float = 0.0,
) -> DataFrame:
    """``points`` and coefficients ``c0..cn`` of the least-squares polynomial of ``y`` per group.

    The powers are those of ``x - origin``; an origin near the data keeps the coefficients small.
    Groups with ``degree`` distinct ``x`` or fewer get nulls. Rows without ``x`` or ``y`` are left
    out, a null key is a group.

    One pass: a task reduces its rows, a bounded number at a time, to a triangular factor per group,
    ``degree + 2`` numbers square. Of groups with fewer rows than such a factor is worth, as when
    the rows of many meters come mixed, the rows themselves are shuffled, so no more travels than
    came in. Both are put together in batches; neither a group nor its factors are ever held whole.
    """
    names = list(by)
    rows = curve.select(
        *names, F.col(x).cast("double").alias("_u"), F.col(y).cast("double").alias("_v")
    )
    kinds = dict(rows.dtypes)
    keys = [f"`{c}` {kinds[c]}" for c in names]
    parts = rows.mapInArrow(_parts(names, degree), ", ".join([*keys, "_u double, _v double, _part binary"]))
    ordered = parts.repartition(*names).sortWithinPartitions(*names) if names else parts.coalesce(1)
    found = ", ".join([*keys, "points long", *(f"c{n} double" for n in range(degree + 1))])
    return ordered.mapInArrow(_whole(names, degree, origin), found)

"""Words and runs of words as 64-bit numbers, computed over whole batches of texts at once.

A word is hashed as a polynomial over its bytes, a run of words as a polynomial over their
hashes, both by prefix sums modulo 2^64, so no Python loop visits words.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of text handled at a time; a longer text is handled alone.
CHUNK = 1 << 20
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers over the whole range."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _byte_values(lower: bool) -> np.ndarray:
    codes = np.arange(256, dtype=np.uint64)
    if lower:
        codes[65:91] += np.uint64(32)
    return mix(codes * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x1234567))


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))

            def run(base: int) -> np.ndarray:
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                return np.cumprod(steps, dtype=np.uint64)

            self.up, self.down = run(self.base), run(self.inverse)
        return self.up[:n], self.down[:n]


@dataclass
class Words:
    """Words of a run of texts: ``first[i]`` is the number of the first word of text i."""

    hashes: np.ndarray
    begin: np.ndarray  # byte offsets in ``data``
    end: np.ndarray
    first: np.ndarray
    data: np.ndarray


class Hasher:
    """Hashes words and word runs; equal words give equal numbers in every task."""

    def __init__(self, lower: bool, blanks: bytes = BLANKS):
        self.values = _byte_values(lower)
        self.blank = np.zeros(256, bool)
        self.blank[list(blanks)] = True
        self.byte_powers = Powers(0x9E3779B97F4A7C15)
        self.run_powers = [Powers(0xD6E8FEB86659FD93), Powers(0xA0761D6478BD642F)]

    def words(self, data: np.ndarray, offsets: np.ndarray) -> Words:
        """``offsets`` has one more entry than there are texts, the first is 0."""
        n = len(data)
        solid = ~self.blank[data]
        # A blank before each text keeps words from running on into the next.
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        begin_at = solid.copy()
        begin_at[1:] &= ~solid[:-1] | edge[1:n]
        end_at = solid.copy()
        end_at[:-1] &= ~solid[1:] | edge[1:n]
        begin, end = np.flatnonzero(begin_at), np.flatnonzero(end_at) + 1
        up, down = self.byte_powers.get(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[data] * up[:n], out=sums[1:])
        hashes = mix((sums[end] - sums[begin]) * down[begin])
        return Words(hashes, begin, end, np.searchsorted(begin, offsets), data)

    def runs(self, words: np.ndarray, k: int, which: int = 0) -> np.ndarray:
        """Hash of the ``k`` words from each place; shorter by ``k`` - 1 than ``words``."""
        n = len(words)
        if n < k:
            return np.empty(0, np.uint64)
        up, down = self.run_powers[which].get(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words * up[:n], out=sums[1:])
        return mix((sums[k:] - sums[:-k]) * down[: n - k + 1])

    def spans(self, words: np.ndarray, begin: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
        """Hash of the words from each ``begin`` to before ``end``."""
        up, down = self.run_powers[which].get(len(words) + 1)
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up[: len(words)], out=sums[1:])
        return mix((sums[end] - sums[begin]) * down[begin])


def chunks(texts: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of a binary column: first row, row after the last, bytes, offsets. Null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null(b"")
    n = len(texts)
    if not n:
        return
    wide = pa.types.is_large_binary(texts.type)
    buffers = texts.buffers()
    ends = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    at = 0
    while at < n:
        upto = int(np.searchsorted(ends, ends[at] + size, side="right")) - 1
        upto = min(n, max(upto, at + 1))
        yield at, upto, data[ends[at] : ends[upto]], ends[at : upto + 1] - ends[at]
        at = upto

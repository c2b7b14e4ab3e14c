"""Words, hashes and slices of Arrow text columns, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that are turned into arrays at a time. A single longer text is taken whole.
SLICE_BYTES = 2 << 20

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_RADIX = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_powers: dict[str, np.ndarray] = {}


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and where each value starts and ends (one number more). Null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = column.fill_null(pa.scalar("", column.type)).cast(wide)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=column.offset + len(column) + 1)[column.offset:]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of about ``limit`` bytes: first row, row after the last, bytes, bounds within these bytes."""
    data, bounds = raw_bytes(column)
    lo, rows = 0, len(bounds) - 1
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + limit, side="right")) - 1)
        yield lo, hi, data[bounds[lo]:bounds[hi]], bounds[lo:hi + 1] - bounds[lo]
        lo = hi


def _power(n: int, name: str, base: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have, dtype=np.uint64)
        if size <= 8 * SLICE_BYTES:
            _powers[name] = have
    return have[:n]


class RangeHash:
    """64-bit hashes of any ranges of at least eight bytes: equal bytes have equal hashes wherever they stand.

    The symbols of the polynomial are mixed windows of eight bytes. Over the bytes themselves, a polynomial modulo a
    power of two is zero for some regular differences whatever its base, as between a Thue-Morse word and its complement.
    """

    WINDOW = 8

    def __init__(self, data: np.ndarray):
        symbols = mixed(eight_bytes(data)[:max(0, len(data) - self.WINDOW + 1)])
        n = len(symbols)
        self._sum = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(symbols * _power(n, "up", _RADIX), out=self._sum[1:])
        self._back = _power(n + 1, "down", pow(_RADIX, -1, 1 << 64))

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self._sum[end - (self.WINDOW - 1)] - self._sum[start]) * self._back[start])


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the entropy over all 64 bits (the finalizer of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position, and from the end, as a little-endian number; zeros follow the end. A view."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    return np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))


_FRONT = np.array([(1 << 8 * i) - 1 for i in range(9)], dtype=np.uint64)
_LONG_KEY = 1 << 62
_DIGESTED = 64


def range_keys(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number from 0 to 2**63 - 1 for each range of bytes. Up to seven bytes it holds the bytes and their count, so it belongs
    to them alone. Longer ranges get a hash of 62 bits, mixed anew for every eight bytes, or of their digest above 64."""
    view, n = eight_bytes(data), end - start
    out = (view[start] & _FRONT[np.minimum(n, 7)]) | (n.astype(np.uint64) << np.uint64(56))
    long = np.flatnonzero(n > 7)
    if len(long):
        at, left = start[long], n[long]
        h = mixed(left.astype(np.uint64) * np.uint64(_RADIX))
        alive = np.flatnonzero(left <= _DIGESTED)
        while len(alive):
            word = view[at[alive]] & _FRONT[np.minimum(left[alive], 8)]
            h[alive] = mixed((h[alive] ^ word) * np.uint64(_RADIX) + np.uint64(1))
            at[alive] += 8
            left[alive] -= 8
            alive = alive[left[alive] > 0]
        for i in np.flatnonzero(n[long] > _DIGESTED).tolist():
            h[i] = int.from_bytes(blake2b(data[start[long[i]]:end[long[i]]].tobytes(), digest_size=8).digest(), "little")
        out[long] = (h >> np.uint64(2)) | np.uint64(_LONG_KEY)
    return out.view(np.int64)


def same_bytes(data: np.ndarray, start: np.ndarray, end: np.ndarray, other: np.ndarray, from_: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Whether each range of ``data`` has the bytes of its range of ``other``."""
    out = end - start == to - from_
    mine, theirs = eight_bytes(data), eight_bytes(other)
    n = end - start
    for i in np.flatnonzero(out & (n > 8 * _DIGESTED)).tolist():
        out[i] = np.array_equal(data[start[i]:end[i]], other[from_[i]:to[i]])
    alive, done = np.flatnonzero(out & (n <= 8 * _DIGESTED)), 0
    while len(alive):
        differ = (mine[start[alive] + done] ^ theirs[from_[alive] + done]) & _FRONT[np.minimum(n[alive] - done, 8)]
        out[alive[differ != 0]] = False
        done += 8
        alive = alive[(differ == 0) & (n[alive] > done)]
    return out


def runs_of(ink: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each maximal run where ``ink`` holds, within a row."""
    before = np.zeros(len(ink), dtype=bool)
    before[1:] = ink[:-1]
    first = bounds[:-1]
    before[first[first < len(ink)]] = False
    after = np.zeros(len(ink), dtype=bool)
    after[:-1] = ink[1:]
    last = bounds[1:]
    after[last[last > 0] - 1] = False
    start, end = np.flatnonzero(ink & ~before), np.flatnonzero(ink & ~after) + 1
    return start, end, np.searchsorted(bounds, start, side="right") - 1


def word_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word: maximal runs without space and control characters 9 to 13, within a row."""
    return runs_of(~_BLANK[data], bounds)


def widened(df: DataFrame, fields: str) -> T.StructType:
    """The schema of ``df`` and further fields after it."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(fields).fields])


def add_columns(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    names = [*batch.schema.names, *columns]
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], names=names)


def remainder(column: str, n: int) -> F.Column:
    """crc32 of an id as text, modulo ``n``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % n, F.lit(-1))

"""Words and word windows of whole Arrow batches as numpy hashes, without a Python loop per word.

A text is read as UTF-8 bytes. Separators are single bytes that never occur inside a longer
UTF-8 sequence, so words can be found on bytes. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_rng = np.random.default_rng(20_240_613)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEP_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes hashed at once; a longer word is hashed whole.
PIECE = 1 << 20
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits (a bijection)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, step in enumerate((_STEP, _STEP_BACK)):
            steps = np.full(n, step, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[column.offset:column.offset + len(column) + 1].astype(np.int64) if len(column) \
        else np.zeros(1, np.int64)
    every = np.frombuffer(data, np.uint8) if data is not None and len(data) else np.zeros(0, np.uint8)
    return every[at[0]:at[-1]], at - at[0]


class Words:
    """The words of some texts: starts and ends in `data`, `first[d]` = first word of text d."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = _LOWER[data] if lower else data
        inside = ~_SEPARATOR[self.data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        ends = inside
        ends[:-1] &= ~inside[1:] | edge[1:-1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A hash for each word, from its bytes alone."""
        out = np.empty(len(self.starts), np.uint64)
        i = 0
        while i < len(out):
            j = max(i + 1, int(np.searchsorted(self.ends, self.starts[i] + PIECE, "right")))
            low, high = self.starts[i], self.ends[j - 1]
            up, back = _power(max(PIECE, int(high - low)))
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(_BYTE[self.data[low:high]] * up[:high - low], out=sums[1:])
            s = self.starts[i:j] - low
            out[i:j] = (sums[self.ends[i:j] - low] - sums[s]) * back[s]
            i = j
        return mix(out)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words, at its first word; runs over a text's end are not sorted out."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = h[:m] * _PLACE[0]
    for k in range(1, n):
        out += h[k:m + k] * _PLACE[k]
    return mix(out)


def whole_windows(owner: np.ndarray, n: int) -> np.ndarray:
    """Which of the runs of n words lie in one text."""
    return owner[:len(owner) - n + 1] == owner[n - 1:] if len(owner) >= n else np.zeros(0, bool)


def slices(batch, column: str = "text", limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch with about `limit` bytes of text each (one row at least)."""
    _, at = text_bytes(batch.column(column))
    yield from cuts(at, limit)


def cuts(at: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of the texts that begin and end at these offsets, as in slices."""
    n, low = len(at) - 1, 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(at, at[low] + limit, "right")) - 1)
        yield low, high
        low = high


def binary(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([a.tobytes() for a in arrays], pa.binary())


def joined(column, kind) -> np.ndarray:
    """All values of a binary column, one after the other."""
    if isinstance(column, pa.ChunkedArray):
        parts = [joined(c, kind) for c in column.chunks]
        return np.concatenate(parts) if parts else np.zeros(0, kind)
    if not len(column):
        return np.zeros(0, kind)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if pa.types.is_large_binary(column.type) else np.int32)
    low, high = at[column.offset], at[column.offset + len(column)]
    return np.frombuffer(data, np.uint8)[low:high].view(kind) if high > low else np.zeros(0, kind)


def lengths(column, width: int) -> np.ndarray:
    """Number of items of `width` bytes in each value of a binary column."""
    import pyarrow.compute as pc

    return pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // width \
        if len(column) else np.zeros(0, np.int64)

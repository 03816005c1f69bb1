"""Words of whole batches of texts, lower-cased and joined by single spaces, in windows.

A window holds about PIECE bytes of the batch and whole words; it begins with the last words of
the one before it, so that no run of words is lost at its edge. So memory is bounded by the
window, not by the longest text (a single word is never cut).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
SPACE = 32


def lowered(separators: bytes) -> bytes:
    """A table for bytes.translate: A-Z to a-z, then separators to spaces."""
    lower = [b + 32 if 65 <= b < 91 else b for b in range(256)]
    return bytes(SPACE if b in separators else b for b in lower)


@dataclass
class Window:
    """Word k is text[starts[k]:ends[k]] of document owner[k]; the first `old` words were in the
    window before."""

    text: bytes
    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray
    old: int

    def first(self, n: int) -> np.ndarray:
        """The first words of the runs of n words that no earlier window had."""
        at = np.arange(max(0, self.old - n + 1), len(self.starts) - n + 1)
        return at[self.owner[at] == self.owner[at + n - 1]]

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, owner) of these runs."""
        first = self.first(n)
        return self.starts[first], self.ends[first + n - 1], self.owner[first]


def text_rows(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def windows(texts: list[bytes], table: bytes, carry: int, piece: int = PIECE) -> Iterator[Window]:
    """The words of texts in order, the last `carry` words of each window again in the next."""
    offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    data = b" ".join(texts).translate(table)
    low, old = 0, 0
    while low < len(data):
        high = data.find(b" ", low + piece)
        if high < 0:
            high = len(data)
        part = np.frombuffer(data, np.uint8, high - low, low)
        inside = part != SPACE
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        keep = inside
        keep[ends[ends < len(part)]] = True
        at = np.cumsum(keep) - 1
        owner = np.searchsorted(offsets, starts + low, "right") - 1
        if len(starts) > old:
            new = at[starts]
            yield Window(part[keep].tobytes(), new, new + ends - starts, owner, old)
        if high == len(data):
            return
        old = min(carry, len(starts))
        following = low + int(starts[-old]) if old else high
        if following <= low and old:  # a window of carried words only: go on behind them
            piece *= 2
        low = following

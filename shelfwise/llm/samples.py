"""Bounded samples of labelled rows for classifiers that are trained on the driver, and the
character n-grams they read."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.store import hash60


def bounded_sample(rows: DataFrame, label: str, per_label: dict | int, seed: str) -> DataFrame:
    """About per_label rows of each label (all, if there are fewer), picked by a hash of doc_id.

    Labels are counted without reading texts; the rows are picked by a filter. Its result is near
    what is wanted unless very many rows repeat one id; twice as many are returned at most. The
    number of labels is taken to be small.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    want = {k: per_label if isinstance(per_label, int) else per_label[k] for k in counts}
    limits = {k: min(1.0, want[k] / n) for k, n in counts.items()}
    if not limits:
        return rows.limit(0)
    share = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])[F.col(label)]
    unit = hash60(F.lit(seed), F.col("doc_id").cast("string")).cast("double") / float(1 << 60)
    return rows.filter(unit <= share).limit(2 * sum(want.values()) + 100)


def held_out(modulus: int, rest: int) -> Column:
    """Whether crc32 of doc_id as text leaves `rest`; false for null ids."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == rest, F.lit(False))


def learnable(modulus: int, rest: int) -> Column:
    """Rows to learn from: those with an id that are not held out."""
    return F.col("doc_id").isNotNull() & ~held_out(modulus, rest)


BITS = 20
_rng = np.random.default_rng(7)
_FACTORS = {n: _rng.integers(1, 2**62, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            for n in range(1, 9)}


def gram_codes(text: str, orders: tuple[int, ...]) -> np.ndarray:
    """Hashes below 2 ** BITS of all character n-grams of a text in lower case."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"),
                           np.uint32).astype(np.uint64)
    found = []
    for n in orders:
        m = len(points) - n + 1
        if m <= 0:
            continue
        f = _FACTORS[n]
        code = points[:m] * f[0]
        for k in range(1, n):
            code += points[k:m + k] * f[k]
        found.append((code >> np.uint64(64 - BITS)).astype(np.int32))
    return np.concatenate(found) if found else np.zeros(0, np.int32)


class Presence:
    """Which grams of a text are in a vocabulary, and how many different grams it has."""

    def __init__(self, vocabulary: np.ndarray, orders: tuple[int, ...]):
        self.orders = orders
        self.place = np.full(1 << BITS, -1, np.int32)
        self.place[vocabulary] = np.arange(len(vocabulary), dtype=np.int32)
        self.seen = np.zeros(1 << BITS, bool)

    def __call__(self, text: str) -> tuple[np.ndarray, int]:
        codes = gram_codes(text, self.orders)
        self.seen[codes] = True
        distinct = int(np.count_nonzero(self.seen))
        self.seen[codes] = False
        at = self.place[codes]
        return at[at >= 0], distinct

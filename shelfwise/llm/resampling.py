"""Importance resampling of documents towards a target distribution of hashed n-grams.

Runs of one and two words are counted by bucket (CRC-32 of their UTF-8) over all documents and
over the target. A bucket's gain is the logarithm of how much likelier the target is to use it;
a document's weight is the mean gain of its n-grams, and with Gumbel noise from its id added, the
highest scores are a draw without replacement in proportion to the exponentials of the weights.

The n-grams of each window of a batch are interned in open-addressed NumPy tables: XXH64 keys,
linear probing for all n-grams at once, and a comparison before a slot counts as found, so equal
hashes do no harm: bytes for words, and for runs the slots of their parts, whose bytes have been
compared. A slot holds the n-gram's bucket, worked out once, and its count; the first pass adds
these up, the second gathers the gains of the slots of all occurrences.

Both passes read texts where the scan has them. A task hands a count per bucket to the shuffle;
the gains (BUCKETS numbers) are all that reaches the driver. The ranking sorts narrow rows by range into a
table; a row's rank is its place in its file after all rows of the files before it, so no task
sees more than its range. Rows alike in all they hold are told apart by their place, so that they
spread over ranges too.

Defined results: null or wordless texts have no n-grams and weight 0; a null id is noise of the
empty id and comes last among ties; rows alike may swap ranks. An empty target leaves T = 0; an
empty table gives an empty result; further columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from shelfwise.llm.grams import PIECE, lowered, text_rows, windows
from shelfwise.llm.store import materialise, needs, short_batches, workers_import
from shelfwise.llm.text import slices

ORDERS = (1, 2)
BUCKETS = 10_000
MIN_WORDS = 20
SHARE_PERCENT = 25
SEED = 7
#: ASCII that is neither a digit nor, once lowered, a letter.
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
TABLE = lowered(SEPARATORS)
#: Times that words are compared by eight bytes; the rest of longer ones is compared at once.
LANES = 8
#: Odd numbers that mix the keys of a run's parts.
MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0x2545F4914F6CDD1D, 0xD6E8FEB86659FD93))


class SlotTable:
    """An open-addressed table with room for n items: `holder` is the item that a slot was given to."""

    def __init__(self, n: int):
        size = 1 << max(4, n.bit_length())  # more slots than items
        self.holder = np.full(size, -1, np.int32)

    def intern(self, keys: np.ndarray, same: Callable[[np.ndarray, np.ndarray], np.ndarray]
               ) -> np.ndarray:
        """The slot of each item; `same(a, b)` verifies that items of equal keys are equal."""
        mask = len(self.holder) - 1
        at = (keys & np.uint64(mask)).astype(np.int32)
        slots = np.empty(len(keys), np.int32)
        todo = np.arange(len(keys), dtype=np.int32)
        while len(todo):
            here = at[todo]
            free = self.holder[here] < 0
            self.holder[here[free]] = todo[free]  # one of those that want a free slot gets it
            holder = self.holder[here]
            found = keys[holder] == keys[todo]
            found[found] = same(holder[found], todo[found])
            slots[todo[found]] = here[found]
            todo = todo[~found]
            at[todo] = (at[todo] + 1) & mask
        return slots

    def used(self) -> tuple[np.ndarray, np.ndarray]:
        """Slots in use, and an item of each."""
        slots = np.flatnonzero(self.holder >= 0)
        return slots, self.holder[slots]


class Words:
    """Whether two words of a text have the same bytes, compared eight at a time."""

    def __init__(self, text: bytes, words: list[bytes], starts: np.ndarray, ends: np.ndarray):
        self.words, self.starts, self.length = words, starts, ends - starts
        padded = np.frombuffer(text + bytes(8), np.uint8)
        self.lanes = np.ndarray((len(text) + 1,), "<u8", padded, strides=(1,))

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        same = self.length[a] == self.length[b]
        open_ = np.flatnonzero(same & (a != b))
        for lane in range(LANES):
            if not len(open_):
                return same
            left = self.length[a[open_]] - 8 * lane
            differ = (self.lanes[self.starts[a[open_]] + 8 * lane]
                      ^ self.lanes[self.starts[b[open_]] + 8 * lane])
            part = left < 8
            differ[part] &= (np.uint64(1) << (8 * left[part]).astype(np.uint64)) - np.uint64(1)
            same[open_[differ != 0]] = False
            open_ = open_[(differ == 0) & (left > 8)]
        for k in open_:
            same[k] = self.words[a[k]] == self.words[b[k]]
        return same


@lru_cache(maxsize=256)
def _behind(length: int) -> np.ndarray:
    """What so many zero bytes make of a CRC-32, by byte of it: four tables of 256."""
    zero = bytes(length)
    nothing = zlib.crc32(zero)
    bits = [zlib.crc32(zero, 1 << i) ^ nothing for i in range(32)]
    value = np.arange(256)
    return np.array([np.bitwise_xor.reduce(
        [np.where(value >> i & 1, bits[8 * k + i], 0) for i in range(8)]) for k in range(4)],
        np.uint32)


def crc_joined(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of a + b from those of a and b and the length of b: the checksum is linear."""
    out = second.copy()
    for n in np.unique(length):
        rows = np.flatnonzero(length == n)
        table, crc = _behind(int(n)), first[rows]
        for k in range(4):
            out[rows] ^= table[k][crc >> np.uint32(8 * k) & np.uint32(255)]
    return out


def interned(texts: list[bytes], orders: tuple[int, ...] = ORDERS, buckets: int = BUCKETS,
             digest: Callable[[bytes], int] = xxhash.xxh64_intdigest
             ) -> Iterator[tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]]:
    """By window of the texts: the text of each word, and for each order (bucket of each slot,
    slot of each n-gram, text of each n-gram).

    A run is its run without the last word and that word. Both have slots by then, so equal runs
    are those of equal slots; its key is mixed from theirs, its CRC joined from theirs.
    """
    for window in windows(texts, TABLE, max(orders) - 1):
        words = window.text.split()
        length = window.ends - window.starts
        keys = np.fromiter(map(digest, words), np.uint64, len(words))
        table = SlotTable(len(words))
        slots = table.intern(keys, Words(window.text, words, window.starts, window.ends).same)
        used, item = table.used()
        distinct = [words[k] for k in item.tolist()]
        crc = np.zeros(len(table.holder), np.uint32)
        crc[used] = np.fromiter(map(zlib.crc32, distinct), np.uint32, len(used))
        spaced = crc_joined(np.full(len(used), zlib.crc32(b" "), np.uint32), crc[used], length[item])
        behind = np.zeros(len(table.holder), np.uint32)  # of a space and the word
        behind[used] = spaced
        run_keys, run_slots, run_crc, found = keys, slots, crc, []
        for n in range(1, max(orders) + 1):
            if n > 1:
                first = np.flatnonzero(window.owner[:len(words) - n + 1] == window.owner[n - 1:])
                last = first + n - 1
                a, b = run_slots[first], slots[last]
                mixed = (run_keys[first] * MIX[0]) ^ (keys[last] + MIX[1])
                mixed = (mixed ^ (mixed >> np.uint64(29))) * MIX[2]
                mixed ^= mixed >> np.uint64(32)
                table = SlotTable(len(first))
                got = table.intern(mixed, lambda x, y: (a[x] == a[y]) & (b[x] == b[y]))  # noqa: B023
                used, item = table.used()
                joined = np.zeros(len(table.holder), np.uint32)
                joined[used] = crc_joined(run_crc[a[item]], behind[b[item]],
                                          length[last[item]] + 1)
                run_keys, run_slots = np.zeros(len(words), np.uint64), np.zeros(len(words), np.int32)
                run_keys[first], run_slots[first], run_crc = mixed, got, joined
            if n in orders:
                new = window.first(n)
                found.append((run_crc % np.uint32(buckets), run_slots[new], window.owner[new]))
        yield window.owner[window.old:], found


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        for low, high in slices(batch, limit=PIECE):
            piece = batch.slice(low, high - low)
            yield piece, text_rows(piece.column("text"))


def _bucket_counts(orders: tuple[int, ...], buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for _, texts in _pieces(batches):
            for _, found in interned(texts, orders, buckets):
                for bucket, slots, _ in found:
                    times = np.bincount(slots, minlength=len(bucket))
                    counts += np.bincount(bucket, times, buckets).astype(np.int64)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()),
                                          pa.array(counts[used], pa.int64())], ["bucket", "n"])
    return run


def bucket_counts(rows: DataFrame, orders: tuple[int, ...] = ORDERS, buckets: int = BUCKETS
                  ) -> np.ndarray:
    """Occurrences of n-grams of all texts by bucket."""
    counts = np.zeros(buckets, np.int64)
    summed = needs(rows, "text").mapInArrow(_bucket_counts(orders, buckets),
                                            "bucket long, n long")
    with short_batches(rows.sparkSession):
        found = summed.groupBy("bucket").agg(F.sum("n")).collect()
    for bucket, n in found:
        counts[bucket] = n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target to source, by bucket, each count one larger."""
    n, all_source, all_target = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(
        float(t + 1) * float(all_source + n) / (float(s + 1) * float(all_target + n))))
        for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def _weights(gain: np.ndarray, orders: tuple[int, ...], schema: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in _pieces(batches):
            words, grams, total = (np.zeros(len(texts), np.int64) for _ in range(3))
            for word_owner, found in interned(texts, orders, len(gain)):
                words += np.bincount(word_owner, minlength=len(texts))
                for bucket, slots, owner in found:
                    grams += np.bincount(owner, minlength=len(texts))
                    total += np.bincount(owner, gain[bucket][slots], len(texts)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(words), pa.array(grams),
                 pa.array(total // np.maximum(grams, 1))], schema=schema)
    return run


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of Gumbel noise, from a hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    unit = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(unit))).cast("long")


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """rows with `rank`: 1 for the first in the order; written sorted, counted by file.

    A file is one range of the order, and row_index a row's place in it. What runs through one
    window is a line per file.
    """
    placed = materialise(rows.orderBy(*order), "ranked")
    meta = placed.metadataColumn("_metadata")
    part = F.regexp_extract(meta["file_name"], r"part-(\d+)", 1).cast("long")
    named = placed.select("*", part.alias("_part"), meta["row_index"].alias("_index"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    files = named.groupBy("_part").count().select(
        F.col("_part").alias("_of"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    return named.join(files, F.col("_part") == F.col("_of")).select(
        *[F.col(f"`{c}`") for c in rows.columns],
        (F.col("_before") + F.col("_index") + 1).cast("long").alias("rank"))


def resample(docs: DataFrame, target: DataFrame, share_percent: int = SHARE_PERCENT,
             min_words: int = MIN_WORDS, orders: tuple[int, ...] = ORDERS,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Every document's doc_id, n_words, n_features, weight, score, and rank if it is drawn."""
    workers_import(docs.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema

    gain = gains(bucket_counts(docs, orders, buckets), bucket_counts(target, orders, buckets))
    texts = needs(docs, "doc_id", "text")
    kinds = T.StructType([texts.schema["doc_id"], *[
        T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]])
    weighed = texts.mapInArrow(_weights(gain, orders, to_arrow_schema(kinds)), kinds)
    with short_batches(docs.sparkSession):
        scored = materialise(weighed.select(
            "*", (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score")), "scored")
    meta = scored.metadataColumn("_metadata")
    own = F.xxhash64(meta["file_name"], meta["row_index"])
    able = F.col("n_words") >= min_words
    best = ranked(scored.where(able).select("*", own.alias("_own")), F.col("score").desc(),
                  F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("_own")).drop("_own")
    drawn = share_percent * scored.where(able).count() // 100
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    return best.withColumn("rank", rank).unionByName(
        scored.where(~able).withColumn("rank", F.lit(None).cast("long")))

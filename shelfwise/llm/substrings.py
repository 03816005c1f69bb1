"""Substring deduplication with difference-cover anchors.

A window of 13 words that also starts in a document with a smaller doc_id loses its words. To find
such windows, runs of ANCHOR words are hashed at the positions p of a document for which p mod
PERIOD is in COVER. COVER is a difference cover: for any two positions i and j there is a shift
below PERIOD that brings both onto it. So two equal windows of ANCHOR + PERIOD - 1 = 13 words,
wherever they stand in their texts, share an anchor at the same place inside the window, and 3
of 7 positions are enough. Documents that share an anchor extend it: the windows of 13 words
around it are hashed, and the smallest doc_id of each decides.

Anchors and windows meet in buckets (see `blocks`), which answer each block of documents in one
row. Texts are shuffled once, by block, and read from that shuffle again for each step.

Defined results: null text counts as empty; a null doc_id counts as larger than all others and
rows without id do not remove from each other; rows with one doc_id do not remove from each
other either; an empty table gives an empty result; extra columns are ignored. Words are
compared by 64-bit hashes.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import blocks as B
from shelfwise.llm.store import needs, workers_import
from shelfwise.llm.text import Words, text_bytes, whole_windows, windows

WINDOW = 13
ANCHOR = 7
PERIOD = 7
#: Every difference modulo 7 is one of two of these.
COVER = (0, 1, 3)
_COVERED = np.isin(np.arange(PERIOD), COVER)
_LAST = np.iinfo(np.int64).max
_FLAG = np.uint64(1)


class _Block:
    """Words, anchors and windows of the documents of a block."""

    def __init__(self, table: pa.Table):
        data, offsets = text_bytes(table["text"])
        self.words = Words(data, offsets)
        self.owner = self.words.owner()
        self.ids = table["doc_id"].fill_null(_LAST).to_numpy() if len(table) \
            else np.zeros(0, np.int64)
        self.hashes = self.words.hashes()
        whole = whole_windows(self.owner, WINDOW)
        self.starts = np.flatnonzero(whole)
        self.window = windows(self.hashes, WINDOW)[self.starts]
        # Anchors of texts with a window; each lies in one, as ANCHOR + PERIOD - 1 = WINDOW.
        place = np.arange(len(self.owner)) - self.words.first[self.owner]
        fits = whole_windows(self.owner, ANCHOR)
        long = self.words.counts[self.owner] >= WINDOW
        at = _COVERED[place % PERIOD] & long
        self.anchors = np.flatnonzero(at[:len(fits)] & fits)
        self.anchor = windows(self.hashes, ANCHOR)[self.anchors] & ~_FLAG


def _flagged(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, its last bit set if it has several ids, and its smallest id."""
    order = np.argsort(keys)
    keys, ids = keys[order], ids[order]
    first = B.groups(keys)
    if not len(first):
        return keys, ids
    low, high = np.minimum.reduceat(ids, first), np.maximum.reduceat(ids, first)
    return keys[first] | (low != high).astype(np.uint64), low


def _anchor_rows(n: int):
    def rows(table: pa.Table) -> pa.Table:
        block = table["_block"][0].as_py()
        own = _Block(table)
        keys, _ = _flagged(own.anchor, own.ids[own.owner[own.anchors]])
        return B.to_table(B.bucket_rows(block, keys, [], n), ["bucket", "block", "keys"])
    return rows


def _shared_anchors(table: pa.Table) -> pa.Table:
    """The anchors that several documents have, told to every block that has them."""
    keys, block = B.entries(table, "keys", np.uint64)
    order = np.argsort(keys)
    keys, block = keys[order], block[order]
    bare = keys & ~_FLAG
    first = B.groups(bare)
    if not len(first):
        return B.to_table([], ["block", "keys"], 1)
    size = np.diff(np.append(first, len(bare)))
    several = (size > 1) | np.bitwise_or.reduceat(keys & _FLAG, first).astype(bool)
    chosen = B.spread(first, several, len(bare))
    return B.answers(block[chosen], [bare[chosen]], ["block", "keys"])


def _window_rows(n: int):
    """Windows around shared anchors, with the smallest doc_id of the block for each."""
    def rows(docs: pa.Table, shared: pa.Table) -> pa.Table:
        names = ["bucket", "block", "keys", "ids"]
        if not len(docs) or not len(shared):
            return B.to_table([], names)
        block = docs["_block"][0].as_py()
        own = _Block(docs)
        keys = np.sort(B.joined(shared["keys"], np.uint64))
        hit = own.anchors[B.contained(own.anchor, keys)]
        # An anchor at p lies in the windows that start at p - 6 .. p.
        change = np.zeros(len(own.owner) + 1, np.int64)
        np.add.at(change, np.maximum(hit - (WINDOW - ANCHOR), 0), 1)
        np.add.at(change, hit + 1, -1)
        around = np.cumsum(change)[own.starts] > 0
        window, low = _flagged(own.window[around] & ~_FLAG,
                               own.ids[own.owner[own.starts[around]]])
        return B.to_table(B.bucket_rows(block, window, [low], n), names)
    return rows


def _smallest_ids(table: pa.Table) -> pa.Table:
    """The smallest doc_id of a window, told to the blocks where a larger one has it."""
    keys, block = B.entries(table, "keys", np.uint64)
    ids = B.joined(table["ids"], np.int64)
    order = np.argsort(keys & ~_FLAG)
    keys, block, ids = keys[order], block[order], ids[order]
    bare = keys & ~_FLAG
    first = B.groups(bare)
    if not len(first):
        return B.to_table([], ["block", "keys", "ids"], 1)
    low = B.spread(first, np.minimum.reduceat(ids, first), len(bare))
    chosen = (low < ids) | (keys & _FLAG).astype(bool)
    return B.answers(block[chosen], [bare[chosen], low[chosen]], ["block", "keys", "ids"])


def _kept_text(docs: pa.Table, smallest: pa.Table) -> pa.Table:
    own = _Block(docs)
    removed = np.zeros(len(own.owner), bool)
    if len(smallest):
        keys, ids = B.joined(smallest["keys"], np.uint64), B.joined(smallest["ids"], np.int64)
        order = np.argsort(keys)
        keys, ids = keys[order], ids[order]
        window = own.window & ~_FLAG
        at = np.searchsorted(keys, window)
        at[at == len(keys)] = 0
        gone = own.starts[(keys[at] == window) & (ids[at] < own.ids[own.owner[own.starts]])]
        change = np.zeros(len(own.owner) + WINDOW + 1, np.int64)
        np.add.at(change, gone, 1)
        np.add.at(change, gone + WINDOW, -1)
        removed = np.cumsum(change)[:len(own.owner)] > 0
    lost = np.add.reduceat(np.append(removed, False), own.words.first[:-1]) if len(docs) else []
    lost = np.where(own.words.counts > 0, lost, 0).astype(np.int64)
    data, offsets = text_bytes(docs["text"])
    raw, first, texts = data.tobytes(), own.words.first, []
    for k in range(len(docs)):
        parts = raw[offsets[k]:offsets[k + 1]].split()  # splits at the six separators
        if lost[k]:
            parts = compress(parts, (~removed[first[k]:first[k + 1]]).tolist())
        texts.append(b" ".join(parts))
    return pa.table([docs["doc_id"].combine_chunks(),
                     pa.array(texts, pa.binary()).cast(pa.string()),
                     pa.array(own.words.counts.astype(np.int64)), pa.array(lost)],
                    names=["doc_id", "text", "n_words", "n_removed"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, text (the kept words joined by one space), n_words, n_removed of every document."""
    spark = docs.sparkSession
    workers_import(spark)
    rows = B.numbered(needs(docs, "doc_id", "text")).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.shiftright("_row", B.BLOCK_BITS).alias("_block")).repartition("_block")
    n = B.buckets(spark)
    anchors = rows.groupBy("_block").applyInArrow(
        _anchor_rows(n), "bucket long, block long, keys binary")
    shared = anchors.groupBy("bucket").applyInArrow(_shared_anchors, "block long, keys binary")
    found = rows.groupBy("_block").cogroup(shared.groupBy("block")).applyInArrow(
        _window_rows(n), "bucket long, block long, keys binary, ids binary")
    smallest = found.groupBy("bucket").applyInArrow(
        _smallest_ids, "block long, keys binary, ids binary")
    return rows.groupBy("_block").cogroup(smallest.groupBy("block")).applyInArrow(
        lambda docs, told: _kept_text(docs, told),
        "doc_id long, text string, n_words long, n_removed long")

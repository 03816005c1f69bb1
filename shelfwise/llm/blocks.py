"""Blocks of documents and buckets of hashes, between which numpy arrays travel as binary rows.

A block is a run of successive rows of one scan partition. What a block says about its hashes
goes to the buckets as one row per block and bucket, each hash once however many of the block's
documents have it; a bucket answers each block in one row. So a passage that a third of all
documents share costs a bucket one entry per block, and rows stay few and compact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.text import binary, joined, lengths

#: log2 of the rows of a block.
BLOCK_BITS = 11


def numbered(docs: DataFrame) -> DataFrame:
    """docs with _row, a number that does not change when a lost partition is read again."""
    return docs.withColumn("_row", F.monotonically_increasing_id())


def buckets(spark: SparkSession) -> int:
    """As many as shuffle partitions, which the submitter sizes to the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_rows(block: int, keys: np.ndarray, others: list[np.ndarray], n: int) -> list[tuple]:
    """(bucket, block, keys, *others): the entries of a block, a row for each bucket."""
    if not len(keys):
        return []
    to = ((keys >> np.uint64(32)) % np.uint64(n)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    to = to[order]
    edges = np.flatnonzero(np.diff(to)) + 1
    parts = [np.split(a[order], edges) for a in (keys, *others)]
    names = to[np.concatenate([[0], edges])]
    return [(int(b), block, *cols) for b, *cols in zip(names, *parts, strict=True)]


def to_table(rows: list[tuple], names: list[str], ints: int = 2) -> pa.Table:
    """Rows whose first `ints` values are numbers and whose others are arrays."""
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.table([pa.array(c, pa.int64()) if k < ints else binary(list(c))
                     for k, c in enumerate(columns)], names=names)


def answers(blocks: np.ndarray, arrays: list[np.ndarray], names: list[str]) -> pa.Table:
    """One row for each block, from entries with the block each belongs to."""
    if not len(blocks):
        return to_table([], names, 1)
    order = np.argsort(blocks, kind="stable")
    blocks = blocks[order]
    edges = np.flatnonzero(np.diff(blocks)) + 1
    firsts = blocks[np.concatenate([[0], edges])]
    parts = [np.split(a[order], edges) for a in arrays]
    return to_table([(int(b), *cols) for b, *cols in zip(firsts, *parts, strict=True)], names, 1)


def entries(table: pa.Table, keys: str, kind) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column and, for each, the block it came from."""
    column = table[keys]
    values = joined(column, kind)
    blocks = table["block"].to_numpy()
    return values, np.repeat(blocks, lengths(column, np.dtype(kind).itemsize))


def groups(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1])


def spread(starts: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """The value of its run for each of n entries."""
    return np.repeat(values, np.diff(np.append(starts, n)))


def contained(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which keys are in the sorted array `among`."""
    if not len(among):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(among, keys)
    at[at == len(among)] = 0
    return among[at] == keys


def per_block(batches: Iterator[pa.RecordBatch], row_column: int) -> Iterator[tuple[int, pa.Table]]:
    """(block, its rows) from a scan in row order; a block may come in several batches."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        block = batch.column(row_column).to_numpy() >> BLOCK_BITS
        edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for low, high in zip(edges, edges[1:], strict=False):
            if low == high:
                continue
            if now is not None and block[low] != now:
                yield int(now), pa.Table.from_batches(held)
                held = []
            now = block[low]
            held.append(batch.slice(low, high - low))
    if held:
        yield int(now), pa.Table.from_batches(held)

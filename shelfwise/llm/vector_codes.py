"""Product codes of vectors: each part of a vector becomes the number of its nearest entry.

A component x counts as the integer floor(256 * x). Vectors are cut into equal consecutive parts
and each part position has a codebook, fitted by rounds of assignment and mean over all vectors.
Distances are exact and come from value dictionaries: within a block of vectors each dimension
has few distinct integers; their squared differences to all entries are tabulated once, and the
distance of a part is gathered from these tables, a row for each dimension, and added up.

Memory is bounded by the block (BLOCK vectors by ENTRIES) and the codebooks (ENTRIES vectors),
which are all that reaches the driver. A round sends sums and counts per entry and task to the
shuffle, whatever the number of vectors; assigned rows are a table in the shared folder.

Defined results: vectors that are null or hold null, NaN or infinite components are left out. All
others are kept: those shorter than the longest count as ending in zeros, as does a width that
is no multiple of the parts. First entries are taken by distinct id, null being the last id; of several vectors
with one id the smallest counts; with fewer ids than ENTRIES there are fewer entries.
Repeated rows are coded alike, each in a row of its own. Integers beyond +-LARGEST count as that,
and errors beyond a long as the largest long. A table without vectors gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.store import materialise, needs, workers_import

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
BLOCK = 1024
LARGEST = 10 ** 27
MAX_LONG = 2 ** 63 - 1
#: Squares and their sums of a part stay below 2 ** 62 as long as integers stay below this.
SMALL = 1 << 26


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has finite components only."""
    # Null components make it null, NaN is larger than infinity.
    return vectors.where(F.forall(F.col(f"`{vector}`"), lambda x: F.abs(x) < F.lit(float("inf"))))


def integers(column: pa.Array, width: int) -> np.ndarray:
    """floor(256 * x) of each component, a row per vector; as Python numbers if some are large."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    if np.abs(flat).max(initial=0) < SMALL // SCALE:
        values = np.floor(flat * SCALE).astype(np.int64)
    else:
        values = np.array([max(-LARGEST, min(LARGEST, math.floor(x * SCALE) if abs(x) < 1e300
                                             else int(x))) for x in flat.tolist()], object)
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), values.dtype)
    out[np.arange(width) < sizes[:, None]] = values
    return out


class Codebooks:
    """entries[e, d]: component d of entry e; part p owns the dimensions from p * width on."""

    def __init__(self, entries: np.ndarray, parts: int):
        self.entries, self.parts = entries, parts
        self.width = entries.shape[1] // parts

    def nearest(self, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry (ties: the lowest) and its squared distance, by part."""
        small = block.dtype != object and self.entries.dtype != object and self.width <= 256
        kind = np.int64 if small else object
        codes = np.zeros((len(block), self.parts), np.int64)
        errors = np.zeros((len(block), self.parts), kind)
        for p in range(self.parts):
            distance = np.zeros((len(block), len(self.entries)), kind)
            for d in range(p * self.width, (p + 1) * self.width):
                values, place = np.unique(block[:, d], return_inverse=True)
                table = values.astype(kind)[:, None] - self.entries[:, d].astype(kind)
                table *= table
                distance += table[place]
            codes[:, p] = distance.argmin(1)
            errors[:, p] = distance[np.arange(len(block)), codes[:, p]]
        return codes, errors

    def digest(self) -> str:
        """SHA-256 of all entries' components by part, entry and position within the part."""
        by_part = self.entries.reshape(len(self.entries), self.parts, self.width)
        flat = by_part.transpose(1, 0, 2).reshape(-1)
        return hashlib.sha256(",".join(map(str, flat.tolist())).encode()).hexdigest()


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple]:
    for batch in batches:
        for low in range(0, batch.num_rows, BLOCK):
            piece = batch.slice(low, BLOCK)
            yield piece, integers(piece.column("vector"), width)


SUMS = "slot long, n long, total decimal(38,0)"


def _sums(books: Codebooks) -> Callable:
    """Per task and entry with parts: how many, and the sum of each of their components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, width = len(books.entries), books.width
        counts = np.zeros((books.parts, k), np.int64)
        sums = np.zeros((books.parts, k, width), np.int64)
        for _, block in _blocks(batches, books.entries.shape[1]):
            codes, _ = books.nearest(block)
            if block.dtype == object and sums.dtype != object:
                sums = sums.astype(object)
            for p in range(books.parts):
                np.add.at(sums[p], codes[:, p], block[:, p * width:(p + 1) * width])
                counts[p] += np.bincount(codes[:, p], minlength=k)
        used = np.flatnonzero(np.repeat(counts.reshape(-1) > 0, width))
        yield pa.RecordBatch.from_arrays([
            pa.array(used, pa.int64()),
            pa.array(np.repeat(counts.reshape(-1), width)[used], pa.int64()),
            pa.array([Decimal(int(x)) for x in sums.reshape(-1)[used]], pa.decimal128(38, 0)),
        ], ["slot", "n", "total"])
    return run


def _codes(books: Codebooks, schema: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, block in _blocks(batches, books.entries.shape[1]):
            codes, errors = books.nearest(block)
            text = codes.astype(np.uint8).tobytes().hex()
            step = 2 * books.parts
            error = [min(MAX_LONG, int(e)) for e in errors.sum(1)]
            yield pa.RecordBatch.from_arrays([
                piece.column("id"), piece.column("label"),
                pa.array([text[i * step:(i + 1) * step] for i in range(len(codes))], pa.string()),
                pa.array(error, pa.int64())], schema=schema)
    return run


def _first_entries(vectors: DataFrame, width: int, entries: int) -> np.ndarray:
    """The vectors of the smallest ids, ascending; a bounded number of rows."""
    ids = [r[0] for r in vectors.select("id").distinct().orderBy(F.col("id").asc_nulls_last())
           .limit(entries).collect()]
    known = [i for i in ids if i is not None]
    wanted = F.col("id").isin(known) if known else F.lit(False)
    if None in ids:
        wanted = wanted | F.col("id").isNull()
    rows = vectors.where(wanted).groupBy("id").agg(F.min("vector").alias("vector")) \
        .orderBy(F.col("id").asc_nulls_last()).collect()
    column = pa.array([r.vector for r in rows], pa.list_(pa.float64()))
    return integers(column, width)


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES,
          rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks over vectors (id, vector) without unusable rows; None if there are no rows."""
    longest = vectors.agg(F.max(F.size("vector"))).first()[0]
    if longest is None:
        return None
    width = -(-longest // parts)
    books = Codebooks(_first_entries(vectors, width * parts, entries), parts)
    for _ in range(rounds):
        sums = vectors.select("vector").mapInArrow(_sums(books), SUMS).groupBy("slot").agg(
            F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
        k = len(books.entries)
        after = books.entries.astype(object)
        for slot, n, total in sums:
            p, e, at = slot // (k * width), slot // width % k, slot % width
            after[e, p * width + at] = int(total) // n
        largest = max((abs(x) for x in after.reshape(-1)), default=0)
        books = Codebooks(after.astype(np.int64) if largest < SMALL else after, parts)
    return books


def encode(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding",
           label: str = "label", parts: int = PARTS, entries: int = ENTRIES,
           rounds: int = ROUNDS) -> DataFrame:
    """`id`, `label`, code, error, label_error (over equal labels), codebooks_sha256."""
    spark = vectors.sparkSession
    workers_import(spark)
    kept = usable(needs(vectors, id, vector, label).toDF("id", "vector", "label"), "vector")
    books = train(kept.select("id", "vector"), parts, entries, rounds)
    kinds = T.StructType([kept.schema["id"], kept.schema["label"],
                          T.StructField("code", T.StringType()),
                          T.StructField("error", T.LongType())])
    if books is None:
        coded = kept.select("id", "label", F.lit("").alias("code"),
                            F.lit(0).cast("long").alias("error"))
    else:
        from pyspark.sql.pandas.types import to_arrow_schema

        coded = kept.select("id", "label", "vector").mapInArrow(
            _codes(books, to_arrow_schema(kinds)), kinds)
    coded = materialise(coded, "codes")
    # A table of its own, so that a label with much of the rows can be split in the join.
    sums = materialise(coded.groupBy("label").agg(F.least(
        F.sum(F.col("error").cast("decimal(20,0)")), F.lit(MAX_LONG)).cast("long")
        .alias("label_error")), "label-errors")
    return coded.alias("c").join(
        sums.alias("s"), F.col("c.label").eqNullSafe(F.col("s.label")), "left").select(
        F.col("id").alias(id), F.col("c.label").alias(label), "code", "error", "label_error",
        F.lit(books.digest() if books else "").alias("codebooks_sha256"))

"""SimHash fingerprints and all links within a radius by covering locality-sensitive hashing.

Every bit position i carries a nonzero vector m(i) of radius + 1 bits. There is a table for each
nonzero vector v of that length; it hashes a fingerprint to its bits at the places where v . m(i)
is odd. The m(i) of at most `radius` differing places span less than the whole space, so some v
is orthogonal to all of them: that table ignores every place in which the two differ, and they
meet in it. Any pair within the radius collides, with certainty.

Distinct fingerprints only are hashed, so copies are one row. In a bucket of up to BUCKET of them
all are compared. Fuller buckets, however full, are searched by midpoints: two of their
fingerprints are at most 2 apart exactly if they share a number that is at most 1 away from both,
so each is listed under itself and itself with one ignored bit changed, and whoever meets there
is linked to the smallest. No bucket is collected beyond BUCKET rows, none is left out, and a
midpoint has at most 65 members.

Links join fingerprints, not documents; components and the way back to documents are joins over
tables in the shared folder.

Defined results: null or wordless texts have fingerprint 0, which links like any other. Rows
without id have a fingerprint, and the component_id of those they reach; a component without any
id has a null one. Repeated rows share their results. An empty table gives an empty result;
further columns are ignored. Texts are read whole, in windows of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.components import components
from shelfwise.llm.grams import lowered, text_rows, windows
from shelfwise.llm.store import materialise, needs, workers_import
from shelfwise.llm.text import slices

BITS = 64
RADIUS = 2
SHINGLE = 3
SEED = 42
BUCKET = 64
#: Hashes whose bits are counted at once.
COUNTED = 1 << 15
TABLE = lowered(b" \t\n\x0b\x0c\r")


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The bits that each table keeps."""
    vectors = range(1, 2 ** (radius + 1))
    of_place = [vectors[i % len(vectors)] for i in range(bits)]
    return [sum(1 << i for i, m in enumerate(of_place) if (m & v).bit_count() % 2)
            for v in vectors]


def _hashes(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(text[a:b], SEED) for a, b in
                        zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, len(starts))


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """The fingerprint of each text as uint64."""
    ones = np.zeros((len(texts), BITS), np.int64)
    n = np.zeros(len(texts), np.int64)
    words = np.zeros(len(texts), np.int64)
    for window in windows(texts, TABLE, SHINGLE - 1):
        words += np.bincount(window.owner[window.old:], minlength=len(texts))
        starts, ends, owner = window.runs(SHINGLE)
        for low in range(0, len(starts), COUNTED):
            part = slice(low, low + COUNTED)
            h = _hashes(window.text, starts[part], ends[part])
            bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, BITS // 8), axis=1,
                                 bitorder="little")
            docs, first, counts = np.unique(owner[part], return_index=True, return_counts=True)
            ones[docs] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
            n[docs] += counts
    for d in np.flatnonzero((words > 0) & (words < SHINGLE)):
        h = xxhash.xxh64_intdigest(b" ".join(texts[d].translate(TABLE).split()), SEED)
        ones[d] = [h >> i & 1 for i in range(BITS)]
        n[d] = 1
    set_bits = np.packbits(2 * ones > n[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(set_bits).view("<u8").reshape(-1)


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high in slices(batch):
            piece = batch.slice(low, high - low)
            found = fingerprints(text_rows(piece.column("text")))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(found.view(np.int64), pa.int64())],
                ["doc_id", "fp"])


def _near_pairs(radius: int):
    """Pairs within the radius of each list of fingerprints."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("members")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            first = np.cumsum(sizes) - sizes
            for size in np.unique(sizes):
                rows = flat[first[sizes == size][:, None] + np.arange(size)]
                i, j = np.triu_indices(size, 1)
                step = max(1, (1 << 20) // max(1, len(i)))
                for low in range(0, len(rows), step):
                    a, b = rows[low:low + step][:, i], rows[low:low + step][:, j]
                    near = np.bitwise_count((a ^ b).view(np.uint64)) <= radius
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a[near], pa.int64()), pa.array(b[near], pa.int64())], ["a", "b"])
    return run


def _tables(fp: Column, masks: list[int]) -> Column:
    """A fingerprint's (table, key) in every table."""
    return F.explode(F.array(*[F.struct(F.lit(t).alias("t"), fp.bitwiseAND(F.lit(_signed(m)))
                                        .alias("key")) for t, m in enumerate(masks)]))


def near_links(distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp`, some of them twice; their components are
    those of all pairs within the radius."""
    if radius > 2:
        raise ValueError("midpoints prove a distance of 2 at most")
    masks = covering_masks(radius)
    entries = distinct.select("fp", _tables(F.col("fp"), masks).alias("e")) \
        .select("fp", "e.t", "e.key")
    full = entries.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    met = materialise(entries.join(full, ["t", "key"]), "met")
    lists = met.where(F.col("n") <= bucket).groupBy("t", "key").agg(
        F.collect_list("fp").alias("members")).select("members")
    pairs = lists.mapInArrow(_near_pairs(radius), "a long, b long")
    reached = F.array(*[
        F.array(*[F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(_signed(1 << i)))
                                  for i in range(BITS) if not m >> i & 1]) for m in masks])
    listed = met.where(F.col("n") > bucket).select(
        "t", "fp", F.explode(F.get(reached, F.col("t"))).alias("mid"))
    if radius == 1:  # only the fingerprints themselves are midpoints of pairs 1 apart
        listed = listed.join(distinct.select(F.col("fp").alias("mid")), "mid", "left_semi")
    hubs = listed.groupBy("t", "mid").agg(F.min("fp").alias("hub"), F.count("*").alias("n")) \
        .where("n > 1")
    stars = listed.join(hubs.drop("n"), ["t", "mid"]).where("fp <> hub").select(
        F.col("hub").alias("a"), F.col("fp").alias("b"))
    return pairs.unionAll(stars)


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (hex), component_id: the smallest doc_id that links lead to."""
    workers_import(docs.sparkSession)
    texts = needs(docs, "doc_id", "text")
    kinds = T.StructType([texts.schema["doc_id"], T.StructField("fp", T.LongType())])
    marked = materialise(texts.mapInArrow(_fingerprint_batches, kinds), "simhash")
    distinct = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    joined = components(near_links(distinct, radius).distinct())
    labelled = materialise(distinct.join(joined, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")), "labelled")
    lowest = materialise(labelled.groupBy("component").agg(
        F.min("first_id").alias("component_id")), "lowest")
    named = materialise(labelled.join(lowest, "component").select(
        F.col("fp").alias("of"), "component_id"), "named")
    return marked.join(named, F.col("fp") == F.col("of"), "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

"""N-gram Jaccard join as a blocked sparse matrix product.

The matrix has a row for each document and a column for each n-gram; two documents link when
their rows' overlap is at least 80 % of their union. The product of the matrix with itself is
taken in column blocks (buckets of n-gram hashes), which add up the overlaps of row pairs, and
is kept small by bounds that follow from a row's size n:

- a partner has between 4/5 n and 5/4 n n-grams;
- it shares at least 4/5 n of them, so the first k that both have, in one order of all n-grams,
  are among its first n - ceil(4/5 n) + k (its outer prefix, with k = 1 + n // SHARE). Rows enter
  the column blocks only with so many n-grams, rarest first;
- both share at least 4/9 of the sum of their sizes, so for a partner of the same size or a larger
  one the first n - ceil(8/9 n) + k are enough (the inner prefix), and for partners a little
  smaller some prefix in between. Pairs that share fewer than k there are discarded.

Which n-grams are frequent comes from counts in each block of documents; the order changes the
work, never the result. Altered copies have their own n-grams first, so those too unlike to link
hardly meet.

Inside a column rows are not laid against each other but against a hub, and each row is compared
with the hub it shares most columns with: links give components. A last round finds the links
between rows of different components, in two ways.

Rows near one hub, such as altered copies of one original that are all a little too unlike it,
are joined by their differences from it. Where x lacks Dx of the hub's h n-grams and has Ex others,
x and y share h - |Dx| - |Dy| n-grams and one more for each difference they have in common. With
u = 5 |D| + 4 |E| a linked pair has t = ceil((ux + uy - h) / 9) common differences at least, and
x links to the hub itself exactly if ux <= h. So t is positive for rows of different components,
and the first common difference, in one order of all, is among the first |D| + |E| - t + 1 of both.
Own n-grams come first in that order: those that two copies both lack hardly ever bring them
together, and rows enter with so many differences only as their smallest t asks for.

For rows of different hubs, columns that still hold several components and several hubs add up
the whole counts of all such pairs. So every link between documents of different components is
found, and copies are never paired with each other. Equal rows of a block of documents enter once.

Defined results: texts without words and null texts have no n-grams and link to nothing; so do
rows without id, whose component is null; rows that repeat an id link by their texts like any
others; an empty table gives an empty result; extra columns are ignored. N-grams are compared by
64-bit hashes. Rows are named by their file and the place in it, which no cut of a scan changes;
documents that are not rows of Parquet files are written to such files first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from shelfwise.llm import blocks as B
from shelfwise.llm.components import components
from shelfwise.llm.store import (materialise, needs, numbered, short_batches, stored,
                                 workers_import, wrapped)
from shelfwise.llm.text import (Words, binary, cuts, joined, lengths, mix, slices, text_bytes,
                                whole_windows, windows)

WORDS = 5
#: An n-gram that so many different documents of a block have counts as frequent...
FREQUENT_IN_BLOCK = 4
#: ... and so many of the most frequent ones are known by every task (8 bytes each).
FREQUENT_KNOWN = 200_000
LEVELS = 16
#: Bytes of text whose words are hashed and sorted at once; of a longer text all are.
TEXT_AT_ONCE = 1 << 20
#: N-grams of row pairs that a task lays side by side at once.
GRAMS_AT_ONCE = 1 << 20
#: Prefixes of a row, by the largest partner-to-row ratio (in percent) of sizes they serve; the
#: first is the inner prefix, for partners of the same size or larger, the last the outer one.
RATIOS = (100, 107, 115, 125)
#: Where bands of like size begin, in parts of a band.
BAND_SHIFTS = (0.0, 0.5)
#: A pair must share one n-gram more than this part of the smaller row within the prefixes...
SHARE = 60
#: ... and to be compared with a hub, this part of it.
HUB_SHARE = 10
#: A row is near its hub if they share so little as a part of NEAR of both sizes (0.5 in likeness).
NEAR = 3
_SALT = np.uint64(0x5851F42D4C957F2D)


@dataclass
class Rows:
    """The sets of the documents of a block, one after the other in the order of the columns."""

    grams: np.ndarray       # all sets' n-grams
    owner: np.ndarray       # whose
    place: np.ndarray       # the place of each in its set
    sizes: np.ndarray       # of the sets
    first: np.ndarray       # the first document with the same set


def _in_order(data: np.ndarray, offsets: np.ndarray, first: int, frequent: np.ndarray | None,
              rank: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of some texts' sets and whose they are, set by set; `first` numbers the first."""
    w = Words(data, offsets, lower=True)
    hashes, owner = w.hashes(), w.owner()
    whole = whole_windows(owner, WORDS)
    grams, owner = windows(hashes, WORDS)[whole], owner[:len(whole)][whole]
    short = np.flatnonzero((w.counts > 0) & (w.counts < WORDS))
    if len(short):
        few = [windows(hashes[w.first[d]:w.first[d + 1]], int(w.counts[d])) for d in short]
        grams, owner = np.concatenate([grams, *few]), np.concatenate([owner, short])
    level = np.zeros(len(grams), np.int32)
    if frequent is not None and len(frequent):
        at = np.searchsorted(frequent, grams)
        at[at == len(frequent)] = 0
        level = np.where(frequent[at] == grams, rank[at], 0).astype(np.int32)
    order = np.argsort(grams)
    within = owner[order].astype(np.int32) * LEVELS + level[order]
    if len(w.counts) * LEVELS < 1 << 16:
        within = within.astype(np.uint16)  # sorted by radix
    order = order[np.argsort(within, kind="stable")]
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return grams[new], owner[new] + first


def incidence(table: pa.Table, usable: np.ndarray | None = None,
              frequent: np.ndarray | None = None, rank: np.ndarray | None = None) -> Rows:
    """Sets of 5-word shingles in lower case; a shorter text has one, all its words.

    A set is in the order of the columns: by rank, then by hash. frequent: sorted hashes of
    frequent n-grams, rank: theirs, from 1; all others have 0. usable: rows that may be equal.
    """
    data, offsets = text_bytes(table["text"])
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    parts = [_in_order(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low], low,
                       frequent, rank) for low, high in cuts(offsets, TEXT_AT_ONCE)]
    grams, owner = (np.concatenate(x) for x in zip(none, *parts, strict=True))
    del parts
    n = len(table)
    sizes = np.bincount(owner, minlength=n)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    place = np.arange(len(grams)) - starts[owner]
    first = np.arange(n)
    full = np.flatnonzero(sizes)
    if len(full):
        marks = np.column_stack([np.add.reduceat(mix(grams ^ salt), starts[full])
                                 for salt in (np.uint64(0), _SALT)] + [sizes[full].astype(np.uint64)])
        if usable is not None:
            marks, full = marks[usable[full]], full[usable[full]]
        _, firsts, same = np.unique(marks, axis=0, return_index=True, return_inverse=True)
        first[full] = full[firsts[same.reshape(-1)]]
    return Rows(grams, owner, place, sizes, first)


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind 0: an n-gram and its count in a block. kind 1: row, doc_id, size."""
    names = ["kind", "a", "b", "c"]
    for _, table in B.per_block(batches, 0):
        ids, numbers = table["doc_id"].combine_chunks(), table["_row"].to_numpy()
        valid = np.array(ids.is_valid())
        rows = incidence(table, valid)
        different = valid & (rows.first == np.arange(len(table)))
        every = rows.grams[different[rows.owner]]
        every.sort()
        first = B.groups(every)
        counts = np.diff(np.append(first, len(every)))
        often = counts >= FREQUENT_IN_BLOCK
        found = every[first[often]].view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(len(found), np.int32)), pa.array(found), pa.array(counts[often]),
             pa.nulls(len(found), pa.int64())], names=names)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(len(table), np.int32)), pa.array(numbers), ids,
             pa.array(rows.sizes.astype(np.int64))], names=names)


def _frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and ranks of at most FREQUENT_KNOWN n-grams with the highest counts.

    The rank is the count's number of binary digits, so that LEVELS are enough."""
    summed = materialise(counts.groupBy("a").agg(F.sum("b").alias("b")), "frequent")
    shape = sorted((tuple(r) for r in summed.groupBy(F.least("b", F.lit(10_000)).alias("b"))
                    .count().collect()), reverse=True)
    least, known = None, 0
    for count, n in shape:
        if known and known + n > FREQUENT_KNOWN:
            break
        least, known = count, known + n
    top = summed.filter(F.col("b") >= (least or 0))
    if known > FREQUENT_KNOWN:
        top = top.orderBy(F.desc("b"), "a").limit(FREQUENT_KNOWN)
    got = top.toArrow()
    hashes = got["a"].to_numpy().view(np.uint64)
    rank = np.minimum(np.log2(np.maximum(got["b"].to_numpy(), 1)).astype(np.int32) + 1, LEVELS - 1)
    order = np.argsort(hashes)
    return hashes[order], rank[order]


def prefix(n: np.ndarray, ratio: int) -> np.ndarray:
    """How many n-grams of a row of n must be looked at for partners of n * 100 / ratio or more.

    Both share at least 4/9 of the sum of their sizes (rounded up where that is exact).
    """
    shared = {100: (8 * n + 8) // 9, 125: (4 * n + 4) // 5}.get(
        ratio, 4 * n * (100 + ratio) // (9 * ratio))
    return n - shared + n // SHARE + 1


def _entries(shipped, n: int):
    """Prefix n-grams of a block's different rows, a row for each column block.

    sizes: the row's size times len(RATIOS), plus the first of its prefixes with the n-gram. A row
    without keys has the block's other rows, and as sizes the rows that these are equal to: which
    of equal rows enters is told where it is decided, as another scan may cut a block in two.
    """
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, rank = shipped.value
        for block, table in B.per_block(batches, 0):
            valid = np.array(table["doc_id"].combine_chunks().is_valid())
            rows = incidence(table, valid, frequent, rank)
            use = valid & (rows.first == np.arange(len(table)))
            n_grams = rows.sizes
            ends = np.stack([prefix(n_grams, r) for r in RATIOS])
            chosen = use[rows.owner] & (rows.place < ends[-1][rows.owner])
            owner = rows.owner[chosen]
            part = (rows.place[chosen] >= ends[:-1, owner]).sum(axis=0)
            number = table["_row"].to_numpy() - (block << B.BLOCK_BITS)
            got = B.bucket_rows(block, rows.grams[chosen],
                                [number[owner].astype(np.uint16),
                                 (n_grams[owner] * len(RATIOS) + part).astype(np.uint32)], n)
            equal = np.flatnonzero(valid & ~use)
            if len(equal):
                got.append((block % n, block, np.zeros(0, np.uint64), number[equal].astype(np.uint16),
                            number[rows.first[equal]].astype(np.uint32)))
            yield from B.to_table(got, ["bucket", "block", "keys", "rows", "sizes"]).to_batches()
    return emit


def _columns(table: pa.Table) -> pa.Table:
    """column, row, size of the row, the first of its prefixes with this column, how many columns
    have these same rows, and how many rows. Part -1: row and, as column, the row it is equal to."""
    entered = lengths(table["keys"], 8) > 0
    told = table.filter(pa.array(~entered))
    table = table.filter(pa.array(entered))
    above = np.repeat(told["block"].to_numpy() << B.BLOCK_BITS, lengths(told["rows"], 2))
    equal = above | joined(told["rows"], np.uint16).astype(np.int64)
    first_equal = above | joined(told["sizes"], np.uint32).astype(np.int64)
    none = np.zeros(len(equal), np.int64)
    links = (first_equal, equal, none, none - 1, none, none)
    grams, block = B.entries(table, "keys", np.uint64)
    row = (block << B.BLOCK_BITS) | joined(table["rows"], np.uint16).astype(np.int64)
    size = joined(table["sizes"], np.uint32).astype(np.int64)
    order = np.lexsort((row, grams))
    grams, row, size = grams[order], row[order], size[order]
    first = B.groups(grams)
    if len(first):
        several = B.spread(first, np.diff(np.append(first, len(grams))) > 1, len(grams))
        grams, row, size = grams[several], row[several], size[several]
    first = B.groups(grams)
    times = np.zeros(len(first), np.int64)
    rows = np.diff(np.append(first, len(grams)))
    if len(first):
        # Columns of the same rows say the same: one of them stays, with their number.
        part = row * len(RATIOS) + size % len(RATIOS)
        marks = np.add.reduceat(mix(part.astype(np.uint64) ^ _SALT), first)
        _, kept, counts = np.unique(marks, return_index=True, return_counts=True)
        times[kept] = counts
    times, rows = B.spread(first, times, len(grams)), B.spread(first, rows, len(grams))
    stay = times > 0
    found = (grams.view(np.int64), row, size // len(RATIOS), size % len(RATIOS), times, rows)
    return pa.table([pa.array(np.concatenate([x[stay], y])) for x, y in zip(found, links, strict=True)],
                    names=["column", "row", "size", "part", "times", "rows"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high in slices(batch):
            part = batch.slice(low, high - low)
            rows = incidence(pa.Table.from_batches([part]))
            ends = np.cumsum(rows.sizes)
            sets = [np.sort(p) for p in np.split(rows.grams, ends[:-1])]
            yield pa.RecordBatch.from_arrays([part.column(0), binary(sets)], names=["row", "grams"])


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two numbers and the n-grams of two rows -> the numbers, where the rows link."""
    for batch in batches:
        sizes = lengths(batch.column(2), 8) + lengths(batch.column(3), 8)
        total, low = np.append(0, np.cumsum(sizes)), 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(total, total[low] + GRAMS_AT_ONCE, "right")) - 1)
            yield _block_overlaps(batch.slice(low, high - low))
            low = high


def _block_overlaps(batch: pa.RecordBatch) -> pa.RecordBatch:
    a, b = batch.column(2), batch.column(3)
    na, nb = lengths(a, 8), lengths(b, 8)
    pair = np.concatenate([np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)])
    grams = np.concatenate([joined(a, np.uint64), joined(b, np.uint64)])
    order = np.argsort(grams, kind="stable")
    order = order[np.argsort(pair[order].astype(np.int32), kind="stable")]
    grams, pair = grams[order], pair[order]
    both = (grams[1:] == grams[:-1]) & (pair[1:] == pair[:-1])
    shared = np.bincount(pair[1:][both], minlength=len(na))
    link = pa.array(100 * shared >= 80 * (na + nb - shared))
    return pa.RecordBatch.from_arrays([batch.column(0).filter(link), batch.column(1).filter(link)],
                                      names=["a", "b"])


def _grown(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the documents: never broadcast, so that a small table is
    joined as a large one is."""
    return side.hint("merge")


def _paired(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b), and the sorted n-grams of both. A row's n-grams are made once."""
    wanted = pairs.select(F.col("a").alias("_r")).unionAll(pairs.select("b")).distinct()
    sets = materialise(
        docs.join(_grown(wanted), F.col("_row") == F.col("_r"), "left_semi").select("_row", "text")
        .mapInArrow(_sets, "row long, grams binary"), "sets")
    a = sets.select(F.col("row").alias("_ra"), F.col("grams").alias("_ga"))
    b = sets.select(F.col("row").alias("_rb"), F.col("grams").alias("_gb"))
    both = pairs.join(_grown(b), F.col("b") == F.col("_rb")).join(_grown(a), F.col("a") == F.col("_ra"))
    return both.select(*pairs.columns, "_ga", "_gb")


def _linked(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """a, b: the labels of those of the pairs whose overlap suffices."""
    return _paired(docs, pairs).select("label_a", "label_b", "_ga", "_gb").mapInArrow(
        _overlaps, "a long, b long")


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hubs a and rows b with their n-grams -> sizes, and how b differs from a, if that is not much."""
    for batch in batches:
        sizes = lengths(batch.column(2), 8) + lengths(batch.column(3), 8)
        total, low = np.append(0, np.cumsum(sizes)), 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(total, total[low] + GRAMS_AT_ONCE, "right")) - 1)
            yield _block_differences(batch.slice(low, high - low))
            low = high


def _block_differences(batch: pa.RecordBatch) -> pa.RecordBatch:
    a, b = batch.column(2), batch.column(3)
    na, nb = lengths(a, 8), lengths(b, 8)
    pair = np.concatenate([np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)])
    grams = np.concatenate([joined(a, np.uint64), joined(b, np.uint64)])
    of_hub = np.arange(len(grams)) < na.sum()
    order = np.argsort(grams, kind="stable")
    order = order[np.argsort(pair[order].astype(np.int32), kind="stable")]
    grams, pair, of_hub = grams[order], pair[order], of_hub[order]
    twice = np.zeros(len(grams), bool)
    both = (grams[1:] == grams[:-1]) & (pair[1:] == pair[:-1])
    twice[1:] = both
    twice[:-1] |= both
    shared = np.bincount(pair[twice], minlength=len(na)) // 2
    near = NEAR * shared >= na + nb
    alone = ~twice & near[pair]
    # Own n-grams first, then those that the hub alone has, complemented.
    differ, of, lacks = grams[alone], pair[alone], of_hub[alone]
    order = np.lexsort((differ, lacks, of))
    differ = np.where(lacks[order], ~differ[order], differ[order])
    ends = np.cumsum(np.bincount(of, minlength=len(na)))
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), pa.array(na), pa.array(nb), pa.array(shared),
         pa.array(near), binary(np.split(differ, ends[:-1]))],
        names=["a", "b", "hub_size", "size", "shared", "near", "differ"])


COMPARED = "a long, b long, hub_size long, size long, shared long, near boolean, differ binary"


def _difference_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The differences by which a row may meet others of its hub, each with its place.

    A row that does not link to the hub needs t >= (u - h) / 5 of them: a partner has at least t
    differences, so its own u is 4 t or more. One that does only meets rows that do not, whose u
    is above h.
    """
    names = ["key", "row", "label", "place", "differences", "u", "hub_size", "size"]
    for batch in batches:
        hub, row, label, h, n, shared = (batch.column(i).to_numpy() for i in range(6))
        lacked, own = h - shared, n - shared
        total, u = lacked + own, 5 * lacked + 4 * own
        least = np.where(u > h, -((h - u) // 5), (u + 9) // 9)
        take = np.clip(total - least + 1, 0, total)
        differ = joined(batch.column(6), np.uint64)
        owner = np.repeat(np.arange(len(total)), total)
        place = np.arange(len(differ)) - np.repeat(np.cumsum(total) - total, total) + 1
        stay = place <= take[owner]
        owner, place = owner[stay], place[stay]
        key = mix(differ[stay] ^ mix(hub[owner].astype(np.uint64) ^ _SALT))
        yield pa.RecordBatch.from_arrays(
            [pa.array(key.view(np.int64)), pa.array(row[owner]), pa.array(label[owner]),
             pa.array(place.astype(np.int32)), pa.array(total[owner].astype(np.int32)),
             *[pa.array(x[owner].astype(np.int32)) for x in (u, h, n)]], names=names)


def _labelled(rows: DataFrame, row: str, labels: DataFrame) -> DataFrame:
    """rows with `label`, the component of a row so far, or the row itself."""
    known = labels.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
    return rows.join(_grown(known), F.col(row) == F.col("_n"), "left").withColumn(
        "label", F.coalesce("_c", row)).drop("_n", "_c")


def _hub_mates(compared: DataFrame, labels: DataFrame) -> DataFrame:
    """a, b, label_a, label_b: rows near one hub, of different labels, that may share differences
    enough."""
    named = materialise(_labelled(compared.filter("near"), "b", labels).select(
        "a", "b", "label", "hub_size", "size", "shared", "differ"), "near")
    mixed = named.groupBy(F.col("a").alias("_hub")).agg(
        F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("_hub")
    entries = materialise(named.join(_grown(mixed), F.col("a") == F.col("_hub"), "left_semi").mapInArrow(
        _difference_entries, "key long, row long, label long, place int, differences int, u int, "
        "hub_size int, size int"), "differences")
    x, y = entries.alias("x"), entries.alias("y")
    least = F.floor((F.col("x.u") + F.col("y.u") - F.col("x.hub_size") + 8) / 9)

    def reaches(side: str) -> Column:
        return F.col(f"{side}.place") <= F.col(f"{side}.differences") - least + 1

    nx, ny = F.col("x.size"), F.col("y.size")
    return x.join(_grown(y), (F.col("x.key") == F.col("y.key")) & (F.col("x.row") < F.col("y.row"))
                  & (F.col("x.label") != F.col("y.label")) & reaches("x") & reaches("y")
                  & (5 * nx >= 4 * ny) & (5 * ny >= 4 * nx)) \
        .select(F.col("x.row").alias("a"), F.col("y.row").alias("b"),
                F.col("x.label").alias("label_a"), F.col("y.label").alias("label_b")).distinct()


def _hub_pairs(entries: DataFrame) -> DataFrame:
    """a, b: each row b and the hub it shares most columns with, if these are not far too few.

    The hub of a column, for rows of like size, is the row that has most company in all its
    columns: of an original and its altered copies the original. Like sizes are bands, laid out
    twice with their edges apart, so that hubs of neighbouring bands meet as well. This only
    decides what is compared first.
    """
    shifts = F.array(*[F.lit(x) for x in BAND_SHIFTS])
    banded = entries.withColumn("shift", F.explode(shifts)) \
        .withColumn("band", F.floor(F.log("size") / math.log(5 / 4) + F.col("shift")))
    hubs = banded.groupBy("column", "shift", "band").agg(
        F.max_by("row", "rank").alias("hub"), F.max_by("size", "rank").alias("hub_size"),
        F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    least, most = F.least("size", "hub_size"), F.greatest("size", "hub_size")
    shared = banded.join(_grown(hubs), ["column", "shift", "band"]) \
        .filter((F.col("row") != F.col("hub")) & (5 * least >= 4 * most)) \
        .groupBy("row", "hub", "shift").agg(F.sum("times").alias("shared"), F.min(least).alias("size")) \
        .filter(F.col("shared") > F.floor(F.col("size") / HUB_SHARE))
    return shared.groupBy("row").agg(F.max_by("hub", "shared").alias("a")) \
        .select("a", F.col("row").alias("b"))


def _open_columns(entries: DataFrame, labels: DataFrame, compared: DataFrame) -> DataFrame:
    """Entries with their rows' labels and hubs, of columns whose rows differ in both.

    A row that is not near a hub is its own.
    """
    hubs = compared.filter("near").select(F.col("b").alias("_b"), F.col("a").alias("_hub"))
    named = _labelled(entries, "row", labels).join(_grown(hubs), F.col("row") == F.col("_b"), "left") \
        .withColumn("hub", F.coalesce("_hub", "row")).drop("_b", "_hub")
    mixed = named.groupBy("column").agg(*[f(c).alias(n) for c, low, high in (
        ("label", "l0", "l1"), ("hub", "h0", "h1")) for f, n in ((F.min, low), (F.max, high))]) \
        .filter("l0 < l1 and h0 < h1").select("column")
    return materialise(named.join(_grown(mixed), "column", "left_semi"), "columns")


def _other_pairs(entries: DataFrame) -> DataFrame:
    """a, b, label_a, label_b: all row pairs of different labels and hubs whose sizes and whole
    counts allow a link.

    Of the smaller row x the inner prefix counts, of the other that for the ratio of their sizes.
    Both hold the first n // SHARE + 1 n-grams that a linked pair has in common.
    """
    x, y = entries.filter("part = 0").alias("x"), entries.alias("y")
    nx, ny = F.col("x.size"), F.col("y.size")
    needed = F.lit(len(RATIOS) - 1)
    for k in reversed(range(len(RATIOS) - 1)):
        needed = F.when(100 * ny <= RATIOS[k] * nx, k).otherwise(needed)
    ordered = (nx < ny) | ((nx == ny) & (F.col("x.row") < F.col("y.row")))
    return x.join(_grown(y), (F.col("x.column") == F.col("y.column")) & ordered & (5 * nx >= 4 * ny)
                  & (F.col("x.label") != F.col("y.label")) & (F.col("x.hub") != F.col("y.hub"))
                  & (F.col("y.part") <= needed)) \
        .groupBy(F.col("x.row").alias("a"), F.col("y.row").alias("b")) \
        .agg(F.sum("x.times").alias("shared"), F.min(nx).alias("size"),
             F.min("x.label").alias("label_a"), F.min("y.label").alias("label_b")) \
        .filter(F.col("shared") > F.floor(F.col("size") / SHARE)) \
        .select("a", "b", "label_a", "label_b")


def similar_documents(docs: DataFrame) -> DataFrame:
    """row, doc_id, n_shingles, component_id, kept of every document.

    kept: true for one row of each component, that with the smallest doc_id.
    """
    spark = docs.sparkSession
    workers_import(spark)
    with short_batches(spark):
        docs = numbered(stored(needs(docs, "doc_id", "text")),
                        F.col("doc_id").cast("long").alias("doc_id"), "text") \
            .select("_row", "doc_id", "text")
        facts = materialise(docs.mapInArrow(_facts, "kind int, a long, b long, c long"), "facts")
        rows = facts.filter("kind = 1").select(
            F.col("a").alias("row"), F.col("b").alias("doc_id"), F.col("c").alias("n_shingles"))
        shipped = spark.sparkContext.broadcast(_frequent(facts.filter("kind = 0").select("a", "b")))
        columns = docs.mapInArrow(_entries(shipped, B.buckets(spark)),
                                  "bucket long, block long, keys binary, rows binary, sizes binary") \
            .groupBy("bucket").applyInArrow(
                _columns, "column long, row long, size long, part long, times long, rows long")
        # A row's entries are as many as its prefix and the rows of its block that are equal to it.
        of_row = W.partitionBy("row")
        company = F.sum(F.col("times") * (F.col("rows") - 1)).over(of_row) \
            / F.greatest(F.max("size").over(of_row), F.lit(1))
        # Rank: the company first; below that a hash, so that equal rows rank alike in all columns.
        rank = F.floor(company * 4096).cast("long") * (1 << 20) + F.pmod(F.xxhash64("row"), F.lit(1 << 20))
        entries = materialise(columns.select(
            "column", "row", "size", "part", "times", rank.alias("rank")), "columns")
        found = entries.filter("part < 0").select(F.col("row").alias("a"), F.col("column").alias("b"))
        entries = entries.filter("part >= 0")
        compared = materialise(_paired(docs, materialise(_hub_pairs(entries), "pairs"))
                               .mapInArrow(_differences, COMPARED), "compared")
        found = found.unionAll(compared.filter("9 * shared >= 4 * (hub_size + size)").select("a", "b"))
        labels = components(found)
        mates = _hub_mates(compared, labels)
        others = _other_pairs(_open_columns(entries, labels, compared))
        # What is left links components, so the second search goes over these and not over rows.
        merged = components(_linked(docs, materialise(mates.unionAll(others), "pairs")))
        known = rows.join(_grown(labels), F.col("row") == F.col("node"), "left").select(
            "row", "doc_id", "n_shingles", "component", F.coalesce("component", "row").alias("_label"))
        further = merged.select(F.col("node").alias("_n"), F.col("component").alias("_further"))
        member = materialise(known.join(_grown(further), F.col("_label") == F.col("_n"), "left").select(
            "row", "doc_id", "n_shingles", F.coalesce("_further", "component").alias("_component")),
            "members")
    linked, alone = (member.filter(F.col("_component").isNotNull()),
                     member.filter(F.col("_component").isNull()))
    # Ids may repeat: of the rows with the smallest one the first stays.
    heads = linked.groupBy("_component").agg(F.min(F.struct("doc_id", "row")).alias("_head"))
    named = linked.join(_grown(heads), "_component").select(
        "row", "doc_id", "n_shingles", F.col("_head.doc_id").alias("component_id"),
        (F.col("row") == F.col("_head.row")).alias("kept"))
    return named.unionAll(alone.select("row", "doc_id", "n_shingles",
                                       F.col("doc_id").alias("component_id"),
                                       F.lit(True).alias("kept")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs without the others of their component, in the columns of docs."""
    docs = stored(docs)
    gone = materialise(similar_documents(docs).filter(~F.col("kept")).select(
        F.col("row").alias("_gone")), "copies")
    rows = numbered(docs, wrapped(docs))
    return rows.join(gone, F.col("_row") == F.col("_gone"), "left_anti").select("doc.*")

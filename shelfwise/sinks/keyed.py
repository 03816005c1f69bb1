"""A table with one row per key that takes batches of changed rows.

Rows lie in hash buckets of their key. A batch is written as a delta, in the buckets it touches;
readers merge bases and deltas. A bucket whose deltas pass a share of its base is compacted: its
merged rows become its new base. So a batch writes about its own size, each row is rewritten a
bounded number of times (about 1 / `compact_at`, whatever the number of batches), and a read
merges at most that share. Rows of a key replace each other, or their columns add up.

    <dst>/delta/_seq=<batch>/_bucket=<k>/   rows of a batch
    <dst>/base/_seq=<batch>/_bucket=<k>/    compacted buckets
    <dst>/manifest/_seq=<batch>/            one row: which of these make up the table

The manifest is one file that appears as a whole, so readers see the batch or do not, and a batch
that is run again after a failure replaces its own folders. Buckets without live deltas are read
without a shuffle. The driver holds the manifest, a line per bucket.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.clean import quoted as q
from shelfwise.sinks import files

BUCKETS = 32
#: A bucket is compacted once its deltas hold this share of its base's rows.
COMPACT_AT = 0.5
SEQ, BUCKET = "_seq", "_bucket"
MANIFEST = ("seq long, keys array<string>, ordered_by array<string>, summed array<string>, kind string, "
            "parts array<struct<bucket: int, base: long, base_rows: long, delta_rows: long>>, "
            "deltas array<struct<seq: long, buckets: array<int>>>")


@dataclass
class Manifest:
    """What makes up the table after a batch. `base` is None for a bucket without one."""

    seq: int
    keys: list[str]
    order: list[str]
    summed: list[str]
    kind: str
    parts: dict[int, tuple[int | None, int, int]]
    deltas: dict[int, list[int]]

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.kind)


def _manifests(spark: SparkSession, dst: str) -> list[int]:
    names = files.children(spark, f"{dst}/manifest")
    found = [int(n.split("=")[1]) for n in names if n.startswith(f"{SEQ}=")]
    # A folder without its file is a commit that never was.
    return sorted(s for s in found if files.written(spark, f"{dst}/manifest/{SEQ}={s}"))


def _load(spark: SparkSession, dst: str, seq: int) -> Manifest:
    row = spark.read.schema(MANIFEST).parquet(f"{dst}/manifest/{SEQ}={seq}").first()
    return Manifest(row.seq, row["keys"], row.ordered_by, row.summed, row.kind,
                    {p.bucket: (p.base, p.base_rows, p.delta_rows) for p in row.parts},
                    {d.seq: d.buckets for d in row.deltas})


def manifest(spark: SparkSession, dst: str) -> Manifest | None:
    """That of the last committed batch."""
    found = _manifests(spark, dst)
    return _load(spark, dst, found[-1]) if found else None


def _save(spark: SparkSession, dst: str, m: Manifest) -> None:
    parts = [dict(bucket=k, base=base, base_rows=n, delta_rows=more)
             for k, (base, n, more) in sorted(m.parts.items())]
    deltas = [dict(seq=seq, buckets=ks) for seq, ks in sorted(m.deltas.items())]
    files.write_row(spark, f"{dst}/manifest/{SEQ}={m.seq}", dict(
        seq=m.seq, keys=m.keys, ordered_by=m.order, summed=m.summed, kind=m.kind, parts=parts,
        deltas=deltas), MANIFEST)


def _bucketed(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*[q(k) for k in keys]), F.lit(buckets)).cast("int"))


def _write(rows: DataFrame, path: str) -> dict[int, int]:
    """Rows with their bucket as files by bucket; the rows of each."""
    rows.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(path)
    if not any(n.startswith(f"{BUCKET}=") for n in files.children(rows.sparkSession, path)):
        return {}
    kinds = T.StructType([*[f for f in rows.schema.fields if f.name != BUCKET],
                          T.StructField(BUCKET, T.IntegerType())])
    counts = rows.sparkSession.read.schema(kinds).parquet(path).groupBy(BUCKET).count().collect()
    return {r[0]: r[1] for r in counts}


def _read(spark: SparkSession, root: str, schema: T.StructType, which: dict[int, list[int]]
          ) -> DataFrame:
    """The named buckets of some batches' folders, with both folder columns."""
    kinds = T.StructType([*schema.fields, T.StructField(SEQ, T.LongType()),
                          T.StructField(BUCKET, T.IntegerType())])
    which = {seq: ks for seq, ks in which.items() if ks}
    if not which:
        return spark.createDataFrame([], kinds)
    wanted = reduce(Column.__or__, [(F.col(SEQ) == seq) & F.col(BUCKET).isin(*ks)
                                    for seq, ks in which.items()])
    return (spark.read.schema(kinds).option("basePath", root)
            .parquet(*[f"{root}/{SEQ}={seq}" for seq in which]).where(wanted))


def _live(spark: SparkSession, dst: str, m: Manifest, only: set[int] | None = None
          ) -> tuple[DataFrame, DataFrame]:
    """(base rows, delta rows) of all or some buckets."""
    bases: dict[int, list[int]] = {}
    for k, (base, _, _) in m.parts.items():
        if base is not None and (only is None or k in only):
            bases.setdefault(base, []).append(k)
    deltas = {seq: [k for k in ks if only is None or k in only] for seq, ks in m.deltas.items()}
    return (_read(spark, f"{dst}/base", m.schema, bases),
            _read(spark, f"{dst}/delta", m.schema, deltas))


def _merged(rows: DataFrame, m: Manifest) -> DataFrame:
    """Of the rows of a key the sum, the one that is largest by `order`, or else the latest."""
    if m.summed:
        kinds = {f.name: f.dataType for f in m.schema.fields}
        return rows.groupBy(BUCKET, *[q(k) for k in m.keys]).agg(
            *[F.sum(q(c)).cast(kinds[c]).alias(c) for c in m.summed]).select(
            *[q(c) for c in m.schema.names], F.col(BUCKET))
    values = [c for c in m.schema.names if c not in m.keys]
    rank = F.struct(*[q(c) for c in m.order], F.col(SEQ))
    best = rows.groupBy(BUCKET, *[q(k) for k in m.keys]).agg(
        F.max_by(F.struct(F.col(SEQ), *[q(v) for v in values]), rank).alias("_best"))
    fields = [F.col("_best").getField(v).alias(v) if v in values else q(v)
              for v in m.schema.names]
    return best.select(*fields, F.col(BUCKET))


def upsert(spark: SparkSession, dst: str, rows: DataFrame, keys: Sequence[str], seq: int,
           order: Sequence[str] = (), summed: Sequence[str] = (), buckets: int = BUCKETS,
           compact_at: float = COMPACT_AT) -> Manifest:
    """Take batch number `seq`; a number that is not above the last one is passed over.

    A row replaces the one with its key, or, with `order`, does so if it is not smaller by these
    columns; with `summed`, all columns that are no keys, it is added to it. The number of
    buckets is that of the first batch. Within a batch each key may occur once only, unless
    `order` or `summed` say what becomes of its rows.
    """
    if summed and sorted([*keys, *summed]) != sorted(rows.columns):
        raise ValueError("each column must be a key or summed")
    before = manifest(spark, dst)
    if before is not None and before.seq >= seq:
        return before
    if before is not None:
        buckets = len(before.parts)
    names = rows.columns
    kind = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}"
                     for f in rows.schema.fields)
    if before is not None and (before.keys, before.order, before.summed, before.kind) != (
            list(keys), list(order), list(summed), kind):
        raise ValueError(f"{dst} holds {before.kind} by {before.keys}, not {kind} by {list(keys)}")
    now = Manifest(seq, list(keys), list(order), list(summed), kind,
                   dict(before.parts) if before else {k: (None, 0, 0) for k in range(buckets)},
                   dict(before.deltas) if before else {})
    placed = _bucketed(rows, keys, buckets)
    if order or summed:
        placed = _merged(placed.withColumn(SEQ, F.lit(seq)), now)
    counts = _write(placed.select(*[q(c) for c in names], BUCKET), f"{dst}/delta/{SEQ}={seq}")
    if counts:
        now.deltas[seq] = sorted(counts)
    for k, n in counts.items():
        base, base_rows, delta_rows = now.parts[k]
        now.parts[k] = (base, base_rows, delta_rows + n)
    full = {k for k, (_, base_rows, delta_rows) in now.parts.items()
            if delta_rows > compact_at * base_rows}
    if full:
        base, delta = _live(spark, dst, now, full)
        after = _write(_merged(base.unionByName(delta), now), f"{dst}/base/{SEQ}={seq}")
        for k in full:
            now.parts[k] = (seq, after.get(k, 0), 0)
        now.deltas = {s: left for s, ks in now.deltas.items()
                      if (left := [k for k in ks if k not in full])}
    _save(spark, dst, now)
    return now


def read(spark: SparkSession, dst: str) -> DataFrame:
    """The table as of the last committed batch; buckets without deltas are plain scans."""
    m = manifest(spark, dst)
    if m is None:
        raise ValueError(f"{dst}: nothing published yet")
    open_ = {k for ks in m.deltas.values() for k in ks}
    settled, _ = _live(spark, dst, m, set(m.parts) - open_)
    base, delta = _live(spark, dst, m, open_)
    columns = [q(c) for c in m.schema.names]
    return settled.select(*columns).unionByName(
        _merged(base.unionByName(delta), m).select(*columns))


def vacuum(spark: SparkSession, dst: str, keep: int = 2, min_age: float = 3600) -> list[str]:
    """Remove folders that none of the last `keep` manifests names; returns what went.

    A reader may hold on to a manifest for `min_age` seconds after a later one was committed: a
    manifest stays as long as the one after it is younger, and what it names stays with it.
    Folders above the last committed batch belong to a running one and stay.
    """
    found = _manifests(spark, dst)
    if not found:
        return []
    limit = time.time() - min_age
    stay = set(found[-keep:])
    for seq, later in zip(found, found[1:], strict=False):
        if files.modified(spark, f"{dst}/manifest/{SEQ}={later}") > limit:
            stay.add(seq)
    named = {"base": set(), "delta": set(), "manifest": stay}
    for seq in stay:
        m = _load(spark, dst, seq)
        named["base"] |= {base for base, _, _ in m.parts.values() if base is not None}
        named["delta"] |= set(m.deltas)
    gone = []
    for folder in ("manifest", "base", "delta"):  # first what names the others
        for name in files.children(spark, f"{dst}/{folder}"):
            seq = int(name.split("=")[1]) if name.startswith(f"{SEQ}=") else None
            if seq is not None and seq <= found[-1] and seq not in named[folder]:
                files.remove(spark, f"{dst}/{folder}/{name}")
                gone.append(f"{folder}/{name}")
    return gone

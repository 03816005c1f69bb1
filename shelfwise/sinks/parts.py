"""K2, incremental: published tables of which a refresh writes the changed parts only.

A table is cut into parts, by month or by a hash of its key. A part's mark (rows and two sums of
row hashes) tells whether its contents differ from what is published, in whatever order they come.
Parts that do are written into a folder of this version; the manifest names, for every part of
every table, the version that holds it. It is one file that appears as a whole, so all tables
switch at once, and a failed run leaves folders that nothing names.

    <dst>/parts/<table>/_version=<v>/<part column>=<part>/
    <dst>/manifests/<v>/

The driver holds a line per part. What was written is read back and must have the marks that the
staged rows had.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.clean import quoted as q
from shelfwise.functions.contents import content
from shelfwise.functions.dates import MONTH
from shelfwise.sinks import files, lake

VERSION = "_version"
BUCKET = "_bucket"
UNDATED = "none"
MANIFEST = ("version string, notes map<string,string>, tables array<struct<name: string, "
            "kind: string, cut: string, parts: array<struct<part: string, version: string, "
            "rows: long, mark: string>>>>")


@dataclass
class Table:
    """A published table: columns, the folder column it is cut by, and where its parts are."""

    kind: str
    cut: str
    parts: dict[str, tuple[str, int, str]] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(n for _, n, _ in self.parts.values())


@dataclass
class Manifest:
    version: str
    tables: dict[str, Table]
    notes: dict[str, str]


def by_month(name: str) -> tuple[str, Column]:
    """Cut by the month of a date; rows without one have a part of their own."""
    return MONTH, F.coalesce(F.date_format(q(name), "yyyy-MM"), F.lit(UNDATED))


def by_key(keys: list[str], buckets: int) -> tuple[str, Column]:
    """Cut by a hash of some columns."""
    bucket = F.pmod(F.xxhash64(*[q(k) for k in keys]), F.lit(buckets)).cast("string")
    return BUCKET, F.lpad(bucket, 6, "0")


def _versions(spark: SparkSession, dst: str) -> list[str]:
    """Committed versions, oldest first."""
    return [v for v in files.children(spark, f"{dst}/manifests")
            if files.written(spark, f"{dst}/manifests/{v}")]


def _load(spark: SparkSession, dst: str, version: str) -> Manifest:
    row = spark.read.schema(MANIFEST).parquet(f"{dst}/manifests/{version}").first()
    return Manifest(version, {t.name: Table(t.kind, t.cut, {
        p.part: (p.version, p.rows, p.mark) for p in t.parts}) for t in row.tables}, row.notes)


def manifest(spark: SparkSession, dst: str, version: str | None = None) -> Manifest | None:
    """That of a version, or of the last one committed."""
    found = _versions(spark, dst)
    if version is None:
        return _load(spark, dst, found[-1]) if found else None
    return _load(spark, dst, version) if version in found else None


def commit(spark: SparkSession, dst: str, m: Manifest) -> None:
    tables = [dict(name=name, kind=t.kind, cut=t.cut, parts=[
        dict(part=p, version=v, rows=n, mark=mark) for p, (v, n, mark) in sorted(t.parts.items())])
        for name, t in m.tables.items()]
    files.write_row(spark, f"{dst}/manifests/{m.version}",
                    dict(version=m.version, notes=m.notes, tables=tables), MANIFEST)


def read(spark: SparkSession, dst: str, name: str, m: Manifest | None = None,
         folders: bool = False) -> DataFrame:
    """A published table; with `folders` its folder column comes along, for pruning."""
    m = m or manifest(spark, dst)
    if m is None:
        raise ValueError(f"{dst}: nothing published yet")
    table = m.tables[name]
    kinds = T.StructType([*T.StructType.fromDDL(table.kind).fields,
                          T.StructField(VERSION, T.StringType()),
                          T.StructField(table.cut, T.StringType())])
    held: dict[str, list[str]] = {}
    for part, (version, _, _) in table.parts.items():
        held.setdefault(version, []).append(part)
    if not held:
        df = spark.createDataFrame([], kinds)
    else:
        root = f"{dst}/parts/{name}"
        wanted = reduce(Column.__or__, [(F.col(VERSION) == v) & F.col(table.cut).isin(*ps)
                                        for v, ps in held.items()])
        df = spark.read.schema(kinds).option("basePath", root) \
            .parquet(*[f"{root}/{VERSION}={v}" for v in held]).where(wanted)
    return df.drop(VERSION) if folders else df.drop(VERSION, table.cut)


def _marks(df: DataFrame, cut: str) -> dict[str, tuple[int, str]]:
    return {r[0]: (r.rows, r.mark) for r in content(df, cut).collect()}


def write_changed(spark: SparkSession, dst: str, version: str, name: str, df: DataFrame,
                  cut: tuple[str, Column], before: Table | None) -> Table:
    """Write the parts of `df` that `before` has not; what the table then consists of."""
    column, part = cut
    kind = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}"
                     for f in df.schema.fields)
    placed = df.withColumn(column, part)
    now = Table(kind, column)
    same = before is not None and (before.kind, before.cut) == (kind, column)
    marks = _marks(placed, column)
    for p, (rows, mark) in marks.items():
        old = before.parts.get(p) if same else None
        now.parts[p] = old if old and old[1:] == (rows, mark) else (version, rows, mark)
    changed = sorted(p for p, x in now.parts.items() if x[0] == version)
    if changed:
        path = f"{dst}/parts/{name}/{VERSION}={version}"
        rows = placed if len(changed) == len(marks) else placed.where(F.col(column).isin(*changed))
        rows.hint("rebalance", F.col(column)).write.mode("overwrite").partitionBy(column).parquet(path)
        only = Table(kind, column, {p: now.parts[p] for p in changed})
        written = _marks(read(spark, dst, name, Manifest(version, {name: only}, {}), True), column)
        wrong = [p for p in changed if written.get(p) != marks[p]]
        if wrong:
            raise ValueError(f"{name}: written parts {wrong} do not hold the staged rows")
    return now


def whole() -> tuple[str, Column]:
    """One part: for reports and other small tables."""
    return BUCKET, F.lit("0" * 6)


Cut = tuple[str, Column]
Derived = Callable[[dict[str, DataFrame]], dict[str, tuple[DataFrame, Cut]]]


def publish(spark: SparkSession, dst: str, tables: dict[str, tuple[DataFrame, Cut]],
            derived: Sequence[Derived] = (), notes: dict[str, str] | None = None) -> Manifest:
    """A refresh: {name: (rows, cut)}, then what each of `derived` makes of all written so far.

    A step of `derived` gets the written tables with their folder columns and returns more of the
    kind of `tables`. If neither these nor the notes differ from the last version, no step is
    taken and the derived tables stay as they are.
    """
    before = manifest(spark, dst)
    old = before.tables if before else {}
    m = Manifest(lake.new_version(), {}, notes or {})
    for name, (df, cut) in tables.items():
        m.tables[name] = write_changed(spark, dst, m.version, name, df, cut, old.get(name))
    rest = {n: t for n, t in old.items() if n not in tables}
    if derived and rest and before.notes == m.notes and all(
            m.tables[n] == old.get(n) for n in tables):
        m.tables |= rest
        derived = ()
    for step in derived:
        made = step({n: read(spark, dst, n, m, True) for n in m.tables})
        for name, (df, cut) in made.items():
            m.tables[name] = write_changed(spark, dst, m.version, name, df, cut, old.get(name))
    commit(spark, dst, m)
    return m


def vacuum(spark: SparkSession, dst: str, keep: int = 2, min_age: float = 3600) -> list[str]:
    """Remove parts that none of the last `keep` versions names; returns what went.

    A version also stays as long as the one after it is younger than `min_age` seconds, so a
    reader that took it before that has its files. Folders of versions above the last commit
    belong to a running refresh and stay.
    """
    found = _versions(spark, dst)
    if not found:
        return []
    limit, stay = time.time() - min_age, set(found[-keep:])
    for version, later in zip(found, found[1:], strict=False):
        if files.modified(spark, f"{dst}/manifests/{later}") > limit:
            stay.add(version)
    named = {(name, held, t.cut, p) for v in stay
             for name, t in _load(spark, dst, v).tables.items()
             for p, (held, _, _) in t.parts.items()}
    gone = [f"manifests/{v}" for v in found if v not in stay]
    for name in files.children(spark, f"{dst}/parts"):
        for folder in files.children(spark, f"{dst}/parts/{name}"):
            version = folder.partition("=")[2]
            if version > found[-1]:
                continue
            if not any(n == name and v == version for n, v, _, _ in named):
                gone.append(f"parts/{name}/{folder}")
                continue
            for part in files.children(spark, f"{dst}/parts/{name}/{folder}"):
                cut, _, p = part.partition("=")
                if p and (name, version, cut, p) not in named:
                    gone.append(f"parts/{name}/{folder}/{part}")
    for path in gone:  # manifests first
        files.remove(spark, f"{dst}/{path}")
    return gone

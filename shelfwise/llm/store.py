"""Shared scratch tables, and prefix sums that no single task has to hold.

Operators cut their lineage with tables below spark.checkpoint.dir, so a lost executor costs a
few tasks and never a model or a whole plan.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from shelfwise.session import shared_dir

#: Separators of the words in all contracts: space, tab, line feed, \x0b, \x0c, carriage return.
SEPARATORS = " \t\n\x0b\x0c\r"
SEPARATOR_PATTERN = "[\\x20\\x09-\\x0D]+"
#: log2 of the rows that a file may have.
FILE_BITS = 33
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Enough where all machines have it at one path; elsewhere submit it with --py-files.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    path = environment.get("PYTHONPATH", "")
    if root not in path.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(p for p in (root, path) if p)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _freed_shuffles(spark: SparkSession):
    """Shuffle files go as soon as the table is written, not when the driver collects garbage."""
    return _setting(spark, CLEANUP, "true")


def short_batches(spark: SparkSession, size: int = 4 << 20):
    """What runs in here sends texts to Python in batches of about so many bytes (one row at
    least). Spark's 64 MB lie in several copies in the executor and in its worker, for each task."""
    return _setting(spark, BATCH_BYTES, str(size))


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write df as Parquet into the shared scratch folder and read it back."""
    spark = df.sparkSession
    path = shared_dir(spark, f"llm-{purpose}")
    with _freed_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column | str) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ of a text as an array; null text has none."""
    col = F.col(text) if isinstance(text, str) else text
    parts = F.array_remove(F.split(F.coalesce(col, F.lit("")), SEPARATOR_PATTERN), "")
    return parts


def n_words(text: Column | str) -> Column:
    return F.size(words(text)).cast("long")


def wrapped(docs: DataFrame) -> Column:
    """A whole row as one struct, so that no name of its columns can clash with another."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")


def _place(df: DataFrame) -> list[Column]:
    meta = df.metadataColumn("_metadata")
    return [meta["file_path"].alias("_file"), meta["row_index"].alias("_index")]


def stored(df: DataFrame) -> DataFrame:
    """df, if each of its rows has a place of its own in a Parquet file, else a copy where it has."""
    try:
        places = df.select(*_place(df))
    except AnalysisException:
        return materialise(df, "rows")
    # A join or an explode above the scan may repeat a place.
    often = places.groupBy(F.xxhash64("_file"), "_index").count().filter("count > 1")
    return df if often.isEmpty() else materialise(df, "rows")


def numbered(df: DataFrame, *columns: Column | str) -> DataFrame:
    """The columns with _row, a number that the file and the place in it fix; of a `stored` df.

    However later scans are cut into partitions, a row has the same number in all of them. Rows
    stay in the order of the scan: the files' numbers, a line per file, are broadcast.
    """
    placed = df.select(*columns, *_place(df))
    names = sorted(r[0] for r in placed.select("_file").distinct().collect())
    files = materialise(from_rows(df.sparkSession, list(enumerate(names)),
                                  "_number long, _path string"), "files")
    lost = F.raise_error(F.concat(F.lit("no number for "), F.col("_file"))).cast("bigint")
    number = F.coalesce(F.shiftleft("_number", FILE_BITS) + F.col("_index"), lost)
    return placed.join(F.broadcast(files), F.col("_file") == F.col("_path"), "left").select(
        *[F.col(f"`{c}`") for c in placed.columns[:-2]], number.alias("_row"))


def needs(df: DataFrame, *columns: str) -> DataFrame:
    """Just the named columns, by exact name; a missing one is an error that says so."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are missing; there are {df.columns}")
    return df.select(*[F.col(f"`{c}`") for c in columns])


def hash60(*texts: Column) -> Column:
    """The first 60 bits of the md5 of some texts joined by ':'; null counts as empty."""
    joined = F.concat_ws(":", *[F.coalesce(t, F.lit("")) for t in texts])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("long")


def running_sum(df: DataFrame, groups: Sequence[str], key: str, value: str, ties: Sequence[str],
                count: str, out: str) -> DataFrame:
    """Add `out`: the sum of `value` over the rows that precede a row in its group, by `key`.

    key: a uniform hash of 60 bits (see hash60). count: a column with the number of rows of the group. The key
    space of a group is cut into c * c ranges, c being the cube root of its rows: each row is
    summed inside its range, ranges inside their stretch of c ranges, stretches inside the group.
    So a window sees about c rows, whichever share of all rows one group holds. The order is by
    key, then by `ties`; rows alike in all of these are interchangeable.
    """
    fan = F.greatest(F.lit(1.0), F.ceil(F.pow(F.col(count).cast("double"), F.lit(1 / 3))))
    unit = F.shiftright(F.col(key), 7).cast("double") / float(1 << 53)
    ranged = df.withColumn("_range", F.floor(unit * fan * fan).cast("long")) \
        .withColumn("_stretch", F.floor(F.col("_range") / fan).cast("long"))
    names = [f"`{g}`" for g in groups]

    def before(*part, by):
        return W.partitionBy(*names, *part).orderBy(*by).rowsBetween(W.unboundedPreceding, -1)

    zero = F.lit(0).cast("long")
    per_range = ranged.groupBy(*names, "_stretch", "_range").agg(F.sum(value).alias("_sum"))
    in_stretch = per_range.withColumn(
        "_range_before", F.coalesce(F.sum("_sum").over(before("_stretch", by=["_range"])), zero))
    per_stretch = per_range.groupBy(*names, "_stretch").agg(F.sum("_sum").alias("_all"))
    in_group = per_stretch.withColumn(
        "_stretch_before", F.coalesce(F.sum("_all").over(before(by=["_stretch"])), zero))
    offsets = in_stretch.alias("r").join(
        in_group.alias("s"), [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}"))
                              for c in [*names, "_stretch"]]) \
        .select(*[F.col(f"r.{g}") for g in names], "r._range",
                (F.col("_range_before") + F.col("_stretch_before")).alias("_before"))
    inside = ranged.withColumn("_inside", F.coalesce(
        F.sum(value).over(before("_range", by=[key, *[f"`{t}`" for t in ties]])), zero))
    joined = inside.alias("i").join(
        offsets.alias("o"), [F.col(f"i.{c}").eqNullSafe(F.col(f"o.{c}"))
                             for c in [*names, "_range"]], "left")
    return joined.select(*[F.col(f"i.`{c}`") for c in df.columns],
                         (F.col("_inside") + F.col("_before")).alias(out))


def from_rows(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """A DataFrame of a bounded number of driver rows."""
    return spark.createDataFrame(rows, schema)

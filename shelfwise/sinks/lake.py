"""K1-K3 for files: full refresh into versioned folders, switched as a whole."""

from __future__ import annotations

import datetime
import re
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.clean import quoted as q
from shelfwise.functions.dates import MONTH
from shelfwise.sinks import files

COMMITS = "commits"
COMMIT_SCHEMA = "version string, committed_at timestamp"
#: As `new_version` makes them; other folders below a destination are not this module's.
VERSION_NAME = re.compile(r"v\d{8}T\d{12}-[0-9a-f]{8}")

# How each table is laid out: facts by month of their date, stock tables by brand.
BY_MONTH = {"stg_sales": "Date", "stg_stock_movement": "Date"}
BY_KEYS = {"stg_stock_balance": ["Brand", "Product No.", "Warehouse"],
           "stg_stock_aging": ["Brand", "Product No.", "Warehouse"]}
#: Comes out of a join whose tasks are even already: sorted there, not gathered by brand.
IN_PLACE = {"stg_stock_aging"}
#: Smaller files. Not for the log: by its size Spark decides whether to broadcast last movements.
CODEC = dict.fromkeys(("stg_sales", "stg_stock_balance", "stg_stock_aging"), "zstd")

#: A task fills a dictionary per open file and column; left to grow to the usual 1 MB, those of all
#: months are far more than a core's cache. Columns of few values keep theirs, others end it here.
OPEN_FILES = {"parquet.dictionary.page.size": str(16 << 10),
              "parquet.compression.codec.zstd.level": "1"}
#: Months that a task writes side by side; rows of further ones are sorted by month first.
OPEN_MONTHS = 200
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_months_lock = threading.Lock()
_months_before: list[str] = []  # the setting to return to, once for every write under way


@contextmanager
def _months_open(spark: SparkSession) -> Iterator[None]:
    """Tasks keep the files of their months open instead of sorting their rows by month.

    Writes run side by side in one session: the last one to end restores the setting.
    """
    with _months_lock:
        before = _months_before[0] if _months_before else spark.conf.get(WRITERS, "0")
        _months_before.append(before)
        if int(before) <= 0:
            spark.conf.set(WRITERS, str(OPEN_MONTHS))
    try:
        yield
    finally:
        with _months_lock:
            before = _months_before.pop()
            if not _months_before:
                spark.conf.set(WRITERS, before)


def layout(name: str) -> dict:
    """How `write_table` lays out a table of this name."""
    return {"month_of": BY_MONTH.get(name), "cluster_by": BY_KEYS.get(name),
            "in_place": name in IN_PLACE, "codec": CODEC.get(name)}


def write_table(df: DataFrame, path: str, month_of: str | None = None,
                cluster_by: list[str] | None = None, in_place: bool = False,
                codec: str | None = None) -> None:
    """K1: replace the folder at `path`, by month or clustered on keys of falling importance.

    Months are written by the tasks that have the rows, a file per task and month: nothing is
    shuffled or sorted, and a hot month is spread over as many files as any other. Clustered rows
    are rebalanced on the first key, not hash-partitioned: AQE spreads a hot brand over several
    files, merges small ones, and the plan runs once (a range partitioning would run it a second
    time to sample the keys). With `in_place` they stay in their tasks: every file is sorted.
    """
    if month_of is not None:
        month = F.date_format(q(month_of), "yyyy-MM").alias(MONTH)
        with _months_open(df.sparkSession):
            df.select("*", month).write.mode("overwrite").options(**OPEN_FILES).partitionBy(
                MONTH).parquet(path, compression=codec)
        return
    if cluster_by is not None:
        keys = [q(c) for c in cluster_by]
        placed = df if in_place else df.hint("rebalance", keys[0])
        df = placed.sortWithinPartitions(*keys)
    df.write.mode("overwrite").parquet(path, compression=codec)


def side_by_side(spark: SparkSession, jobs: list[Callable[[], None]], at_once: int = 4) -> None:
    """Run independent writes at the same time, so that one's last tasks leave no cores idle."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        for job in running:
            job.result()


def read_table(spark: SparkSession, path: str, months: bool = False) -> DataFrame:
    """A written table; with `months` its folder column comes along, for `functions.dates.in_days` to prune by."""
    df = spark.read.parquet(path)
    return df.drop(MONTH) if MONTH in df.columns and not months else df


def save_table(df: DataFrame, name: str) -> None:
    """K1 into the session's catalog: replace the table `name`."""
    df.write.mode("overwrite").saveAsTable(name)


def csv_snapshot(df: DataFrame, path: str) -> None:
    """K3: a folder of CSV parts with a header each."""
    df.write.option("header", True).mode("overwrite").csv(path)


def new_version() -> str:
    now = datetime.datetime.now(datetime.timezone.utc)
    return f"v{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def version_path(dst: str, version: str, name: str) -> str:
    return f"{dst}/{version}/{name}"


def commit(spark: SparkSession, dst: str, version: str) -> None:
    """Make a fully written version the current one by appending a single file."""
    row = spark.range(1).select(F.lit(version).alias("version"),
                                F.current_timestamp().alias("committed_at"))
    row.coalesce(1).write.mode("append").parquet(f"{dst}/{COMMITS}")


def is_published(spark: SparkSession, dst: str) -> bool:
    """Whether anything was committed yet."""
    try:
        spark.read.schema(COMMIT_SCHEMA).parquet(f"{dst}/{COMMITS}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def current_version(spark: SparkSession, dst: str) -> str | None:
    log = spark.read.schema(COMMIT_SCHEMA).parquet(f"{dst}/{COMMITS}")
    return log.agg(F.max(F.struct("committed_at", "version")).alias("m")).select(
        "m.version").first()[0]


def current(spark: SparkSession, dst: str, name: str) -> DataFrame:
    """A table of the last committed version."""
    version = current_version(spark, dst)
    if version is None:
        raise ValueError(f"{dst}: nothing published yet")
    return read_table(spark, version_path(dst, version, name))


def retain(spark: SparkSession, dst: str, keep: int = 3, min_age: float = 3600) -> list[str]:
    """Remove versions that are neither among the last `keep` committed ones nor in use; returns those.

    A version that was the current one within the last `min_age` seconds stays, as readers may be
    at it. So does a folder that no commit names while it is younger, as its run may go on; when
    it is older, that run has failed.
    """
    if not is_published(spark, dst):
        return []
    log = spark.read.schema(COMMIT_SCHEMA).parquet(f"{dst}/{COMMITS}")
    commits = [(r.version, r.at) for r in log.select(
        "version", F.col("committed_at").cast("double").alias("at")).orderBy(
        "committed_at", "version").collect()]
    limit = time.time() - min_age
    stay = {version for version, _ in commits[-keep:]}
    stay |= {version for (version, _), (_, until) in zip(commits, commits[1:], strict=False)
             if until > limit}
    known = {version for version, _ in commits}
    gone = []
    for name in files.children(spark, dst):
        path = f"{dst}/{name}"
        if name in stay or not VERSION_NAME.fullmatch(name):
            continue
        if name in known or files.modified(spark, path) <= limit:
            files.remove(spark, path)
            gone.append(name)
    return gone


def publish(spark: SparkSession, tables: dict[str, DataFrame], dst: str,
            check: Callable[[dict[str, DataFrame]], None] | None = None,
            snapshots: bool = False, version: str | None = None) -> str:
    """K2: write all tables to a new version, check what was written, then switch.

    Readers see the old version until the commit, and keep it if anything fails.
    """
    version = version or new_version()

    def save(name: str, df: DataFrame) -> None:
        path = version_path(dst, version, name)
        write_table(df, path, **layout(name))
        if snapshots:
            csv_snapshot(read_table(spark, path), version_path(dst, version, f"{name}_csv"))

    side_by_side(spark, [partial(save, name, df) for name, df in tables.items()])
    if check is not None:
        check({name: read_table(spark, version_path(dst, version, name)) for name in tables})
    commit(spark, dst, version)
    return version

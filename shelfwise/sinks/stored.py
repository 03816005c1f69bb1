"""Tables stored side by side in hash buckets of a key, so that joins on it move no rows.

`write` splits the rows of some tables into those of common keys, in bucketed tables with equal
numbers of buckets, and those of hot keys, which any of the tables has more often than an average
bucket has rows: these are kept as plain files. As the two parts share no key, whatever works key
by key (joins, groups, key checks) may be run on either and put together (`Stored.apply`): on the
common keys it reads bucket by bucket without an exchange, and on the hot ones Spark shuffles as
usual, combines ahead of the shuffle and splits skewed partitions.

The hot keys of a table are fewer than its buckets, which is why broadcasting them is safe.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.clean import quoted as q

#: Buckets are made for about as many rows of the largest table.
ROWS_PER_BUCKET = 4_000_000
LAYOUT = "name string, kind string, keys array<string>, buckets int"


@dataclass
class Stored:
    """The rows of common keys and those of hot ones, by table."""

    common: dict[str, DataFrame]
    hot: dict[str, DataFrame]

    def apply(self, work: Callable[[dict[str, DataFrame], bool], DataFrame]) -> DataFrame:
        """`work(tables, bucketed)` over both parts; for work that never looks beyond one key."""
        return work(self.common, True).unionByName(work(self.hot, False))


def _ticked(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _catalog_name(path: str) -> str:
    return "stored_" + hashlib.md5(path.encode()).hexdigest()


def _hot_keys(tables: dict[str, DataFrame], keys: list[str], buckets: int) -> DataFrame:
    """Keys with more rows in a table than its average bucket: fewer than buckets * tables."""
    found = []
    for df in tables.values():
        rows = df.count()
        found.append(df.groupBy(*[q(k) for k in keys]).count()
                     .where(F.col("count") > max(1, rows // buckets)).select(*[q(k) for k in keys]))
    return reduce(DataFrame.unionByName, found).distinct()


def write(spark: SparkSession, dst: str, tables: dict[str, DataFrame], keys: Sequence[str],
          buckets: int | None = None) -> None:
    """Store written tables (each is read several times) by `keys`, columns they all have."""
    keys = list(keys)
    if buckets is None:
        most = max(df.count() for df in tables.values())
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                      math.ceil(most / ROWS_PER_BUCKET))
    _hot_keys(tables, keys, buckets).write.mode("overwrite").parquet(f"{dst}/hot_keys")
    hot = spark.read.parquet(f"{dst}/hot_keys")
    for name, df in tables.items():
        same = reduce(lambda a, b: a & b, [F.col(f"d.{_ticked(k)}").eqNullSafe(
            F.col(f"h.{_ticked(k)}")) for k in keys])
        few = F.broadcast(hot.alias("h"))
        path = f"{dst}/{name}/common"
        table = _catalog_name(path)
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        # Partitioned as the buckets are, so that each bucket is one file.
        (df.alias("d").join(few, same, "left_anti").repartition(buckets, *[q(k) for k in keys])
         .write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
         .option("path", path).saveAsTable(table))
        (df.alias("d").join(few, same, "left_semi").hint("rebalance")
         .write.mode("overwrite").parquet(f"{dst}/{name}/hot"))
    rows = [(name, ", ".join(f"{_ticked(f.name)} {f.dataType.simpleString()}"
                             for f in df.schema.fields), keys, buckets)
            for name, df in tables.items()]
    spark.createDataFrame(rows, LAYOUT).coalesce(1).write.mode("overwrite").parquet(f"{dst}/layout")


def read(spark: SparkSession, dst: str) -> Stored:
    """The stored tables; registers the buckets of those that this session's catalog lacks."""
    stored = Stored({}, {})
    for name, kind, keys, buckets in spark.read.schema(LAYOUT).parquet(f"{dst}/layout").collect():
        path = f"{dst}/{name}/common"
        table = _catalog_name(path)
        if not spark.catalog.tableExists(table):
            by = ", ".join(map(_ticked, keys))
            spark.sql(f"CREATE TABLE {table} ({kind}) USING parquet CLUSTERED BY ({by}) "
                      f"SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
        stored.common[name] = spark.table(table)
        stored.hot[name] = spark.read.schema(kind).parquet(f"{dst}/{name}/hot")
    return stored

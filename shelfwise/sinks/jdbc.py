"""K1/K2 for a relational database over JDBC; the caller brings url, driver and credentials."""

from __future__ import annotations

from pyspark.sql import DataFrame

BATCH_ROWS = 10_000


def load_table(df: DataFrame, name: str, url: str, properties: dict[str, str] | None = None,
               connections: int = 16, keep_ddl: bool = True) -> None:
    """K1: replace the table's contents in batches of 10,000 rows, then check the row count.

    `connections` bounds how many tasks write at once. With `keep_ddl` the table is emptied
    rather than dropped, so its column types and indexes stay. A task that is re-run after it
    had already committed would leave rows twice; the closing count finds that.
    """
    options = {"batchsize": str(BATCH_ROWS), "numPartitions": str(connections),
               "truncate": str(keep_ddl).lower(), **(properties or {})}
    df.write.format("jdbc").options(url=url, dbtable=name, **options).mode("overwrite").save()
    wanted = df.count()
    stored = (df.sparkSession.read.format("jdbc")
              .options(url=url, dbtable=name, **(properties or {})).load().count())
    if stored != wanted:
        raise RuntimeError(f"{name}: wrote {wanted} rows but the table holds {stored}")


def load_all(tables: dict[str, DataFrame], url: str, properties: dict[str, str] | None = None,
             **kwargs) -> None:
    """K2: all tables in the given order."""
    for name, df in tables.items():
        load_table(df, name, url, properties, **kwargs)

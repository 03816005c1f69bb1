"""The movement log and the sales as streams.

Both keep additive state per group and emit the changed groups of every micro-batch. A batch is
written to a folder of its own, replaced as a whole when it is replayed, so restarts after lost
executors leave nothing twice. Neither needs a watermark to stay right: late rows always count,
and state grows with the number of groups, not with the stream. For very many groups keep the
state in RocksDB (spark.sql.streaming.stateStore.providerClass).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise import schemas as S
from shelfwise.functions.clean import quoted as q
from shelfwise.sinks import keyed

BATCH = "batch"


def moving_last_movement(movement: DataFrame) -> DataFrame:
    """Staged movement stream -> latest date per (product, warehouse)."""
    return movement.groupBy(q("Product No."), q("Warehouse")).agg(
        F.max("Date").alias("Last Movement Date"))


def channel_days(sales: DataFrame, watermark: str | None = None) -> DataFrame:
    """Staged sales stream (snake_case names) -> sums per day and channel.

    Without a watermark each day is revised for as long as rows come in, and sales without a
    date keep their own group. With one, a day is final, and leaves the state, once the
    watermark has passed it (append mode); rows that are later than that, or have no date, are
    then not counted, so use it only behind a bounded delay.
    """
    sums = [F.count("*").alias("n_rows"),
            F.sum("amount").cast(S.TOTAL).alias("amount"),
            F.sum("qty").cast(S.TOTAL).alias("qty"),
            F.sum("profit").cast(S.TOTAL).alias("profit")]
    day = F.col("date").cast("date")
    if watermark is None:
        return sales.groupBy(day.alias("day"), "channel").agg(*sums)
    # The start of the day in session time is both event time and group: a tumbling day.
    timed = (sales.where(day.isNotNull()).withColumn("start", day.cast("timestamp"))
             .withWatermark("start", watermark))
    return timed.groupBy("start", "channel").agg(*sums).select(
        F.col("start").cast("date").alias("day"), "channel", "n_rows", "amount", "qty", "profit")


def run_available(stream: DataFrame, table: str, checkpoint: str, mode: str = "update",
                  per_batch: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Process what has arrived, then stop; each micro-batch becomes `table`/batch=<id>.

    X1 needs no state where only `latest_movements` is read: run the staged log itself with
    `mode="append"` and `per_batch=last_movement`, which keeps the maxima of each batch.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = per_batch(batch) if per_batch else batch
        rows.write.mode("overwrite").parquet(f"{table}/{BATCH}={batch_id}")

    query = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).foreachBatch(write).start())
    query.awaitTermination()
    return query


def latest_movements(spark: SparkSession, table: str) -> DataFrame:
    """Current state of X1: a maximum never falls, so the maximum over batches is the last one."""
    return (spark.read.parquet(table).groupBy(q("Product No."), q("Warehouse"))
            .agg(F.max("Last Movement Date").alias("Last Movement Date"))
            .where(q("Last Movement Date").isNotNull()))


def latest_channel_days(spark: SparkSession, table: str) -> DataFrame:
    """Current state of X3: the sums of the last batch that touched a day and channel."""
    sums = ["n_rows", "amount", "qty", "profit"]
    last = F.max(F.struct(BATCH, *sums)).alias("last")
    return (spark.read.parquet(table).groupBy("day", "channel").agg(last)
            .select("day", "channel", *[f"last.{c}" for c in sums]))


def run_folded(stream: DataFrame, dst: str, checkpoint: str, keys: list[str],
               mode: str = "update", order: list[str] = (),
               per_batch: Callable[[DataFrame], DataFrame] | None = None,
               **layout) -> StreamingQuery:
    """Process what has arrived, then stop; every batch is folded into one keyed table.

    A batch's rows replace those of the same keys, or, with `order`, those that are not larger by
    these columns. It writes about as much as it changes (`sinks.keyed`), and readers (`folded`)
    see all of it or nothing. A batch that is run again after a failure is either there already,
    and does nothing, or replaces what its first run left.

    X1 needs no stream state at all with mode "append", `per_batch=last_movement` and
    `order=["Last Movement Date"]`: the table itself keeps the maxima.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = keyed.manifest(spark, dst)
        if before is not None and before.seq >= batch_id:
            batch.write.format("noop").mode("overwrite").save()  # the stream's own state must go on
            return
        rows = per_batch(batch) if per_batch else batch
        keyed.upsert(spark, dst, rows, keys, batch_id, order, **layout)

    query = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).foreachBatch(write).start())
    query.awaitTermination()
    return query


SUMS = ["amount", "qty", "profit"]
COUNTS = ["n_rows", "n_late"]


def run_closed_days(stream: DataFrame, dst: str, checkpoint: str, delay_days: int,
                    **layout) -> StreamingQuery:
    """X3 behind a watermark, without losing what comes later than that: process, then stop.

    A day is closed once a day more than `delay_days` after it has been seen in an earlier batch.
    Rows of closed days are late: they are added to their day all the same, and counted. Rows
    without a date have a group of their own, which never closes. The table is keyed by day and
    channel and adds up, so a batch that is run again after a failure counts once, whatever the
    order of the rows the sums are those of a batch over all of them, and nothing is kept in the
    state of the stream.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        day = F.col("date").cast("date")
        closed = _closed_before(spark, dst, delay_days)
        late = F.lit(False) if closed is None else F.coalesce(day < F.lit(closed), F.lit(False))
        rows = batch.groupBy(day.alias("day"), "channel").agg(
            F.count("*").alias("n_rows"), F.count_if(late).alias("n_late"),
            *[F.sum(c).cast(S.TOTAL).alias(c) for c in SUMS])
        keyed.upsert(spark, dst, rows, ["day", "channel"], batch_id, summed=[*COUNTS, *SUMS],
                     **layout)

    query = (stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).foreachBatch(write).start())
    query.awaitTermination()
    return query


def _closed_before(spark: SparkSession, dst: str, delay_days: int):
    """Days before this one are closed; None while there is no dated row."""
    if keyed.manifest(spark, dst) is None:
        return None
    return keyed.read(spark, dst).agg(F.date_sub(F.max("day"), delay_days)).first()[0]


def closed_days(spark: SparkSession, dst: str, delay_days: int) -> DataFrame:
    """Sums per day and channel, how many rows came after the day had closed, and whether it has."""
    closed = _closed_before(spark, dst, delay_days)
    over = F.lit(False) if closed is None else F.coalesce(F.col("day") < F.lit(closed), F.lit(False))
    return keyed.read(spark, dst).select("day", "channel", *COUNTS, *SUMS, over.alias("closed"))


def folded(spark: SparkSession, dst: str) -> DataFrame:
    """The rows that the last committed batch left."""
    return keyed.read(spark, dst)

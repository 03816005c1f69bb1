"""Last movement per product and warehouse, and the age of what is in stock."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise import schemas as S
from shelfwise.functions import ageing as A
from shelfwise.functions.clean import quoted as q
from shelfwise.functions.dates import in_days

KEYS = ["Product No.", "Warehouse"]


def _usable(movement: DataFrame, safe_keys: bool) -> DataFrame:
    """With `safe_keys`, placeholder products of the log cannot meet those of the balance."""
    if not safe_keys:
        return movement
    return movement.where(~q("Product No.").startswith(S.PRODUCT_PLACEHOLDER_PREFIX))


def last_movement(movement: DataFrame, until: datetime.date | None = None) -> DataFrame:
    """A1: latest date per (product, warehouse) over all movement types.

    max(date) is combined on the map side, so a hot pair reaches the shuffle once per task.
    """
    if until is not None:  # on written tables with their month column, only those folders
        movement = in_days(movement, "Date", None, until)
    # max() skips NULL dates; pairs that have no other go afterwards. A NULL filter on Date in
    # front would be pushed below the parsing and parse every date twice.
    return (movement.groupBy(q("Product No."), q("Warehouse"))
            .agg(F.max("Date").alias("Last Movement Date"))
            .where(q("Last Movement Date").isNotNull()))


def _join_last(balance: DataFrame, last: DataFrame, bucketed: bool = False) -> DataFrame:
    """Left join on the pair; `last` holds each pair once.

    Tables that are bucketed by pair, without hot ones, are joined as they lie.

    The pair's hash is a join key as well. It keeps Spark from reusing the partitioning `last`
    has from its aggregation: with an exchange of its own right below either side of a
    sort-merge join, AQE can split a pair that holds much of the balance over many tasks. The
    extra exchange moves one narrow row per pair. The hash is only part of the condition, so no
    row carries it.
    """
    if bucketed:
        return balance.join(last, KEYS, "left")
    theirs = [f"_last{i}" for i in range(len(KEYS))]
    others = last.withColumnsRenamed(dict(zip(KEYS, theirs, strict=True)))
    same = F.xxhash64(*[q(k) for k in KEYS]) == F.xxhash64(*theirs)
    for key, other in zip(KEYS, theirs, strict=True):
        same &= q(key) == F.col(other)
    return balance.join(others, same, "left").drop(*theirs)


def stock_ageing(balance: DataFrame, movement: DataFrame, run_date: datetime.date,
                 aging_threshold_days: int = S.AGED_DAYS, as_of_strict: bool = False,
                 safe_keys: bool = False, bucketed: bool = False) -> DataFrame:
    """T5: one row per row of `balance`; never drops or multiplies a row.

    `as_of_strict` ignores movements after the run date; otherwise they give negative ages, as
    the staged table always did.
    """
    last = last_movement(_usable(movement, safe_keys), run_date if as_of_strict else None)
    return age_stock(balance, last, run_date, aging_threshold_days, bucketed)


def age_stock(balance: DataFrame, last: DataFrame, run_date: datetime.date,
              aging_threshold_days: int = S.AGED_DAYS, bucketed: bool = False) -> DataFrame:
    """T5 over known last movements, such as those a stream keeps."""
    joined = _join_last(balance, last, bucketed)
    age = A.age_days(run_date, q("Last Movement Date"), last.schema["Last Movement Date"].dataType)
    return joined.withColumn("Inventory Age Days", age).select(
        *[q(n) for n in S.STG_STOCK_AGING.names[:9]],
        A.aging_bucket(q("Inventory Age Days")).alias("Aging Bucket"),
        A.is_aged(q("Inventory Age Days"), aging_threshold_days).alias("Is Aged 45 Plus"),
    )


def movement_spans(movement: DataFrame, run_dates: list[datetime.date]) -> DataFrame:
    """The days on which a pair moved, each with the next such day: product, warehouse, day, next, first.

    Days up to the first run date become the last of them, later ones than the last run date go.
    A pair has at most one row per day of the calendar, whatever it holds of the log: they are
    told apart before the shuffle, and the window sees no more than that.
    """
    early, late = F.lit(min(run_dates)), F.lit(max(run_dates))
    day = q("Date").cast("date")
    days = (movement.where(day <= late)
            .groupBy(*[q(k) for k in KEYS], F.greatest(day, early).alias("_slot"))
            .agg(F.max(day).alias("day")))
    pair = Window.partitionBy(*[q(k) for k in KEYS]).orderBy("day")
    return days.select(*[q(k) for k in KEYS], "day", F.lead("day").over(pair).alias("next"),
                       F.lag("day").over(pair).isNull().alias("first"))


def asof_series(balance: DataFrame, movement: DataFrame,
                run_dates: list[datetime.date]) -> DataFrame:
    """Ageing profile as of several run dates, each blind to later movements.

    Between two movements of a pair its last movement stays, so its age falls into each bucket
    on one stretch of run dates. Every movement day hence says when its pair enters and leaves
    each bucket; these changes, summed by bucket and day, are added up along the calendar and read
    off at the run dates, of which repeats count once. The work is one pass over log and balance plus the length of the
    series, not their product: pairs are never multiplied by run dates.
    """
    dates = sorted(set(run_dates))
    if not dates:
        raise ValueError("a series needs run dates")
    held = balance.groupBy(*[q(k) for k in KEYS]).agg(
        F.count("*").alias("n"), F.sum("Stock on Hand").cast(S.TOTAL).alias("units"))
    spans = held.join(movement_spans(movement, dates), KEYS, "left")
    day, until = F.col("day"), F.col("next")
    orders = len(S.AGING_BUCKETS) + 2  # as in `bucket_order`; the last is for no movement

    def change(order: int, at: Column, sign: int, when: Column) -> Column:
        # What happened before the series holds from its first date on.
        return F.when(when, F.struct(F.lit(order).alias("bucket_order"), F.greatest(
            at, F.lit(dates[0])).alias("at"), F.lit(sign).alias("sign")))

    moved, lower, changes = day.isNotNull(), 0, []
    for k, upper in enumerate([*[b[0] for b in S.AGING_BUCKETS], None]):
        enters = F.date_add(day, lower)
        leaves = until if upper is None else F.least(F.date_add(day, upper + 1), until)
        reached = moved & (enters < F.coalesce(until, F.date_add(F.lit(dates[-1]), 1)))
        changes += [change(k + 1, enters, 1, reached),
                    change(k + 1, leaves, -1, reached & leaves.isNotNull())]
        lower = (upper or 0) + 1
    changes += [change(orders, F.lit(dates[0]), 1, ~moved | F.col("first")),
                change(orders, day, -1, moved & F.col("first"))]
    summed = (spans.select("n", "units", F.explode(F.array(*changes)).alias("x"))
              .where(F.col("x.at") <= F.lit(dates[-1]))
              .groupBy("x.bucket_order", "x.at")
              .agg(F.sum(F.col("n") * F.col("x.sign")).alias("n"),
                   F.sum(F.when(F.col("x.sign") > 0, F.col("units")).otherwise(-F.col("units")))
                   .cast(S.TOTAL).alias("units")))
    marks = balance.sparkSession.range(1).select(F.explode(F.lit(dates)).alias("run_date")).select(
        F.explode(F.lit(list(range(1, orders + 1)))).alias("bucket_order"),
        F.col("run_date").alias("at"), F.lit(0).cast("long").alias("n"),
        F.lit(0).cast(S.TOTAL).alias("units"), F.lit(True).alias("mark"))
    # A line per bucket and day of the calendar; those of the same day count together.
    along = Window.partitionBy("bucket_order").orderBy("at")
    read_off = summed.withColumn("mark", F.lit(False)).unionByName(marks).select(
        "bucket_order", "at", "mark", F.sum("n").over(along).alias("n_rows"),
        F.sum("units").over(along).cast(S.TOTAL).alias("units"))
    return read_off.where(F.col("mark") & (F.col("n_rows") > 0)).select(
        F.col("at").alias("run_date"), A.bucket_names(F.col("bucket_order"))[0].alias("aging_bucket"),
        "n_rows", "units")

"""The star schema.

A dimension key is xxhash64 of the natural name, so facts compute it in place: no join against
the dimensions, no broadcast, and keys stay the same from run to run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import ageing as A

DIMENSIONS = ("brand", "warehouse", "category")


def dim_date(sales: DataFrame, ageing: DataFrame) -> DataFrame:
    """Every day between the first and the last date of the facts."""
    day = F.col("day")
    spans = sales.select(F.col("date").cast("date").alias("day")).unionByName(
        ageing.select(F.col("last_movement_date").cast("date").alias("day")))
    ends = spans.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    days = ends.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"), day.alias("date"),
        F.year(day).alias("year"), F.quarter(day).alias("quarter"), F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"), F.trunc(day, "month").alias("month_start"))


def dim(name: str, *facts: DataFrame) -> DataFrame:
    """Distinct names over all facts."""
    names = reduce(DataFrame.unionByName, [f.select(name) for f in facts]).distinct()
    return names.select(F.xxhash64(name).alias(f"{name}_key"), name)


def _keys() -> list[Column]:
    return [F.xxhash64(d).alias(f"{d}_key") for d in DIMENSIONS]


def _date_key(c: str) -> Column:
    return F.date_format(c, "yyyyMMdd").cast("int").alias("date_key")


def fact_sales(sales: DataFrame) -> DataFrame:
    """G14"""
    return sales.select(_date_key("date"), *_keys(), "*")


def fact_stock_aging(ageing: DataFrame) -> DataFrame:
    """G15"""
    return ageing.select(
        _date_key("last_movement_date"), *_keys(), "*",
        A.aging_status(F.col("age_days")).alias("aging_status"))


def with_dimensions(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The rows of a fact that find their member in every dimension: all, if keys are sound.

    Joining on key and name keeps rows right even if two names ever shared a hash.
    """
    for name, table in dims.items():
        fact = fact.join(table, [f"{name}_key", name])
    return fact


def key_check(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """dimension, n_rows, n_matched, n_same_name: a fact joined to its dimensions by key alone.

    All three counts equal the fact's rows if keys are sound: fewer matches are missing members,
    more rows are keys that fan out, fewer equal names are keys that two names share.
    """
    parts = []
    for name, table in dims.items():
        member = table.select(F.col(f"{name}_key").alias("_key"), F.col(name).alias("_name"))
        keyed = fact.groupBy(f"{name}_key", name).agg(F.count("*").alias("n"))
        found = keyed.join(member, F.col(f"{name}_key") == F.col("_key"), "left")
        parts.append(found.agg(
            F.sum("n").alias("n_rows"), F.sum(F.when(F.col("_key").isNotNull(), F.col("n")))
            .alias("n_matched"), F.sum(F.when(F.col("_name") == F.col(name), F.col("n")))
            .alias("n_same_name")).select(F.lit(name).alias("dimension"), "*"))
    return reduce(DataFrame.unionByName, parts)

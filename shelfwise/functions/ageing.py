"""Age of stock in days and what follows from it (C14-C17)."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import schemas as S


def age_days(run_date: datetime.date, last: Column, dtype: T.DataType = T.DateType()) -> Column:
    """C14: whole days from `last` to midnight of the run date, rounded down."""
    days = F.datediff(F.lit(run_date), last.cast("date"))
    if isinstance(dtype, T.DateType):
        return days
    # A time of day after midnight takes the rounded-down difference one day lower.
    return days - (last > F.date_trunc("day", last)).cast("int")


def _banded(age: Column, labels: list, oldest, missing) -> Column:
    banded = F.when(age.isNull() | (age < 0), F.lit(missing))
    for (upper, _, _), label in zip(S.AGING_BUCKETS, labels):
        banded = banded.when(age <= upper, F.lit(label))
    return banded.otherwise(F.lit(oldest))


def aging_bucket(age: Column) -> Column:
    """C15"""
    return _banded(age, [b[1] for b in S.AGING_BUCKETS], S.OLDEST_BUCKET[0], S.NO_MOVEMENT)


def aging_status(age: Column) -> Column:
    """C17"""
    return _banded(age, [b[2] for b in S.AGING_BUCKETS], S.OLDEST_BUCKET[1], S.NO_MOVEMENT)


def bucket_order(age: Column) -> Column:
    """Position of the bucket in reports: youngest first, unknown last."""
    n = len(S.AGING_BUCKETS)
    return _banded(age, list(range(1, n + 1)), n + 1, n + 2)


def bucket_names(order: Column) -> tuple[Column, Column]:
    """Bucket label and health name for a `bucket_order`."""
    labels = [b[1] for b in S.AGING_BUCKETS] + [S.OLDEST_BUCKET[0], S.NO_MOVEMENT]
    names = [b[2] for b in S.AGING_BUCKETS] + [S.OLDEST_BUCKET[1], S.NO_MOVEMENT]
    return tuple(F.array(*map(F.lit, texts))[order - 1] for texts in (labels, names))


def is_aged(age: Column, threshold_days: int = S.AGED_DAYS) -> Column:
    """Never NULL."""
    return F.coalesce(age >= threshold_days, F.lit(False))

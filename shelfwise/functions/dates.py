"""Date ranges over tables that are laid out by month."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.clean import quoted as q

#: Folder column of tables written by month.
MONTH = "month_of_date"


def in_days(df: DataFrame, column: str, after: datetime.date | None,
            until: datetime.date) -> DataFrame:
    """Rows dated `after` < date <= `until`; of tables with a month folder only those folders.

    The folder column is dropped, so the result has the table's own columns.
    """
    day = q(column).cast("date")
    wanted = (day <= F.lit(until)) if after is None else (day > F.lit(after)) & (day <= F.lit(until))
    if MONTH not in df.columns:
        return df.where(wanted)
    month = F.col(MONTH)
    folders = month <= f"{until:%Y-%m}"
    if after is not None:
        folders = folders & (month >= f"{after + datetime.timedelta(days=1):%Y-%m}")
    return df.where(folders & wanted).drop(MONTH)

"""Row positions without a global sort or a single-task window over data rows (C4).

Every split of a file source is read in order by one task. The position of a row is the number
of rows in all earlier files and earlier splits of its file, plus its place within its own split.
So one count per split is summed up within its file, and one count per file over all files.
Only rows that need a position are joined to these offsets; the others pass with their scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.clean import quoted
from shelfwise.schemas import ROW_ID

MARKS = ["_file", "_start", "_pos"]


def _ahead(counts: DataFrame, order: str, *part: str):
    """Rows in all earlier lines of `counts`."""
    window = Window.partitionBy(*part) if part else Window
    over = window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_n").over(over), F.lit(0))


def split_offsets(marked: DataFrame, splits_in_order: bool = False) -> DataFrame:
    """_file, _start, _add of every split: _pos + _add is a row's position.

    The window over all files sees one row per file, that within a file one per split.
    """
    # The counter of a text scan restarts per task, not per split: subtract where the split
    # began. Positions in a Parquet file begin at 0.
    first = F.min("_pos") if splits_in_order else F.lit(0)
    counts = marked.groupBy("_file", "_start").agg(F.count("*").alias("_n"), first.alias("_first"))
    files = counts.groupBy(F.col("_file").alias("_of")).agg(F.sum("_n").alias("_n"))
    files = files.select("_of", _ahead(files, "_of").alias("_files"))
    inside = counts.select("_file", "_start", "_first",
                           _ahead(counts, "_start", "_file").alias("_splits"))
    return inside.join(files, F.col("_file") == F.col("_of")).select(
        "_file", "_start", (F.col("_files") + F.col("_splits") - F.col("_first")).alias("_add"))


def mark_rows(df: DataFrame, splits_in_order: bool = False) -> DataFrame:
    """Append where each row of an untransformed file scan was read, as the columns MARKS.

    Parquet carries the position within the file. For text formats pass `splits_in_order=True`:
    there the place within the split comes from the task-local counter.
    """
    meta = F.col("_metadata")
    file = meta["file_path"].alias("_file")
    if splits_in_order:
        marks = [file, meta["file_block_start"].alias("_start"),
                 F.monotonically_increasing_id().alias("_pos")]
    else:
        marks = [file, F.lit(0).cast("bigint").alias("_start"), meta["row_index"].alias("_pos")]
    return df.select(*[quoted(c) for c in df.columns], *marks)


def join_offsets(marked: DataFrame, offsets: DataFrame, name: str = ROW_ID) -> DataFrame:
    """Replace the marks by positions. A row without an offset fails the job and is never lost."""
    cols = [quoted(c) for c in marked.columns if c not in MARKS]
    lost = F.raise_error(F.concat(F.lit("no row offset for "), F.col("_file"))).cast("bigint")
    place = F.coalesce(F.col("_pos") + F.col("_add"), lost)
    return marked.join(offsets, MARKS[:2], "left").select(*cols, place.alias(name))


def number_rows(marked: DataFrame, splits_in_order: bool = False, where: Column | None = None,
                name: str = ROW_ID) -> DataFrame:
    """Replace the marks by the 0-based row position; with `where`, only there and NULL elsewhere.

    With `where` the other rows are neither shuffled nor joined: they are one scan of their own.
    """
    offsets = split_offsets(marked, splits_in_order)
    if where is None:
        return join_offsets(marked, offsets, name)
    wanted = F.coalesce(where, F.lit(False))
    cols = [quoted(c) for c in marked.columns if c not in MARKS]
    others = marked.filter(~wanted).select(*cols, F.lit(None).cast("bigint").alias(name))
    return others.unionAll(join_offsets(marked.filter(wanted), offsets, name))


def with_row_ids(df: DataFrame, splits_in_order: bool = False, where: Column | None = None,
                 name: str = ROW_ID) -> DataFrame:
    """Append the 0-based row position to an untransformed file scan."""
    return number_rows(mark_rows(df, splits_in_order), splits_in_order, where, name)

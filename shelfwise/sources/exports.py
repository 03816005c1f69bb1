"""The four ERP exports as DataFrames of text, exactly as in the file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions import clean as C
from shelfwise.functions import clean as C
from shelfwise.schemas import BROKEN, NA_TOKENS, RAW_REQUIRED, ROW_ID
from shelfwise.sources.row_ids import MARKS, mark_rows, with_row_ids

# Table name -> base name of its export below the raw folder.
TABLES = {
    "product": "PRODUCT",
    "sales": "SALES",
    "stock_balance": "STOCK_BALANCE",
    "stock_balance_details": "STOCK_BALANCE_DETAILS",
}
CSV_OPTIONS = {"quote": '"', "escape": '"'}
#: Holds the text of a CSV record that has not just as many cells as the header.
BROKEN = "_broken_record"


def require_columns(columns: list[str], names, what: str) -> None:
    """Stop at plan time if a needed column is missing."""
    missing = [n for n in names if n not in columns]
    if missing:
        raise ValueError(f"{what}: missing column(s) {missing}")


def unique_headers(names: list[str]) -> list[str]:
    """Header texts with repeats numbered .1, .2, ...; the first of each keeps its name."""
    taken, seen, out = set(names), {}, []
    for name in names:
        if name in seen:
            n = seen[name]
            while f"{name}.{n}" in taken:
                n += 1
            seen[name] = n + 1
            name = f"{name}.{n}"
            taken.add(name)
        else:
            seen[name] = 1
        out.append(name)
    return out


def _read_csv(spark: SparkSession, path: str, options: dict,
              broken: bool) -> tuple[DataFrame, list[str]]:
    """The scan and its header texts. The scan carries them as names only if they are distinct.

    A record with more or fewer cells than the header has (a line break inside quotes makes two
    of those, unless `multiLine` is set) fails the job, or with `broken` is kept with its text in
    the last column, BROKEN. Spark only sees all cells where it may not leave out columns.
    """
    reader = spark.read.options(**{**CSV_OPTIONS, **options})
    # The first row of the first split is a header line; take it as text to keep repeats apart.
    first = reader.option("header", False).csv(path).first()
    if first is None:
        raise ValueError(f"{path}: no header line")
    given = [v if v is not None else f"Unnamed: {i}" for i, v in enumerate(first)]
    headers = unique_headers(given)
    distinct = list(first) == headers and len({h.lower() for h in headers}) == len(headers)
    names = headers if distinct else [f"_{i}" for i in range(len(headers))]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    if broken:
        schema = schema.add(BROKEN, T.StringType())
        headers = [*headers, BROKEN]
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BROKEN)
    else:
        reader = reader.option("mode", "FAILFAST").option("columnPruning", False)
    # With unaltered, distinct headers every further file must show the same line.
    df = (reader.option("header", True).option("enforceSchema", not distinct)
          .schema(schema).csv(path))
    return df, headers


def missing_to_null(df: DataFrame, names: list[str]) -> DataFrame:
    """Turn missing-value texts into NULL in every text column and set the final names."""
    tokens = ", ".join("'" + t + "'" for t in NA_TOKENS)
    exprs = []
    for i, field in enumerate(df.schema.fields):
        alias = "`" + names[i].replace("`", "``") + "`"
        if isinstance(field.dataType, T.StringType):
            exprs.append(f"CASE WHEN _{i} NOT IN ({tokens}) THEN _{i} END AS {alias}")
        else:
            exprs.append(f"_{i} AS {alias}")
    return df.toDF(*[f"_{i}" for i in range(len(names))]).selectExpr(*exprs)


def blank_product(df: DataFrame, table: str, headers: list[str]) -> Column:
    """Rows without a product number, which need their position to get one (C4)."""
    name = "Product NO." if table == "sales" else "Product No."
    cell = C.quoted(df.columns[headers.index(name)]).cast("string")
    return C.known(C.null_na(cell)).isNull()


def read_raw(spark: SparkSession, table: str, path: str, fmt: str = "csv",
             row_ids: bool | str = True, options: dict | None = None,
             broken: bool = False) -> DataFrame:
    """One export. `fmt` is csv, parquet, or table (`path` is then a catalog name).

    CSV columns are all text, so product numbers never turn into floats. Row positions are added
    for file formats: to all rows, with `row_ids="blank"` to those without a product number (no
    others need one), or with `row_ids="marks"` only the columns they can be worked out from. A
    catalog table must bring its own `_row_id` if it has blank numbers. `broken` keeps CSV
    records that have not as many cells as the header, marked; without it they fail the job.
    """
    options = options or {}
    headers = None
    if fmt == "csv":
        df, headers = _read_csv(spark, path, options, broken)
    elif fmt == "parquet":
        df = spark.read.options(**options).parquet(path)
    elif fmt == "table":
        df = spark.table(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    headers = headers or df.columns
    require_columns(headers, RAW_REQUIRED[table], table)
    if row_ids and fmt != "table" and ROW_ID not in headers:
        if row_ids == "marks":
            df, added = mark_rows(df, splits_in_order=fmt == "csv"), MARKS
        else:
            where = None if row_ids is True else blank_product(df, table, headers)
            df, added = with_row_ids(df, fmt == "csv", where), [ROW_ID]
        headers = [*headers, *added]
    return missing_to_null(df, headers)


def read_all(spark: SparkSession, base: str, fmt: str = "csv", **kwargs) -> dict[str, DataFrame]:
    """The four exports below one folder, nothing computed yet."""
    suffix = {"csv": ".csv", "parquet": ".parquet"}
    def location(stem: str) -> str:
        return f"{base}.{stem.lower()}" if fmt == "table" else f"{base}/{stem}{suffix[fmt]}"
    return {t: read_raw(spark, t, location(stem), fmt, **kwargs) for t, stem in TABLES.items()}

"""Raw exports to staged tables, each as one narrow projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import schemas as S
from shelfwise.functions import clean as C
from shelfwise.functions.clean import quoted as q
from shelfwise.sources.exports import require_columns


def _row_id(df: DataFrame) -> Column | None:
    return F.col(S.ROW_ID) if S.ROW_ID in df.columns else None


def _cast(c: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return c
    if want == T.StringType():
        return c.cast(want)
    if want == T.IntegerType():
        return C.to_whole(c)
    if want == T.DateType():
        # A source that carries a time of day keeps it.
        return c if isinstance(have, (T.TimestampType, T.TimestampNTZType)) else c.try_cast(want)
    return c.try_cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns in declared order and type, then any others as they are.

    What does not fit a declared type becomes NULL; `quality_report` counts those.
    """
    require_columns(df.columns, schema.names, "conform")
    have = {f.name: f.dataType for f in df.schema.fields}
    declared = [_cast(q(f.name), have[f.name], f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*declared, *[q(c) for c in df.columns if c not in schema.names])


def _dated(df: DataFrame, name: str) -> Column:
    return C.parse_date(q(name), df.schema[name].dataType)


def _with_category(df: DataFrame, name: str) -> DataFrame:
    """Category first: the brand rule refers to the cleaned one."""
    return df.withColumn(name, C.clean_category(q(name), stripped=True))


def stage_product(raw: DataFrame, house_category: str = S.HOUSE_CATEGORY) -> DataFrame:
    """12 columns, one row per raw row."""
    require_columns(raw.columns, S.RAW_REQUIRED["product"], "product")
    df = _with_category(C.strip_fields(raw, "Product No.", "Category", "Brand"), "Category")
    rules = {
        "Product No.": C.clean_product_no(q("Product No."), _row_id(raw), stripped=True),
        "Tier 1 Category": q("Category"),
        "Brand": C.clean_brand(q("Category"), q("Brand"), house_category, stripped=True),
    }
    kept = df.select(*[rules[n].alias(n) if n in rules else q(n) for n in S.STG_PRODUCT.names])
    return conform(kept, S.STG_PRODUCT)


def stage_sales(raw: DataFrame, house_category: str = S.HOUSE_CATEGORY) -> DataFrame:
    """Every column kept, declared ones typed; one row per raw row."""
    require_columns(raw.columns, S.RAW_REQUIRED["sales"], "sales")
    df = _with_category(
        C.strip_fields(raw, "Tier 1 Category", "Brand", "Product NO.", "Sales Channels", "Warehouse",
               "Store"), "Tier 1 Category")
    rules = {
        "Date": _dated(raw, "Date"),
        "Brand": C.clean_brand(q("Tier 1 Category"), q("Brand"), house_category, stripped=True),
        "Product NO.": C.clean_product_no(q("Product NO."), _row_id(raw), stripped=True),
        "Sales Channels": C.clean_channel(q("Sales Channels"), stripped=True),
        "Warehouse": C.clean_text(q("Warehouse"), S.UNSPECIFIED_WAREHOUSE, stripped=True),
        "Store": C.clean_text(q("Store"), S.UNSPECIFIED_STORE, stripped=True),
    }
    kept = df.select(*[rules.get(n, q(n)).alias(n) for n in raw.columns
                       if n not in (S.ROW_ID, S.BROKEN)])
    present = T.StructType([f for f in S.STG_SALES.fields if f.name in kept.columns])
    return conform(kept, present)


def stage_movement(raw: DataFrame, house_category: str = S.HOUSE_CATEGORY) -> DataFrame:
    """T4: 14 columns, one row per raw row; works on a stream as well."""
    require_columns(raw.columns, S.RAW_REQUIRED["stock_balance_details"], "stock_balance_details")
    df = _with_category(
        C.strip_fields(raw, "Product No.", "Category", "Brand", "Type", "Warehouse"), "Category")
    rules = {
        "Date": _dated(raw, "Date"),
        "Tier 1 Category": q("Category"),
        "Brand": C.clean_brand(q("Category"), q("Brand"), house_category, stripped=True),
        "Product No.": C.clean_product_no(q("Product No."), _row_id(raw), stripped=True),
        "Type": C.clean_text(q("Type"), S.UNSPECIFIED_MOVEMENT, stripped=True),
        "Warehouse": C.clean_text(q("Warehouse"), S.UNSPECIFIED_WAREHOUSE, stripped=True),
    }
    kept = df.select(*[rules[n].alias(n) if n in rules else q(n)
                       for n in S.STG_STOCK_MOVEMENT.names])
    return conform(kept, S.STG_STOCK_MOVEMENT)


def gold_names(df: DataFrame) -> DataFrame:
    """Staged column names to the snake_case names of the gold tables."""
    return df.select(*[q(c).alias(S.GOLD_NAMES.get(c, c)) for c in df.columns])

"""The four exports, derived from the TPC-H-like test tables.

part is the product master, lineitem with its order the sales and (by ship date) the movement
log, and open lines per part and supplier nation the stock. Blanks and bad dates are put in by
key arithmetic, so the same rules can be written in the oracle's SQL. Sales and movements come
as text dates; a lookup table is joined only where a wanted column needs it (every lookup is on
a unique key and a left join, so it neither drops nor multiplies rows).
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.schemas import NUMBER, ROW_ID
from shelfwise.sources.row_ids import MARKS, mark_rows, number_rows, with_row_ids

HOUSE = "PROMO"
RUN_DATE = datetime.date(2001, 8, 1)
# Narrow enough that products and differences stay in 18 digits, which Spark keeps in a long.
MONEY = "decimal(10,2)"
QUANTITY = "decimal(6,2)"

PRODUCT_NO = "cast(p_partkey AS string)"
PRODUCT_NO_WITH_BLANKS = "CASE WHEN p_partkey % 97 = 0 THEN '  ' ELSE cast(p_partkey AS string) END"


# Declared, so that building a plan opens no file.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = with_row_ids(table(spark, sf_dir, "part"))
    price = "cast(p_retailprice AS decimal(18,4))"
    return part.selectExpr(
        f"{PRODUCT_NO_WITH_BLANKS} AS `Product No.`",
        "p_name AS `Product Name`", "p_type AS `Product Type`",
        "CASE WHEN p_partkey % 11 = 0 THEN '' ELSE lower(p_type) END AS `Category`",
        "CASE WHEN p_partkey % 5 = 0 THEN '  ' WHEN p_partkey % 7 = 0 THEN NULL "
        "ELSE p_brand END AS `Brand`",
        "concat('SKU-', cast(p_partkey AS string)) AS `SKU No.`",
        "CASE WHEN p_size > 25 THEN 'CARTON' ELSE 'PCS' END AS `Unit of Measure`",
        f"CASE WHEN p_partkey % 19 = 0 THEN '1,234' ELSE cast({price} AS string) END "
        "AS `Purchase Price`",
        f"{price} AS `Wholesale Price`", f"{price} AS `Retail Price`",
        "cast(NULL AS string) AS `Online Price`",
        "cast(p_partkey + 1000000 AS string) AS `Product Barcode`", ROW_ID)


_CHANNEL = "CASE WHEN o_custkey % 17 = 0 THEN ' ' ELSE ' ' || lower(c_mktsegment) END"
_QTY = f"cast(l_quantity AS {QUANTITY})"
_AMOUNT = f"cast(l_extendedprice AS {MONEY}) * (1 - cast(l_discount AS decimal(3,2)))"
_COST = f"{_QTY} * cast(p_retailprice AS {MONEY})"

# Export column -> (expression, lookup tables it needs)
SALES_COLUMNS = {
    "Date": ("CASE WHEN l_orderkey % 13 = 0 THEN '31/02/2000' "
             "ELSE date_format(o_orderdate, 'dd/MM/yyyy') END", ("orders",)),
    "Product": ("p_name", ("part",)),
    "Product NO.": ("cast(l_partkey AS string)", ()),
    "Product Type": ("p_type", ("part",)),
    "Tier 1 Category": ("lower(p_type)", ("part",)),
    "Brand": ("CASE WHEN l_partkey % 5 = 0 THEN '  ' ELSE p_brand END", ("part",)),
    "Warehouse": ("n_name", ("supplier", "nation")),
    "Store": ("s_name", ("supplier",)),
    "Sales Channels": ("o_channel", ("orders", "customer")),
    "Refund Quantity": (f"CASE WHEN l_returnflag = 'R' THEN {_QTY} ELSE 0 END", ()),
    "Refund Order Count": ("CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END", ()),
    "Net Sales Amount": (_AMOUNT, ()),
    "Net Sales Quantity": (_QTY, ()),
    "Net Sales Cost": (_COST, ("part",)),
    "Net Sales Unit Price": (f"cast(l_extendedprice AS {MONEY})", ()),
    "Net Sales Unit Cost": (f"cast(p_retailprice AS {MONEY})", ("part",)),
    "Net Sales Gross Profit": (f"{_AMOUNT} - {_COST}", ("part",)),
    "Net Sales Gross Margin": ("concat(cast(cast(l_discount * 100 AS int) AS string), '%')", ()),
}


def lineitem_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as a file stream."""
    # A pattern, as the table may be one file or a folder; a stream's plain path must be a folder.
    return spark.readStream.schema(SCHEMAS["lineitem"]).parquet(f"{sf_dir}/lineitem.parque[t]")


def raw_sales(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] | None = None,
              lines: DataFrame | None = None) -> DataFrame:
    """The sales export. With `columns`, the others are NULL and their lookups are left out.

    `lines` stands in for the lineitem table, such as its stream.
    """
    wanted = set(columns if columns is not None else SALES_COLUMNS)
    needed = {t for c in wanted for t in SALES_COLUMNS[c][1]}
    df = lines if lines is not None else table(spark, sf_dir, "lineitem")
    # Customers join the orders first, so that lineitem, the largest, is not moved for them.
    # (The 25 nations are always below Spark's broadcast threshold and move nothing.)
    if "orders" in needed:
        order = table(spark, sf_dir, "orders")
        if "customer" in needed:
            order = _lookup(order, table(spark, sf_dir, "customer"), "o_custkey = c_custkey") \
                .selectExpr("o_orderkey", "o_orderdate", f"{_CHANNEL} AS o_channel")
        df = _lookup(df, order, "l_orderkey = o_orderkey")
    if "part" in needed:
        df = _lookup(df, table(spark, sf_dir, "part"), "l_partkey = p_partkey")
    if "supplier" in needed:
        df = _lookup(df, table(spark, sf_dir, "supplier"), "l_suppkey = s_suppkey")
    if "nation" in needed:
        df = _lookup(df, table(spark, sf_dir, "nation"), "s_nationkey = n_nationkey")
    # Keys and amounts cost no lookup and always come along.
    exprs = {c: expr if c in wanted or not tables else "cast(NULL AS string)"
             for c, (expr, tables) in SALES_COLUMNS.items()}
    return df.selectExpr(*[f"{expr} AS `{c}`" for c, expr in exprs.items()])


def _lookup(df: DataFrame, other: DataFrame, on: str) -> DataFrame:
    return df.join(other, F.expr(on), "left")


def _log_lines(spark: SparkSession, sf_dir: str, with_part: bool = False,
               lines: DataFrame | None = None) -> DataFrame:
    df = lines if lines is not None else table(spark, sf_dir, "lineitem")
    df = _lookup(df, table(spark, sf_dir, "supplier"), "l_suppkey = s_suppkey")
    df = _lookup(df, table(spark, sf_dir, "nation"), "s_nationkey = n_nationkey")
    if with_part:
        df = _lookup(df, table(spark, sf_dir, "part"), "l_partkey = p_partkey")
    return df


def movement_columns(date_text: str = "date_format(l_shipdate, 'dd/MM/yyyy')") -> list[str]:
    """Export columns over lineitem joined to supplier and nation."""
    return [
        "cast(l_partkey AS string) AS `Product No.`",
        "cast(NULL AS string) AS `Product Name`", "cast(NULL AS string) AS `SKU No.`",
        "cast(NULL AS string) AS `Category`", "cast(NULL AS string) AS `Brand`",
        "'PCS' AS `Unit of Measure`",
        "CASE l_returnflag WHEN 'N' THEN 'Receive Stock' WHEN 'A' THEN 'Transfer Stock' "
        "ELSE ' ' END AS `Type`",
        "cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string) AS `Document No.`",
        f"{date_text} AS `Date`", "n_name AS `Warehouse`",
        f"CASE WHEN l_linestatus = 'O' THEN {_QTY} END AS `Inbound-Quantity`",
        f"CASE WHEN l_linestatus = 'F' THEN {_QTY} END AS `Outbound-Quantity`",
        f"{_QTY} AS `Closing-Quantity`", "cast(NULL AS string) AS `Closing-Cost`",
    ]


def raw_movement(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """The movement log; `lines` stands in for the lineitem table, such as its stream."""
    return _log_lines(spark, sf_dir, lines=lines).selectExpr(*movement_columns())


def _blank_numbers(df: DataFrame, name: str) -> DataFrame:
    """Blank product numbers, and row positions for just those."""
    keep = [c for c in df.columns if c not in MARKS]
    blank = F.expr("l_partkey % 97 = 0")
    numbered = number_rows(df, where=blank)
    return numbered.withColumn(name, F.when(blank, F.lit("  ")).otherwise(F.col(f"`{name}`"))) \
        .select(*[F.col(f"`{c}`") for c in keep if c != "l_partkey"], ROW_ID)


def raw_sales_with_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales without lookups, every 97th product without its number."""
    lines = mark_rows(table(spark, sf_dir, "lineitem"))
    exprs = [f"{expr if not tables else 'cast(NULL AS string)'} AS `{c}`"
             for c, (expr, tables) in SALES_COLUMNS.items()]
    return _blank_numbers(lines.selectExpr(*exprs, "l_partkey", *MARKS), "Product NO.")


def raw_movement_with_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The movement log, every 97th product without its number."""
    lines = _log_lines(spark, sf_dir, lines=mark_rows(table(spark, sf_dir, "lineitem")))
    return _blank_numbers(lines.selectExpr(*movement_columns(), "l_partkey", *MARKS), "Product No.")


def raw_movement_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with categories and brands, dates that do not exist, and gaps in the closings."""
    replaced = {
        "Category": "CASE WHEN p_partkey % 11 = 0 THEN ' ' ELSE lower(p_type) END",
        "Brand": "CASE WHEN p_partkey % 5 = 0 THEN '  ' ELSE p_brand END",
        "Date": "CASE WHEN l_orderkey % 13 = 0 THEN '31/02/2000' "
                "ELSE date_format(l_shipdate, 'dd/MM/yyyy') END",
        "Closing-Quantity": f"CASE WHEN l_orderkey % 3 <> 0 THEN {_QTY} END",
    }
    exprs = []
    for line in movement_columns():
        name = line.rsplit("`", 2)[1]
        exprs.append(f"{replaced[name]} AS `{name}`" if name in replaced else line)
    return _log_lines(spark, sf_dir, with_part=True).selectExpr(*exprs)


def raw_movement_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with every third movement on one product in one warehouse."""
    return _log_lines(spark, sf_dir).selectExpr(*_replaced(_HOT_PAIR))


_HOT = "l_orderkey % 3 = 1"
_HOT_PAIR = {"Product No.": f"CASE WHEN {_HOT} THEN '7' ELSE cast(l_partkey AS string) END",
             "Warehouse": f"CASE WHEN {_HOT} THEN 'NATION_7' ELSE n_name END"}


def _replaced(others: dict[str, str]) -> list[str]:
    """`movement_columns` with other expressions for some."""
    names = [line.rsplit("`", 2)[1] for line in movement_columns()]
    return [f"{others[n]} AS `{n}`" if n in others else line
            for n, line in zip(names, movement_columns(), strict=True)]


def raw_movement_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """That log with closings that stay, as what goes in goes out again.

    Some lines bring two more in than the next closing knows of, some products are written up by
    five from a day on, and many lines have no closing.
    """
    return _log_lines(spark, sf_dir).selectExpr(*_replaced({
        **_HOT_PAIR,
        "Inbound-Quantity": f"{_QTY} + CASE WHEN l_orderkey % 11 = 4 AND l_partkey % 3 = 0 "
                            "THEN 2 ELSE 0 END",
        "Outbound-Quantity": _QTY,
        "Closing-Quantity": "CASE WHEN l_orderkey % 11 <> 4 AND l_orderkey % 4 <> 3 THEN 100 + "
                            f"CASE WHEN l_partkey % 5 = 1 AND NOT ({_HOT}) AND "
                            "l_shipdate > timestamp_ntz'1999-06-30' THEN 5 ELSE 0 END END"}))


def raw_movement_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log with dates 0 to 90 days before the run date, so that few brands are slow."""
    back = ("CASE WHEN l_partkey % 40 < cast(substr(p_brand, 7) AS int) % 12 THEN 46 ELSE 0 END "
            "+ cast(l_quantity AS int) % 45")
    day = f"date_format(date_sub(date'{RUN_DATE}', {back}), 'dd/MM/yyyy')"
    return _log_lines(spark, sf_dir, with_part=True).selectExpr(*movement_columns(day))


def warehouse_names(spark: SparkSession, sf_dir: str) -> list[tuple[int, str]]:
    """Header line of the balance sheet; nation is one of the fixed tables (25 rows)."""
    rows = table(spark, sf_dir, "nation").select("n_nationkey", "n_name").collect()
    return sorted((r.n_nationkey, r.n_name) for r in rows)


def raw_balance_wide(spark: SparkSession, sf_dir: str, blank_products: bool = False) -> DataFrame:
    """The balance sheet: a row per part, two columns per warehouse, a summary column, as text.

    No stock is an empty cell, and no `-Unit Cost` column exists.
    """
    names = warehouse_names(spark, sf_dir)
    # A hot part is summed up on the map side: one narrow row per (part, nation) is left. Those
    # meet their part before they become one wide row, so no half-empty wide rows are shuffled.
    per_pair = (table(spark, sf_dir, "lineitem").where("l_linestatus = 'O'")
                .join(table(spark, sf_dir, "supplier"), F.expr("l_suppkey = s_suppkey"), "left")
                .groupBy("l_partkey", "s_nationkey").agg(F.expr(f"sum({_QTY}) AS soh")))
    part = table(spark, sf_dir, "part")
    if blank_products:
        part = with_row_ids(part)
    kind = NUMBER.simpleString()
    pairs = part.join(per_pair, F.expr("p_partkey = l_partkey"), "left").selectExpr(
        *part.columns, "s_nationkey", f"cast(nullif(soh, 0) AS {kind}) AS soh",
        f"cast(soh * cast(p_retailprice AS {MONEY}) AS {kind}) AS value")
    filled = pairs.groupBy(*part.columns).agg(
        *[F.expr(f"max(CASE WHEN s_nationkey = {key} THEN {x} END) AS {x}{key}")
          for key, _ in names for x in ("soh", "value")],
        F.expr(f"cast(coalesce(sum(soh), 0) AS {kind}) AS summary"))
    cells = [x for key, w in names for x in (
        f"cast(soh{key} AS string) AS `{w}- Stock on Hand`",
        f"cast(coalesce(value{key}, 0) AS string) AS `{w}-Inventory Asset Value`")]
    return filled.selectExpr(
        f"{PRODUCT_NO_WITH_BLANKS if blank_products else PRODUCT_NO} AS `Product No.`",
        "p_name AS `Product Name`", "cast(NULL AS string) AS `SKU No.`",
        "lower(p_type) AS `Category`",
        "CASE WHEN p_partkey % 5 = 0 THEN '  ' ELSE p_brand END AS `Brand`",
        "'PCS' AS `Unit of Measurement`", *cells,
        "cast(summary AS string) AS `Summary- Stock on Hand`",
        *([ROW_ID] if blank_products else []))

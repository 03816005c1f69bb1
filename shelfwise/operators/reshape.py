"""The wide balance sheet (three columns per warehouse) as one row per product and warehouse."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import schemas as S
from shelfwise.functions import clean as C
from shelfwise.sources.exports import require_columns

# --- fixed values: header forms of the balance sheet ---------------------------------------
STOCK_HEADER = r"Stock on Hand$"
WAREHOUSE_SUFFIX = r"\s*-\s*Stock on Hand$"
COST_HEADER = "{}-Unit Cost"
VALUE_HEADER = "{}-Inventory Asset Value"
SUMMARY = "summary"


@dataclass(frozen=True)
class Block:
    """One warehouse of the sheet: its place in header order and its column positions."""

    ordinal: int
    warehouse: str
    stock: int
    cost: int | None
    value: int | None


def plan_headers(names: list[str]) -> list[Block]:
    """Which columns belong to which warehouse, read off the header line alone."""
    at: dict[str, int] = {}
    for i, name in enumerate(names):
        at.setdefault(name, i)
    blocks: list[Block] = []
    for i, name in enumerate(names):
        if not re.search(STOCK_HEADER, name):
            continue
        warehouse = re.sub(WAREHOUSE_SUFFIX, "", name).strip()
        if warehouse.lower() != SUMMARY:
            blocks.append(Block(len(blocks), warehouse, i, at.get(COST_HEADER.format(warehouse)),
                                at.get(VALUE_HEADER.format(warehouse))))
    if not blocks:
        raise ValueError("stock_balance: no '<warehouse>- Stock on Hand' column")
    return blocks


def unread_headers(names: list[str]) -> list[str]:
    """Headers that name stock on hand but are not read: trailing blanks, numbered repeats."""
    return [n for n in names
            if re.search(r"Stock on Hand", n) and not re.search(STOCK_HEADER, n)]


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _cells(wide: DataFrame, positions: list[int | None]) -> str:
    """SQL for one array holding a warehouse cell each, in block order."""
    types = [f.dataType for f in wide.schema.fields]
    given = [types[p] for p in positions if p is not None]
    as_text = any(isinstance(t, T.StringType) for t in given)
    cells = ["NULL" if p is None else f"CAST(c{p} AS string)"
             if as_text and not isinstance(types[p], T.StringType) else f"c{p}"
             for p in positions]
    return f"array({', '.join(cells)})" if given else "CAST(NULL AS array<string>)"


def unpivot_balance(raw: DataFrame, house_category: str = S.HOUSE_CATEGORY,
                    warehouses: list[str] | None = None,
                    sheet_rows: int | None = None) -> DataFrame:
    """|raw| x #warehouses rows, zero stock included, summary columns left out.

    One scan and no shuffle. The cells of each kind are gathered in an array, the fixed list of
    warehouses is exploded, and each row picks its own cells: stock that is asked for alone
    reads no cost columns, and the generated code stays small however many warehouses there are
    (an Expand over all columns outgrows what the JVM compiles). Category and brand are cleaned
    on the wide rows, once per product. `warehouses` builds only those blocks; a filter on the
    result would still read all columns. `sheet_rows` is the length of the sheet, if `raw` is not
    all of it.
    """
    names = raw.columns
    require_columns(raw.columns, S.RAW_REQUIRED["stock_balance"], "stock_balance")
    blocks = plan_headers(names)
    if warehouses is not None:
        blocks = [b for b in blocks if b.warehouse in set(warehouses)]
        if not blocks:
            raise ValueError(f"stock_balance: none of {sorted(warehouses)} in the headers")

    # By position: header texts may differ in case only, which names cannot tell apart.
    wide = raw.toDF(*[f"c{i}" for i in range(len(names))])
    at = {n: f"c{names.index(n)}" for n in S.RAW_REQUIRED["stock_balance"]}
    texts = [at[n] for n in ("Product No.", "Category", "Brand")]
    stripped = C.strip_fields(wide, *texts).withColumn(
        at["Category"], C.clean_category(F.col(at["Category"]), stripped=True))
    ids = {
        "id_no": C.known(F.col(at["Product No."]), stripped=True),
        "id_name": F.col(at["Product Name"]).cast("string"),
        "id_sku": F.col(at["SKU No."]).cast("string"),
        "id_category": F.col(at["Category"]),
        "id_brand": C.clean_brand(F.col(at["Category"]), F.col(at["Brand"]), house_category,
                                  stripped=True),
        "id_unit": F.col(at["Unit of Measurement"]).cast("string"),
    }
    if S.ROW_ID in names:
        ids["id_row"] = F.col(f"c{names.index(S.ROW_ID)}")
        # Position in the unpivoted table: all rows of earlier warehouses come first.
        n_rows = wide.agg(F.count("*")).scalar() if sheet_rows is None else F.lit(sheet_rows)
        row_id = F.col("block") * n_rows + F.col("id_row")
    else:
        row_id = None
    cells = {"s": [b.stock for b in blocks], "u": [b.cost for b in blocks],
             "v": [b.value for b in blocks]}
    listed = ", ".join(f"struct({i} AS i, {b.ordinal}L AS block, {_text(b.warehouse)} AS wh)"
                       for i, b in enumerate(blocks))
    long = (stripped.select(*[c.alias(n) for n, c in ids.items()],
                            *[F.expr(_cells(wide, at)).alias(n) for n, at in cells.items()])
            .selectExpr("*", f"inline(array({listed}))"))
    return long.select(
        C.clean_product_no(F.col("id_no"), row_id, stripped=True).alias("Product No."),
        F.col("id_name").alias("Product Name"), F.col("id_sku").alias("SKU No."),
        F.col("id_category").alias("Tier 1 Category"), F.col("id_brand").alias("Brand"),
        F.col("id_unit").alias("Unit of Measurement"), F.col("wh").alias("Warehouse"),
        C.zero_filled(F.col("s")[F.col("i")]).alias("Stock on Hand"),
        C.to_number(F.col("u")[F.col("i")]).alias("Unit Cost"),
        C.to_number(F.col("v")[F.col("i")]).alias("Inventory Asset Value"),
    )

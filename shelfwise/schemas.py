"""Column contracts of the raw exports and of the staged tables, plus fixed rule values."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: text cells that count as missing when a sheet is read ------------------
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# --- fixed values: texts that count as blank after trimming (case-sensitive) --------------
BLANK_TOKENS = ("nan", "None", "NaT", "<NA>")
# --- fixed values: the characters a Unicode-aware strip removes ---------------------------
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# --- fixed values: placeholders -----------------------------------------------------------
UNCATEGORISED = "UNCATEGORISED"
UNBRANDED_SUFFIX = " - UNBRANDED"
UNSPECIFIED = "UNSPECIFIED"
UNSPECIFIED_WAREHOUSE = "UNSPECIFIED WAREHOUSE"
UNSPECIFIED_STORE = "UNSPECIFIED STORE"
UNSPECIFIED_MOVEMENT = "UNSPECIFIED MOVEMENT"
PRODUCT_PLACEHOLDER_PREFIX = "UNSPECIFIED-"
HOUSE_CATEGORY = "ORAIMO"
DATE_PATTERN = "d/M/yyyy"
# --- fixed values: ageing buckets as (upper bound in days, label, health name) ------------
AGING_BUCKETS = (
    (15, "0-15 Days", "Healthy"),
    (30, "16-30 Days", "Watch"),
    (45, "31-45 Days", "Review"),
    (60, "46-60 Days", "Slow Moving"),
    (90, "61-90 Days", "Critical"),
)
OLDEST_BUCKET = ("90+ Days", "Dead Stock")
NO_MOVEMENT = "No Movement Data"
AGED_DAYS = 45
SLOW_BRAND_RATIO = 0.10

ROW_ID = "_row_id"
# Text of a CSV record that has not as many cells as the header.
BROKEN = "_broken_record"
NUMBER = T.DecimalType(18, 4)
TOTAL = "decimal(38,4)"


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_S, _N = T.StringType(), NUMBER

# --- fixed values: columns of the staged tables -------------------------------------------
STG_PRODUCT = _struct(
    ("Product No.", _S), ("Product Name", _S), ("Product Type", _S), ("Tier 1 Category", _S),
    ("Brand", _S), ("SKU No.", _S), ("Unit of Measure", _S), ("Purchase Price", _N),
    ("Wholesale Price", _N), ("Retail Price", _N), ("Online Price", _N), ("Product Barcode", _S),
)
STG_SALES = _struct(
    ("Date", T.DateType()), ("Product", _S), ("Product NO.", _S), ("Product Type", _S),
    ("Tier 1 Category", _S), ("Brand", _S), ("Warehouse", _S), ("Store", _S),
    ("Sales Channels", _S), ("Refund Quantity", _N), ("Refund Order Count", T.IntegerType()),
    ("Net Sales Amount", _N), ("Net Sales Quantity", _N), ("Net Sales Cost", _N),
    ("Net Sales Unit Price", _N), ("Net Sales Unit Cost", _N), ("Net Sales Gross Profit", _N),
    ("Net Sales Gross Margin", _S),
)
STG_STOCK_BALANCE = _struct(
    ("Product No.", _S), ("Product Name", _S), ("SKU No.", _S), ("Tier 1 Category", _S),
    ("Brand", _S), ("Unit of Measurement", _S), ("Warehouse", _S), ("Stock on Hand", _N),
    ("Unit Cost", _N), ("Inventory Asset Value", _N),
)
STG_STOCK_MOVEMENT = _struct(
    ("Product No.", _S), ("Product Name", _S), ("SKU No.", _S), ("Tier 1 Category", _S),
    ("Brand", _S), ("Unit of Measure", _S), ("Type", _S), ("Document No.", _S),
    ("Date", T.DateType()), ("Warehouse", _S), ("Inbound-Quantity", _N),
    ("Outbound-Quantity", _N), ("Closing-Quantity", _N), ("Closing-Cost", _N),
)
STG_STOCK_AGING = T.StructType(
    _struct(
        ("Product No.", _S), ("Product Name", _S), ("Tier 1 Category", _S), ("Brand", _S),
        ("Warehouse", _S), ("Stock on Hand", _N), ("Inventory Asset Value", _N),
        ("Last Movement Date", T.DateType()), ("Inventory Age Days", T.IntegerType()),
        ("Aging Bucket", _S),
    ).fields
    + [T.StructField("Is Aged 45 Plus", T.BooleanType(), False)]
)

STAGED = {
    "stg_product": STG_PRODUCT,
    "stg_sales": STG_SALES,
    "stg_stock_balance": STG_STOCK_BALANCE,
    "stg_stock_movement": STG_STOCK_MOVEMENT,
    "stg_stock_aging": STG_STOCK_AGING,
}


def _raw_names(staged: T.StructType, **renamed: str) -> tuple[str, ...]:
    back = {v: k for k, v in renamed.items()}
    return tuple(back.get(f.name, f.name) for f in staged.fields)


# Columns an export must carry; the balance sheet adds three columns per warehouse.
RAW_REQUIRED = {
    "product": _raw_names(STG_PRODUCT, Category="Tier 1 Category"),
    "sales": (
        "Date", "Tier 1 Category", "Brand", "Product NO.", "Sales Channels", "Warehouse", "Store",
    ),
    "stock_balance": (
        "Product No.", "Product Name", "SKU No.", "Category", "Brand", "Unit of Measurement",
    ),
    "stock_balance_details": _raw_names(STG_STOCK_MOVEMENT, Category="Tier 1 Category"),
}

# Staged column -> name used by the gold tables.
GOLD_NAMES = {
    "Product No.": "product_no",
    "Product NO.": "product_no",
    "Product": "product_name",
    "Product Name": "product_name",
    "Product Type": "product_type",
    "Tier 1 Category": "category",
    "Brand": "brand",
    "SKU No.": "sku_no",
    "Unit of Measure": "unit_of_measure",
    "Unit of Measurement": "unit_of_measure",
    "Purchase Price": "purchase_price",
    "Wholesale Price": "wholesale_price",
    "Retail Price": "retail_price",
    "Online Price": "online_price",
    "Product Barcode": "barcode",
    "Date": "date",
    "Warehouse": "warehouse",
    "Store": "store",
    "Sales Channels": "channel",
    "Refund Quantity": "refund_qty",
    "Refund Order Count": "refund_orders",
    "Net Sales Amount": "amount",
    "Net Sales Quantity": "qty",
    "Net Sales Cost": "cost",
    "Net Sales Unit Price": "unit_price",
    "Net Sales Unit Cost": "unit_cost",
    "Net Sales Gross Profit": "profit",
    "Net Sales Gross Margin": "margin_text",
    "Stock on Hand": "stock_on_hand",
    "Unit Cost": "unit_cost",
    "Inventory Asset Value": "asset_value",
    "Type": "type",
    "Document No.": "document_no",
    "Inbound-Quantity": "inbound",
    "Outbound-Quantity": "outbound",
    "Closing-Quantity": "closing",
    "Closing-Cost": "closing_cost",
    "Last Movement Date": "last_movement_date",
    "Inventory Age Days": "age_days",
    "Aging Bucket": "aging_bucket",
    "Is Aged 45 Plus": "is_aged",
}

"""The aggregates behind the dashboards.

All functions take frames with the snake_case names of `gold_names`. Counts of distinct products
go through a first aggregation by (group, product), so one hot brand or bucket is spread over
many tasks and no rows are multiplied for several distinct counts.
"""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise import schemas as S
from shelfwise.functions.dates import in_days
from shelfwise.functions import ageing as A


def total(c: Column | str) -> Column:
    """Exact sum as decimal(38,4); 0 for no rows."""
    return F.coalesce(F.sum(c), F.lit(0)).cast(S.TOTAL)


def ratio(num: Column, den: Column) -> Column:
    """num / den as a double of 6 decimals, NULL for a zero denominator."""
    return F.round(F.try_divide(num.cast("double"), den.cast("double")), 6)


def slow_moving(ageing: DataFrame, flag_at: float = S.SLOW_BRAND_RATIO,
                grain: str = "sku") -> DataFrame:
    """G1: aged share of what a brand has in stock.

    `sku` counts a product once, aged if any warehouse holds it aged; `pair` counts every
    (product, warehouse).
    """
    # Brands without any stock stay in the result, with a NULL ratio.
    stocked = (F.col("stock_on_hand") > 0).cast("int")
    aged = (F.col("is_aged") & (F.col("stock_on_hand") > 0)).cast("int")
    flags = ageing.select("brand", "product_no", stocked.alias("in_stock"), aged.alias("aged"))
    if grain == "sku":
        flags = flags.groupBy("brand", "product_no").agg(
            F.max("in_stock").alias("in_stock"), F.max("aged").alias("aged"))
    elif grain != "pair":
        raise ValueError(f"grain must be 'sku' or 'pair', not {grain!r}")
    share = ratio(F.col("aged"), F.col("in_stock"))
    return (flags.groupBy("brand")
            .agg(F.sum("in_stock").alias("in_stock"), F.sum("aged").alias("aged"))
            .select("brand", "in_stock", "aged", share.alias("ratio"),
                    F.coalesce(F.try_divide(F.col("aged").cast("double"),
                                            F.col("in_stock").cast("double")) >= flag_at,
                               F.lit(False)).alias("flagged")))


def aging_profile(ageing: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows, SKUs, units and value per bucket, optionally per `by` columns."""
    # The bucket travels as its number; its names are looked up on the few rows at the end.
    keys = [*(by or []), "bucket_order"]
    tagged = ageing.select(*(by or []), "product_no", "stock_on_hand", "asset_value",
                           A.bucket_order(F.col("age_days")).alias("bucket_order"))
    per_sku = tagged.groupBy(*keys, "product_no").agg(
        F.count("*").alias("n"), F.sum("stock_on_hand").alias("units"),
        F.sum("asset_value").alias("value"))
    label, name = A.bucket_names(F.col("bucket_order"))
    return per_sku.groupBy(*keys).agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("n_skus"),
        total("units").alias("units"), total("value").alias("value")).select(
        *keys, label.alias("aging_bucket"), name.alias("aging_status"), "n_rows", "n_skus",
        "units", "value")


def sku_numbers(df: DataFrame) -> DataFrame:
    """product_no, sku: numbers that are dense within each range of products.

    Every task numbers its own sorted range, so nothing passes through one task and a lost range
    gets its numbers again.
    """
    return df.select("product_no").distinct().orderBy("product_no").select(
        "product_no", F.monotonically_increasing_id().alias("sku"))


def aging_cube(ageing: DataFrame) -> DataFrame:
    """G2 over brand, warehouse, category and overall at once (GROUPING SETS), with SKU counts.

    `dimension` names the set, `member` its value. Distinct products are exact: a cell holds a
    bitmap over a page of dense product numbers, and bitmaps of cells are merged, so the sets
    multiply cells and not the table. Warehouses have cells of their own, as cells of all three
    dimensions at once would be about as many as rows.
    """
    rows = ageing.select("brand", "warehouse", "category", "aging_bucket", "product_no",
                         "stock_on_hand", "asset_value").join(sku_numbers(ageing), "product_no")
    page = F.bitmap_bucket_number("sku").alias("page")

    def cells(*dimensions: str) -> DataFrame:
        return rows.groupBy(*dimensions, "aging_bucket", page).agg(
            F.count("*").alias("n_rows"), F.sum("stock_on_hand").cast(S.TOTAL).alias("units"),
            F.sum("asset_value").cast(S.TOTAL).alias("value"),
            F.bitmap_construct_agg(F.bitmap_bit_position("sku")).alias("skus"))

    rolled = ageing.sparkSession.sql(
        """
        SELECT CASE WHEN grouping(brand) = 0 THEN 'brand'
                    WHEN grouping(category) = 0 THEN 'category' ELSE 'all' END AS dimension,
               coalesce(brand, category) AS member, aging_bucket, page,
               sum(n_rows) AS n_rows, sum(units) AS units, sum(value) AS value,
               bitmap_or_agg(skus) AS skus
        FROM {cells}
        GROUP BY GROUPING SETS ((aging_bucket, page), (brand, aging_bucket, page),
                                (category, aging_bucket, page))
        """, cells=cells("brand", "category"))
    places = cells("warehouse").select(F.lit("warehouse").alias("dimension"),
                                       F.col("warehouse").alias("member"), "aging_bucket", "page",
                                       "n_rows", "units", "value", "skus")
    return rolled.unionByName(places).groupBy("dimension", "member", "aging_bucket").agg(
        F.sum("n_rows").alias("n_rows"), F.sum(F.bitmap_count("skus")).alias("n_skus"),
        total("units").alias("units"), total("value").alias("value"))


def exec_kpi(ageing: DataFrame, sales: DataFrame) -> DataFrame:
    """One row of headline figures.

    Products and warehouses are counted as groups, as two distinct counts in one aggregate would
    multiply the rows of the table.
    """
    skus = ageing.select("product_no").distinct().agg(F.count("product_no").alias("n_skus"))
    places = ageing.groupBy("warehouse").agg(
        F.sum("asset_value").cast(S.TOTAL).alias("v"),
        F.sum("stock_on_hand").cast(S.TOTAL).alias("u"),
        F.sum(F.when(F.col("is_aged"), F.col("asset_value"))).cast(S.TOTAL).alias("a"))
    stock = places.agg(
        total("v").alias("inventory_value"), total("u").alias("units"),
        F.count("warehouse").alias("n_warehouses"), total("a").alias("aged_value"))
    sold = sales.agg(total("amount").alias("net_sales"), total("profit").alias("gross_profit"))
    # One-row frames side by side, without a join.
    parts = [stock, skus, sold]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).agg(
        *[F.max(c).alias(c) for part in parts for c in part.columns])
    return both.select(
        "inventory_value", "units", "n_skus", "n_warehouses", "net_sales", "gross_profit",
        ratio(F.col("gross_profit"), F.col("net_sales")).alias("margin"),
        ratio(F.col("aged_value"), F.col("inventory_value")).alias("aged_value_share"))


def sales_trend(sales: DataFrame, grain: str = "month") -> DataFrame:
    """Sums per month (or day); sales without a date form their own group."""
    if grain not in ("month", "day"):
        raise ValueError(f"grain must be 'month' or 'day', not {grain!r}")
    period = F.trunc("date", "month") if grain == "month" else F.col("date").cast("date")
    return sales.groupBy(period.alias(grain)).agg(
        F.count("*").alias("n_rows"), total("amount").alias("amount"),
        total("qty").alias("qty"), total("profit").alias("profit"))


def channel_split(sales: DataFrame) -> DataFrame:
    """Sums, margin and share of net sales per channel."""
    per = sales.groupBy("channel").agg(
        total("amount").alias("amount"), total("qty").alias("qty"),
        total("profit").alias("profit"))
    # All sums are asked for again: the subquery's plan is then the same up to the exchange,
    # which Spark reuses, so that sales are read once.
    sums = [F.sum(c).alias(c) for c in ("amount", "qty", "profit")]
    grand = per.agg(F.struct(*sums).alias("all")).scalar()["amount"]
    return per.select("channel", "amount", "qty", "profit",
                      ratio(F.col("profit"), F.col("amount")).alias("margin"),
                      ratio(F.col("amount"), grand).alias("share"))


def segment_rows(df: DataFrame, categories_in=None, brands_in=None,
                 exclude_categories=None) -> DataFrame:
    """The rows of one dashboard: house brand, phones, solar, accessories, ..."""
    if categories_in is not None:
        df = df.where(F.col("category").isin(*categories_in))
    if brands_in is not None:
        df = df.where(F.col("brand").isin(*brands_in))
    if exclude_categories is not None:
        df = df.where(~F.col("category").isin(*exclude_categories))
    return df


def segment(ageing: DataFrame, sales: DataFrame, categories_in=None, brands_in=None,
            exclude_categories=None) -> DataFrame:
    """Stock and sales per brand within one segment; a side without rows counts as 0."""
    pick = dict(categories_in=categories_in, brands_in=brands_in,
                exclude_categories=exclude_categories)
    stock = segment_rows(ageing, **pick).groupBy("brand").agg(
        total("stock_on_hand").alias("units"), total("asset_value").alias("value"),
        total(F.when(F.col("is_aged"), F.col("asset_value"))).alias("aged_value"))
    sold = segment_rows(sales, **pick).groupBy("brand").agg(
        total("amount").alias("amount"), total("profit").alias("profit"))
    zero = F.lit(0).cast(S.TOTAL)
    return stock.join(sold, "brand", "full").select(
        "brand", *[F.coalesce(F.col(c), zero).alias(c)
                   for c in ("units", "value", "aged_value", "amount", "profit")])


def days_of_cover(ageing: DataFrame, sales: DataFrame, run_date: datetime.date,
                  by: str = "brand", lookback_days: int = 30) -> DataFrame:
    """Stock on hand / average daily sales of the last `lookback_days` up to the run date."""
    start = run_date - datetime.timedelta(days=lookback_days)
    stock = ageing.groupBy(by).agg(total("stock_on_hand").alias("units"))
    sold = in_days(sales, "date", start, run_date).groupBy(by).agg(total("qty").alias("sold_qty"))
    zero = F.lit(0).cast(S.TOTAL)
    sold_qty = F.coalesce(F.col("sold_qty"), zero)
    cover = F.when(F.col("sold_qty") > 0, F.round(
        F.col("units").cast("double") * lookback_days / F.col("sold_qty").cast("double"), 6))
    return (stock.join(sold, by, "full")
            .select(by, F.coalesce(F.col("units"), zero).alias("units"),
                    sold_qty.alias("sold_qty"))
            .select(by, "units", "sold_qty", cover.alias("days_of_cover")))


def stock_status(cover: DataFrame, restock_below: float = 14, overstock_above: float = 90
                 ) -> DataFrame:
    """RESTOCK, OVERSTOCK or OK for every row of `days_of_cover`."""
    days = F.col("days_of_cover")
    return cover.select(
        "*",
        F.when((F.col("units") <= 0) | (days < restock_below), "RESTOCK")
        .when(days.isNull() | (days > overstock_above), "OVERSTOCK")
        .otherwise("OK").alias("status"))


def management_alert(ageing: DataFrame, house_category: str = S.HOUSE_CATEGORY) -> DataFrame:
    """Aged stock outside the house category."""
    return (ageing.where(F.col("is_aged") & (F.col("stock_on_hand") > 0)
                         & (F.col("category") != house_category.strip().upper()))
            .groupBy("brand", "warehouse")
            .agg(F.count("*").alias("n_rows"), total("stock_on_hand").alias("units"),
                 total("asset_value").alias("value")))


def reconcile(balance: DataFrame, movement: DataFrame, mode: str = "closing") -> DataFrame:
    """Stock on hand against the movement log per (product, warehouse).

    `closing` takes the closing quantity of the latest movement (by date, then document number,
    then quantity); `net` takes inbound minus outbound, for logs without closing quantities.
    A pair whose latest movement has no closing quantity is as little logged as one without any.
    """
    keys = ["product_no", "warehouse"]
    stock = balance.groupBy(*keys).agg(total("stock_on_hand").alias("stock"))
    if mode == "closing":
        order = F.struct("date", "document_no", "closing")
        logged = movement.groupBy(*keys).agg(F.max(order).alias("latest")).select(
            *keys, F.col("latest.closing").cast(S.TOTAL).alias("closing"))
    elif mode == "net":
        logged = movement.groupBy(*keys).agg(
            (total("inbound") - total("outbound")).cast(S.TOTAL).alias("closing"))
    else:
        raise ValueError(f"mode must be 'closing' or 'net', not {mode!r}")
    variance = (F.col("stock") - F.col("closing")).cast(S.TOTAL)
    return stock.join(logged, keys, "full").select(
        *keys, "stock", "closing", variance.alias("variance"),
        F.when(F.col("stock").isNull(), "NO_STOCK")
        .when(F.col("closing").isNull(), "NO_LOG")
        .when(F.col("closing") == F.col("stock"), "MATCH")
        .otherwise("VARIANCE").alias("class"))


def first_divergence(movement: DataFrame, scratch: str) -> DataFrame:
    """G16 in detail: where the running balance of a pair first leaves the logged closing quantity.

    Movements of a pair are taken in the order of date (those without one last), document
    number, and quantities. The balance that the first logged closing implies is carried forward
    by inbound minus outbound; the first movement whose closing quantity is another one is
    returned with both. Pairs that never diverge, or log no second closing, have no row.

    The log is written below `scratch` sorted by range, so that a file is a stretch of the order
    and a pair that holds much of the log lies in many files. Sums run inside (file, pair); what
    a file hands on, its net quantity and its last closing, runs along the files of the pair.
    So no window sees more than a file's rows or a line per file.
    """
    keys = ["product_no", "warehouse"]
    zero = F.lit(0).cast(S.TOTAL)
    net = F.coalesce(F.col("inbound").cast(S.TOTAL), zero) - F.coalesce(
        F.col("outbound").cast(S.TOTAL), zero)
    narrow = movement.select(*keys, "date", "document_no", net.cast(S.TOTAL).alias("net"),
                             F.col("closing").cast(S.TOTAL).alias("closing"))
    last = [F.col(c).asc_nulls_last() for c in ("date", "document_no", "net", "closing")]
    narrow.orderBy(*keys, *last).write.mode("overwrite").parquet(scratch)
    meta = F.col("_metadata")
    part = F.regexp_extract(meta["file_name"], r"part-(\d+)", 1).cast("int")
    rows = movement.sparkSession.read.schema(narrow.schema).parquet(scratch).select(
        "*", part.alias("file"), meta["row_index"].alias("at"))

    inside = Window.partitionBy("file", *keys).orderBy("at")
    # The balance before the file, as a closing tells it; NULL where none is logged.
    told = F.col("closing") - F.sum("net").over(inside)
    lines = rows.select("*", told.cast(S.TOTAL).alias("told"))
    earlier = F.last("told", ignorenulls=True).over(
        inside.rowsBetween(Window.unboundedPreceding, -1))
    lines = lines.select("*", earlier.alias("earlier"))
    event = F.struct("date", "document_no", "closing", "told", "earlier")
    given = F.col("told").isNotNull()
    files = lines.groupBy("file", *keys).agg(
        F.sum("net").cast(S.TOTAL).alias("net"),
        F.min_by(event, F.when(given, F.col("at"))).alias("first"),
        F.max_by("told", F.when(given, F.col("at"))).alias("last"),
        F.min_by(event, F.when(F.col("told") != F.col("earlier"), F.col("at"))).alias("change"))

    along = Window.partitionBy(*keys).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("net").over(along), zero).cast(S.TOTAL)
    placed = files.select(*keys, "file", "first", "last", "change", before.alias("before"))
    opening = (F.col("last") - F.col("before")).cast(S.TOTAL)
    handed = F.last(opening, ignorenulls=True).over(along)
    placed = placed.select("*", handed.alias("handed"))
    at_edge = (F.col("first.told") - F.col("before")) != F.col("handed")
    found = placed.select(*keys, "file", F.when(at_edge, F.struct(
        F.col("first.date").alias("date"), F.col("first.document_no").alias("document_no"),
        F.col("first.closing").alias("closing"),
        (F.col("first.closing") - (F.col("first.told") - F.col("before") - F.col("handed")))
        .cast(S.TOTAL).alias("balance"))).when(F.col("change").isNotNull(), F.struct(
            F.col("change.date").alias("date"), F.col("change.document_no").alias("document_no"),
            F.col("change.closing").alias("closing"),
            (F.col("change.closing") - (F.col("change.told") - F.col("change.earlier")))
            .cast(S.TOTAL).alias("balance"))).alias("event"))
    return found.where(F.col("event").isNotNull()).groupBy(*keys).agg(
        F.min_by("event", "file").alias("e")).select(
        *keys, F.col("e.date").alias("date"), F.col("e.document_no").alias("document_no"),
        F.col("e.balance").alias("balance"), F.col("e.closing").alias("closing"))


def orphans(product: DataFrame, **sources: DataFrame) -> DataFrame:
    """Products used by a source but absent from the product master.

    Sources and master are counted per product in one aggregation, combined per task ahead of
    its shuffle. An anti join would not do: Spark moves it below the counts, and then shuffles
    and sorts every row of the sources, each beside a copy of the master.
    """
    names = list(sources)

    def flagged(df: DataFrame, at: int | None) -> DataFrame:
        # The master's rows carry no count at all. A NULL is no product of the master.
        counts = [F.lit(int(at == i)).cast("long").alias(f"n{i}") for i in range(len(names))]
        return df.select("product_no", *counts, F.lit(at is None).alias("known"))

    rows = [flagged(df, i) for i, df in enumerate(sources.values())]
    rows.append(flagged(product.where(F.col("product_no").isNotNull()), None))
    counted = reduce(DataFrame.unionByName, rows).groupBy("product_no").agg(
        *[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(names))],
        F.max("known").alias("known"))
    lines = F.array(*[F.struct(F.lit(name).alias("source_table"), F.col(f"n{i}").alias("n_rows"))
                      for i, name in enumerate(names)])
    return (counted.where(~F.col("known")).select("product_no", F.inline(lines))
            .where(F.col("n_rows") > 0).select("source_table", "product_no", "n_rows"))


def top_n(df: DataFrame, key: str, measure: Column, n: int = 10) -> DataFrame:
    """The `n` largest keys by summed measure; ties go to the smaller key."""
    best = (df.groupBy(key).agg(total(measure).alias("value"))
            .orderBy(F.col("value").desc(), F.col(key)).limit(n))
    # Ranking happens on the n rows that are left.
    rank = F.row_number().over(Window.orderBy(F.col("value").desc(), F.col(key)))
    return best.select(rank.cast("bigint").alias("rank"), key, "value")


def top_n_per_group(df: DataFrame, group: str, key: str, measure: Column, n: int = 3) -> DataFrame:
    """G18 per group; Spark keeps only n rows per group and task ahead of the shuffle."""
    summed = df.groupBy(group, key).agg(total(measure).alias("value"))
    rank = F.row_number().over(
        Window.partitionBy(group).orderBy(F.col("value").desc(), F.col(key)))
    return (summed.select(group, key, "value", rank.cast("int").alias("rn"))
            .where(F.col("rn") <= n)
            .select(group, F.col("rn").cast("bigint").alias("rank"), key, "value"))

"""Every operator as a query over the driver tables: name -> callable(spark, sf_dir)."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise import schemas as S
from shelfwise.functions import clean as C
from shelfwise.functions.clean import quoted as q
from shelfwise.operators import ageing as A
from shelfwise.operators import quality as Q
from shelfwise.operators import rejects
from shelfwise.operators import reshape as R
from shelfwise.operators import staging as T
from shelfwise.plans import gold as G
from shelfwise.plans import star
from shelfwise.plans.refresh import run_refresh, stage_all
from shelfwise.session import shared_dir
from shelfwise.sinks import lake, stored
from shelfwise.sources import driver_tables as D
from shelfwise.sources.exports import TABLES, read_raw
from shelfwise.streaming import incremental as X

Query = Callable[[SparkSession, str], DataFrame]

AS_OF_DATES = [datetime.date(1999, 6, 30), datetime.date(2000, 12, 31), D.RUN_DATE]
TREND_COLUMNS = ("Date", "Net Sales Amount", "Net Sales Quantity", "Net Sales Gross Profit")
CHANNEL_COLUMNS = (*TREND_COLUMNS, "Sales Channels")
BRAND_COLUMNS = (*TREND_COLUMNS, "Tier 1 Category", "Brand")


# --- staged and snake_case frames ---------------------------------------------------------
def _balance(spark, sf):
    return R.unpivot_balance(D.raw_balance_wide(spark, sf), D.HOUSE)


def _movement(spark, sf):
    return T.stage_movement(D.raw_movement(spark, sf), D.HOUSE)


def _sales(spark, sf, columns=None, lines=None):
    return T.gold_names(T.stage_sales(D.raw_sales(spark, sf, columns, lines), D.HOUSE))


def _ageing(spark, sf, recent=False):
    log = D.raw_movement_recent(spark, sf) if recent else D.raw_movement(spark, sf)
    return T.gold_names(A.stock_ageing(_balance(spark, sf), T.stage_movement(log, D.HOUSE),
                                       D.RUN_DATE))


def _raw(spark, sf):
    return {"product": D.raw_product(spark, sf), "sales": D.raw_sales(spark, sf),
            "stock_balance": D.raw_balance_wide(spark, sf),
            "stock_balance_details": D.raw_movement(spark, sf)}


# --- cleaning -------------------------------------------------------------------------------
def c2_clean_category(spark, sf):
    return D.raw_product(spark, sf).select(
        F.col(S.ROW_ID).alias("row_id"), C.clean_category(q("Category")).alias("category"))


def c3_clean_brand(spark, sf):
    return D.raw_product(spark, sf).select(
        F.col(S.ROW_ID).alias("row_id"),
        C.clean_brand(C.clean_category(q("Category")), q("Brand"), D.HOUSE).alias("brand"))


def c4_product_no(spark, sf):
    return D.raw_product(spark, sf).select(
        F.col(S.ROW_ID).alias("row_id"),
        C.clean_product_no(q("Product No."), F.col(S.ROW_ID)).alias("product_no"))


def c4_product_no_unpivoted(spark, sf):
    long = R.unpivot_balance(D.raw_balance_wide(spark, sf, blank_products=True), D.HOUSE)
    return long.select(q("Product No.").alias("product_no"), q("Warehouse").alias("warehouse"))


def c4_sales_blank_numbers(spark, sf):
    staged = T.gold_names(T.stage_sales(D.raw_sales_with_blanks(spark, sf), D.HOUSE))
    return staged.select("product_no", "qty", "amount")


def c4_movement_blank_numbers(spark, sf):
    staged = T.gold_names(T.stage_movement(D.raw_movement_with_blanks(spark, sf), D.HOUSE))
    return staged.select("product_no", "warehouse", "document_no")


def c5_clean_text(spark, sf):
    raw = D.raw_sales(spark, sf, ("Sales Channels", "Warehouse", "Store"))
    return (raw.select(C.clean_channel(q("Sales Channels")).alias("channel"),
                       C.clean_text(q("Warehouse"), S.UNSPECIFIED_WAREHOUSE).alias("warehouse"),
                       C.clean_text(q("Store"), S.UNSPECIFIED_STORE).alias("store"))
            .groupBy("channel", "warehouse", "store").agg(F.count("*").alias("n_rows")))


def c6_parse_date(spark, sf):
    raw = D.raw_sales(spark, sf, ("Date",))
    return (raw.select(C.parse_date(q("Date"), raw.schema["Date"].dataType).alias("date"))
            .groupBy("date").agg(F.count("*").alias("n_rows")))


def c7_numeric(spark, sf):
    return D.raw_product(spark, sf).select(
        F.col(S.ROW_ID).alias("row_id"),
        C.to_number(q("Purchase Price")).alias("purchase_price"),
        C.zero_filled(q("Purchase Price")).alias("purchase_price_or_zero"))


# --- tables ---------------------------------------------------------------------------------
def t1_product(spark, sf):
    return T.gold_names(T.stage_product(D.raw_product(spark, sf), D.HOUSE))


def t2_sales(spark, sf):
    return _sales(spark, sf)


def t3_unpivot_balance(spark, sf):
    return T.gold_names(_balance(spark, sf))


def t3_unpivot_two_warehouses(spark, sf):
    long = R.unpivot_balance(D.raw_balance_wide(spark, sf), D.HOUSE,
                             warehouses=["NATION_3", "NATION_17"])
    return T.gold_names(long).select("product_no", "warehouse", "stock_on_hand", "asset_value")


def t4_movement(spark, sf):
    return T.gold_names(_movement(spark, sf))


def t4_movement_mixed(spark, sf):
    """A log with categories, brands, and dates that do not exist."""
    return T.gold_names(T.stage_movement(D.raw_movement_mixed(spark, sf), D.HOUSE))


def a1_last_movement_bad_dates(spark, sf):
    log = T.stage_movement(D.raw_movement_mixed(spark, sf), D.HOUSE)
    return T.gold_names(A.last_movement(log))


def a1_last_movement(spark, sf):
    return T.gold_names(A.last_movement(_movement(spark, sf)))


def t5_stock_aging(spark, sf):
    return _ageing(spark, sf)


def t5_stock_aging_strict(spark, sf):
    return T.gold_names(A.stock_ageing(_balance(spark, sf), _movement(spark, sf),
                                       datetime.date(2000, 12, 31), as_of_strict=True))


# --- sources, sinks, whole runs -------------------------------------------------------------
def s2_product_csv(spark, sf):
    """Product export written as CSV, read back with row positions, staged."""
    path = shared_dir(spark, "product-csv")
    D.raw_product(spark, sf).drop(S.ROW_ID).write.option("header", True).csv(path)
    return T.gold_names(T.stage_product(read_raw(spark, "product", path), D.HOUSE))


def _as_csv(spark, df, purpose):
    path = shared_dir(spark, purpose)
    df.write.option("header", True).csv(path)
    return path


def s3_sales_csv(spark, sf):
    path = _as_csv(spark, D.raw_sales(spark, sf), "sales-csv")
    return T.gold_names(T.stage_sales(read_raw(spark, "sales", path, row_ids="blank"), D.HOUSE))


def s4_balance_csv(spark, sf):
    path = _as_csv(spark, D.raw_balance_wide(spark, sf), "balance-csv")
    raw = read_raw(spark, "stock_balance", path, row_ids="blank")
    return T.gold_names(R.unpivot_balance(raw, D.HOUSE))


def s5_movement_csv(spark, sf):
    path = _as_csv(spark, D.raw_movement(spark, sf), "movement-csv")
    raw = read_raw(spark, "stock_balance_details", path, row_ids="blank")
    return T.gold_names(T.stage_movement(raw, D.HOUSE))


def k3_csv_snapshot(spark, sf):
    """Last movements as a CSV snapshot, read back."""
    path = shared_dir(spark, "snapshot")
    lake.csv_snapshot(a1_last_movement(spark, sf), path)
    return spark.read.option("header", True).schema(
        "product_no string, warehouse string, last_movement_date date").csv(path)


def p2_published_aging(spark, sf):
    """Exports as Parquet files, a full refresh over them, and the published ageing table."""
    src, dst = shared_dir(spark, "exports"), shared_dir(spark, "published")
    lake.side_by_side(spark, [
        partial(df.drop(S.ROW_ID).write.parquet, f"{src}/{TABLES[table]}.parquet",
                compression="zstd")
        for table, df in _raw(spark, sf).items()])
    run_refresh(spark, src, dst, D.RUN_DATE, fmt="parquet", house_category=D.HOUSE)
    return T.gold_names(lake.current(spark, dst, "stg_stock_aging"))


def _stored(spark, sf):
    """The balance and a log of which a third is one pair's, stored by pair."""
    dst = shared_dir(spark, "by-pair")
    written = {}
    for name, df in (("balance", _balance(spark, sf)), ("movement", _hot_movement(spark, sf))):
        df.write.parquet(f"{dst}/plain/{name}")
        written[name] = spark.read.parquet(f"{dst}/plain/{name}")
    stored.write(spark, dst, written, A.KEYS)
    return stored.read(spark, dst)


def _hot_movement(spark, sf):
    return T.stage_movement(D.raw_movement_hot(spark, sf), D.HOUSE)


def a1_stored_last_movement(spark, sf):
    """A1 over buckets."""
    return T.gold_names(_stored(spark, sf).apply(lambda t, _: A.last_movement(t["movement"])))


def t5_stored_aging(spark, sf):
    """J1 and T5 over buckets."""
    return T.gold_names(_stored(spark, sf).apply(lambda t, bucketed: A.stock_ageing(
        t["balance"], t["movement"], D.RUN_DATE, bucketed=bucketed)))


def q3_stored_key_check(spark, sf):
    """Q3 over buckets: pairs that the log repeats."""
    return _stored(spark, sf).apply(
        lambda t, _: Q.key_violations(t["movement"], A.KEYS, "stg_stock_movement"))


def g16_stored_reconcile(spark, sf):
    """G16 over buckets, by closing quantity."""
    return _stored(spark, sf).apply(
        lambda t, _: G.reconcile(T.gold_names(t["balance"]), T.gold_names(t["movement"])))


# --- quality --------------------------------------------------------------------------------
def q1_row_conservation(spark, sf):
    raw = _raw(spark, sf)
    return Q.row_conservation(raw, stage_all(raw, D.RUN_DATE, D.HOUSE))


def q1_content_conservation(spark, sf):
    raw = _raw(spark, sf)
    return Q.content_conservation(raw, stage_all(raw, D.RUN_DATE, D.HOUSE))


def q2_rejected_rows(spark, sf):
    """Exports of which every 50th product has a price that no staged number holds."""
    raw = _raw(spark, sf)
    huge = F.col("`Retail Price`").cast("string")
    raw["product"] = raw["product"].withColumn("Retail Price", F.when(
        F.col(S.ROW_ID) % 50 == 3, F.concat(huge, F.lit("e15"))).otherwise(huge))
    return rejects.split_all(raw)[1].drop("file")


def q2_dq_report(spark, sf):
    return Q.quality_report(_raw(spark, sf))


def q3_key_check(spark, sf):
    """Declared grains, with a product master in which every 50th number repeats another."""
    again = F.when(F.col("product_no").try_cast("int") % 50 == 1, F.lit("0")).otherwise(
        F.col("product_no"))
    product = t1_product(spark, sf).withColumn("product_no", again)
    balance = T.gold_names(_balance(spark, sf)).withColumn("product_no", again)
    return (Q.key_violations(product, ["product_no"], "stg_product")
            .unionByName(Q.key_violations(balance, ["product_no", "warehouse"],
                                          "stg_stock_balance")))


# --- gold -----------------------------------------------------------------------------------
def g1_slow_moving(spark, sf):
    return G.slow_moving(_ageing(spark, sf, recent=True))


def g1_slow_moving_pair(spark, sf):
    return G.slow_moving(_ageing(spark, sf, recent=True), grain="pair")


def g2_aging_profile(spark, sf):
    return G.aging_profile(_ageing(spark, sf))


def g2_aging_profile_by_brand(spark, sf):
    return G.aging_profile(_ageing(spark, sf), by=["brand"])


def g2_aging_cube(spark, sf):
    return G.aging_cube(_ageing(spark, sf))


def g3_exec_kpi(spark, sf):
    return G.exec_kpi(_ageing(spark, sf), _sales(spark, sf, TREND_COLUMNS))


def g4_sales_trend(spark, sf):
    return G.sales_trend(_sales(spark, sf, TREND_COLUMNS))


def g4_sales_trend_daily(spark, sf):
    return G.sales_trend(_sales(spark, sf, TREND_COLUMNS), grain="day")


def g5_channel_split(spark, sf):
    return G.channel_split(_sales(spark, sf, CHANNEL_COLUMNS))


def g6_segment(spark, sf):
    """The house-category page."""
    return G.segment(_ageing(spark, sf), _sales(spark, sf, BRAND_COLUMNS),
                     categories_in=[D.HOUSE])


def g6_segment_others(spark, sf):
    """A page of two categories without the house category."""
    return G.segment(_ageing(spark, sf), _sales(spark, sf, BRAND_COLUMNS),
                     categories_in=["SMALL", "LARGE", D.HOUSE], exclude_categories=[D.HOUSE])


def g6_segment_brands(spark, sf):
    """A page of chosen brands."""
    return G.segment(_ageing(spark, sf), _sales(spark, sf, BRAND_COLUMNS),
                     brands_in=["BRAND#3", "BRAND#12", "SMALL - UNBRANDED"])


def g7_days_of_cover(spark, sf):
    return G.days_of_cover(T.gold_names(_balance(spark, sf)), _sales(spark, sf, BRAND_COLUMNS),
                           D.RUN_DATE)


def g8_stock_status(spark, sf):
    return G.stock_status(g7_days_of_cover(spark, sf))


def g8_stock_status_sku(spark, sf):
    return G.stock_status(G.days_of_cover(
        T.gold_names(_balance(spark, sf)), _sales(spark, sf, TREND_COLUMNS), D.RUN_DATE,
        by="product_no"))


def _sales_up_to_now(spark, sf):
    """Sales of which brands and products differ in how much falls into the last 30 days.

    The brand's number is exploded from an array of one, so that it stays a column: a filter on
    the date would be pushed below the cleaning otherwise, with all of that written out in it
    for every mention of the brand.
    """
    number_of = F.coalesce(F.split_part("brand", F.lit("#"), F.lit(2)).try_cast("int"), F.lit(0))
    sales = _sales(spark, sf, BRAND_COLUMNS)
    names, brand = sales.columns, F.col("_brand")
    number = F.col("product_no").cast("int")
    back = F.when(brand % 11 == 5, 60).when((brand % 4 == 1) & (number % 10 != 0), 60) \
        .otherwise(number % 30)
    return sales.select("*", F.explode(F.array(number_of)).alias("_brand")).withColumns({
        "date": F.date_sub(F.lit(D.RUN_DATE), back),
        "qty": F.col("qty") * F.when(brand % 4 == 0, 2).otherwise(1)}).select(*names)


def g8_stock_status_all_classes(spark, sf):
    return G.stock_status(G.days_of_cover(T.gold_names(_balance(spark, sf)),
                                          _sales_up_to_now(spark, sf), D.RUN_DATE))


def g8_stock_status_sku_all_classes(spark, sf):
    return G.stock_status(G.days_of_cover(
        T.gold_names(_balance(spark, sf)), _sales_up_to_now(spark, sf), D.RUN_DATE,
        by="product_no"))


def g9_mgmt_alert(spark, sf):
    return G.management_alert(_ageing(spark, sf), D.HOUSE)


def g10_dim_date(spark, sf):
    return star.dim_date(_sales(spark, sf, ("Date",)), _ageing(spark, sf))


def _dim(spark, sf, name, *columns):
    # Report column only: the 64-bit hash of the key is Spark's own. The balance holds the same
    # members as the ageing table built on it.
    return star.dim(name, _sales(spark, sf, columns), T.gold_names(_balance(spark, sf))).select(name)


def g11_dim_brand(spark, sf):
    return _dim(spark, sf, "brand", "Brand", "Tier 1 Category")


def g12_dim_warehouse(spark, sf):
    return _dim(spark, sf, "warehouse", "Warehouse")


def g13_dim_category(spark, sf):
    return _dim(spark, sf, "category", "Tier 1 Category")


def _without_hashes(fact):
    return fact.drop(*[f"{d}_key" for d in star.DIMENSIONS])


def g14_fact_sales(spark, sf):
    return _without_hashes(star.fact_sales(_sales(spark, sf))).select(
        "date_key", "date", "product_no", "brand", "warehouse", "category", "channel", "amount",
        "qty", "cost", "profit")


def g15_fact_stock_aging(spark, sf):
    return _without_hashes(star.fact_stock_aging(_ageing(spark, sf))).select(
        "date_key", "product_no", "brand", "warehouse", "category", "stock_on_hand",
        "asset_value", "age_days", "aging_bucket", "aging_status", "is_aged")


def g15_star_keys(spark, sf):
    """Both facts joined to their dimensions by key."""
    sales, aged = _sales(spark, sf, BRAND_COLUMNS + ("Warehouse",)), _ageing(spark, sf)
    dims = {d: star.dim(d, sales, aged) for d in star.DIMENSIONS}
    facts = {"fact_sales": star.fact_sales(sales), "fact_stock_aging": star.fact_stock_aging(aged)}
    parts = [star.key_check(f, dims).select(F.lit(n).alias("fact"), "*") for n, f in facts.items()]
    return parts[0].unionByName(parts[1])


def g16_reconcile(spark, sf):
    return G.reconcile(T.gold_names(_balance(spark, sf)), T.gold_names(_movement(spark, sf)),
                       mode="net")


def g16_reconcile_closing(spark, sf):
    return G.reconcile(T.gold_names(_balance(spark, sf)), T.gold_names(_movement(spark, sf)))


def g16_reconcile_closing_gaps(spark, sf):
    """Some latest movements have no closing quantity."""
    log = T.gold_names(T.stage_movement(D.raw_movement_mixed(spark, sf), D.HOUSE))
    return G.reconcile(T.gold_names(_balance(spark, sf)), log)


def g16_first_divergence(spark, sf):
    """Over a log whose closings miss some quantities, a third of it one pair's."""
    log = T.gold_names(T.stage_movement(D.raw_movement_kept(spark, sf), D.HOUSE))
    return G.first_divergence(log, shared_dir(spark, "sorted-log"))


def g17_orphans(spark, sf):
    return G.orphans(t1_product(spark, sf), stg_sales=_sales(spark, sf, ()),
                     stg_stock_balance=T.gold_names(_balance(spark, sf)),
                     stg_stock_movement=T.gold_names(_movement(spark, sf)))


def g18_top_brands(spark, sf):
    return G.top_n(T.gold_names(_balance(spark, sf)), "brand", F.col("asset_value"))


def g18_top_skus_aged(spark, sf):
    aged = F.when(F.col("is_aged"), F.col("asset_value"))
    return G.top_n(_ageing(spark, sf), "product_no", aged, n=25)


def g18_top_skus_per_brand(spark, sf):
    return G.top_n_per_group(_sales(spark, sf, BRAND_COLUMNS), "brand", "product_no",
                             F.col("amount"))


# --- streams and run-date series ------------------------------------------------------------
def x1_streaming_last_movement(spark, sf):
    table, mark = shared_dir(spark, "last-movement"), shared_dir(spark, "checkpoint")
    log = D.raw_movement(spark, sf, lines=D.lineitem_stream(spark, sf))
    X.run_available(X.moving_last_movement(T.stage_movement(log, D.HOUSE)), table, mark)
    return T.gold_names(X.latest_movements(spark, table))


def x3_closed_channel_days(spark, sf):
    """Batches in the order of the order keys, so that many rows come after their day has closed."""
    dst, mark, path = (shared_dir(spark, p) for p in ("closed-days", "checkpoint", "lines"))
    kind = D.SCHEMAS["lineitem"]
    D.table(spark, sf, "lineitem").withColumn("part", F.expr("cast(l_orderkey % 4 AS int)")) \
        .write.partitionBy("part").parquet(f"{path}/parts")
    for k in range(4):
        spark.read.schema(f"{kind}, part int").parquet(f"{path}/parts").where(F.col("part") == k) \
            .drop("part").write.mode("append").parquet(f"{path}/arrived")
        lines = spark.readStream.schema(kind).parquet(f"{path}/arrived")
        X.run_closed_days(_shipped(lines), dst, mark, 30, buckets=4)
    return X.closed_days(spark, dst, 30)


def x2_asof_series(spark, sf):
    return A.asof_series(_balance(spark, sf), _movement(spark, sf), AS_OF_DATES)


def x2_asof_weekly(spark, sf):
    """400 run dates, from before the first movement on."""
    first = datetime.date(1994, 1, 1)
    return A.asof_series(_balance(spark, sf), _movement(spark, sf),
                         [first + datetime.timedelta(days=7 * k) for k in range(400)])


def x3_streaming_channel_days(spark, sf):
    table, mark = shared_dir(spark, "channel-days"), shared_dir(spark, "checkpoint")
    sales = _sales(spark, sf, CHANNEL_COLUMNS, D.lineitem_stream(spark, sf))
    X.run_available(X.channel_days(sales), table, mark)
    return X.latest_channel_days(spark, table)


def _deliveries(spark, sf, run, n=4):
    """lineitem as a stream that arrives in the order of the ship dates; `run` takes each arrival.

    The parts are written in one pass, lines without a date to one of their own, which comes
    first. A part is then many files that arrive together, so a batch is as many tasks.
    """
    path, kind = shared_dir(spark, "lines"), D.SCHEMAS["lineitem"]
    lines = D.table(spark, sf, "lineitem")
    lo, hi = lines.agg(F.min("l_shipdate"), F.max("l_shipdate")).first()
    part = F.lit(0)
    if lo is not None:
        days = F.datediff("l_shipdate", F.lit(lo)) / ((hi - lo).days + 1)
        part = F.coalesce(F.floor(days * n) + 1, F.lit(0))
    lines.withColumn("part", part.cast("int")).write.partitionBy("part").parquet(f"{path}/parts")
    for k in range(n + 1):
        spark.read.schema(f"{kind}, part int").parquet(f"{path}/parts").where(F.col("part") == k) \
            .drop("part").write.mode("append").parquet(f"{path}/arrived")
        run(spark.readStream.schema(kind).parquet(f"{path}/arrived"))


def x1_folded_last_movement(spark, sf):
    """Ten batches, each upserted into one keyed table that keeps the maxima."""
    dst, mark = shared_dir(spark, "last-state"), shared_dir(spark, "checkpoint")

    def run(lines):
        log = T.stage_movement(D.raw_movement(spark, sf, lines=lines), D.HOUSE)
        X.run_folded(log, dst, mark, A.KEYS, "append", ["Last Movement Date"], A.last_movement,
                     buckets=8)

    _deliveries(spark, sf, run, 9)
    return T.gold_names(X.folded(spark, dst))


def x3_folded_channel_days(spark, sf):
    """Sums per ship day and channel, five batches upserted into one keyed table."""
    dst, mark = shared_dir(spark, "days-state"), shared_dir(spark, "checkpoint")
    _deliveries(spark, sf, lambda lines: X.run_folded(
        X.channel_days(_shipped(lines)), dst, mark, ["day", "channel"], buckets=4))
    return X.folded(spark, dst)


def _shipped(lines):
    return lines.select(
        F.col("l_shipdate").cast("date").alias("date"), F.col("l_returnflag").alias("channel"),
        *[F.col("l_quantity").cast("decimal(18,4)").alias(c) for c in ("amount", "qty", "profit")])


def x3_watermarked_channel_days(spark, sf):
    """Tumbling days behind a watermark of 30 days: days that are over by then, each once."""
    table, mark = shared_dir(spark, "final-days"), shared_dir(spark, "checkpoint")
    _deliveries(spark, sf, lambda lines: X.run_available(
        X.channel_days(_shipped(lines), "30 days"), table, mark, mode="append"))
    return spark.read.parquet(table).drop(X.BATCH)


def queries() -> dict[str, Query]:
    found = [c2_clean_category, c3_clean_brand, c4_product_no, c4_product_no_unpivoted,
             c4_sales_blank_numbers, c4_movement_blank_numbers, s3_sales_csv, s4_balance_csv,
             s5_movement_csv, t4_movement_mixed, a1_last_movement_bad_dates,
             g8_stock_status_all_classes, g8_stock_status_sku_all_classes, g15_star_keys,
             g16_reconcile_closing_gaps, x1_folded_last_movement, x3_folded_channel_days,
             x3_watermarked_channel_days, c5_clean_text, c6_parse_date, c7_numeric, t1_product, t2_sales, t3_unpivot_balance,
             t3_unpivot_two_warehouses, t4_movement, a1_last_movement, t5_stock_aging,
             t5_stock_aging_strict, s2_product_csv, k3_csv_snapshot, p2_published_aging,
             q1_row_conservation, q2_dq_report, q3_key_check, g1_slow_moving,
             g1_slow_moving_pair, g2_aging_profile, g2_aging_profile_by_brand, g2_aging_cube,
             g3_exec_kpi, g4_sales_trend, g4_sales_trend_daily, g5_channel_split, g6_segment,
             g6_segment_others, g6_segment_brands, g7_days_of_cover, g8_stock_status,
             g8_stock_status_sku, g9_mgmt_alert, g10_dim_date, g11_dim_brand,
             g12_dim_warehouse, g13_dim_category, g14_fact_sales, g15_fact_stock_aging,
             g16_reconcile, g16_reconcile_closing, g17_orphans, g18_top_brands,
             g18_top_skus_aged, g18_top_skus_per_brand, x1_streaming_last_movement,
             q1_content_conservation, q2_rejected_rows, g16_first_divergence,
             x3_closed_channel_days, a1_stored_last_movement, t5_stored_aging, q3_stored_key_check,
             g16_stored_reconcile, x2_asof_series, x2_asof_weekly, x3_streaming_channel_days]
    return {f.__name__: f for f in found}

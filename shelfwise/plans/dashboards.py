"""All report tables of the eight dashboard pages, from the staged tables."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise import schemas as S
from shelfwise.functions.dates import MONTH
from shelfwise.operators.staging import gold_names
from shelfwise.plans import gold as G
from shelfwise.plans import star


def gold_tables(staged: dict[str, DataFrame], run_date: datetime.date,
                house_category: str = S.HOUSE_CATEGORY,
                pages: dict[str, dict] | None = None) -> dict[str, DataFrame]:
    """Report name -> plan. Pass written staged tables, which all reports then scan.

    `pages` adds a segment per entry, as arguments of `gold.segment_rows`, for example
    {"phones": {"categories_in": ["PHONES"]}, "solar": {"brands_in": ["BRAND A", "BRAND B"]},
    "accessories": {"categories_in": ["ACCESSORIES"], "exclude_categories": ["HOUSE"]}}.
    Sales that come with their month column let the days of cover read its folders only.
    """
    product, sales, balance, movement, ageing = (
        gold_names(staged[t]) for t in ("stg_product", "stg_sales", "stg_stock_balance",
                                        "stg_stock_movement", "stg_stock_aging"))
    cover = G.days_of_cover(ageing, sales, run_date)
    cover_sku = G.days_of_cover(ageing, sales, run_date, by="product_no")
    sales, movement = sales.drop(MONTH), movement.drop(MONTH)
    reports = {
        "exec_kpi": G.exec_kpi(ageing, sales),
        "sales_trend": G.sales_trend(sales),
        "sales_trend_daily": G.sales_trend(sales, grain="day"),
        "channel_split": G.channel_split(sales),
        "brand_health": G.slow_moving(ageing),
        "brand_health_pairs": G.slow_moving(ageing, grain="pair"),
        "aging_profile": G.aging_profile(ageing),
        "aging_by_dimension": G.aging_cube(ageing),
        "stock_status_brand": G.stock_status(cover),
        "stock_status_sku": G.stock_status(cover_sku),
        "management_alert": G.management_alert(ageing, house_category),
        "reconciliation": G.reconcile(ageing, movement),
        "orphans": G.orphans(product, stg_sales=sales, stg_stock_balance=balance,
                             stg_stock_movement=movement),
        "top_brands": G.top_n(ageing, "brand", F.col("asset_value")),
        "top_skus_aged": G.top_n(ageing, "product_no",
                                 F.when(F.col("is_aged"), F.col("asset_value"))),
        "dim_date": star.dim_date(sales, ageing),
        **{f"dim_{d}": star.dim(d, sales, ageing) for d in star.DIMENSIONS},
        "fact_sales": star.fact_sales(sales),
        "fact_stock_aging": star.fact_stock_aging(ageing),
    }
    house = {"categories_in": [house_category.strip().upper()]}
    for page, pick in {"house": house, **(pages or {})}.items():
        reports[f"segment_{page}"] = G.segment(ageing, sales, **pick)
        reports[f"aging_{page}"] = G.aging_profile(G.segment_rows(ageing, **pick), by=["brand"])
        reports[f"channels_{page}"] = G.channel_split(G.segment_rows(sales, **pick))
    return reports

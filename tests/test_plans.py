"""What the plans of the registered queries must and must not contain."""

import re

import pytest

from shelfwise.registry import queries

SF = "/root/testdata/sf0.001"
EAGER = {"s2_product_csv", "k3_csv_snapshot", "p2_published_aging", "x1_streaming_last_movement",
         "x3_streaming_channel_days", "s3_sales_csv", "s4_balance_csv", "s5_movement_csv",
         "x1_folded_last_movement", "x3_folded_channel_days", "x3_watermarked_channel_days",
         "a1_stored_last_movement", "t5_stored_aging", "q3_stored_key_check",
         "g16_stored_reconcile", "g16_first_divergence", "x3_closed_channel_days"}
QUERIES = {n: f for n, f in queries().items() if n not in EAGER}


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def columns_read(text, table):
    found = set()
    for scan in re.findall(r"FileScan parquet \[[^\]]*\].*?ReadSchema: struct<([^>]*)>", text):
        names = {c.split(":")[0] for c in scan.split(",") if c}
        if names and all(n.startswith(table) for n in names):
            found |= names
    return found


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairs_and_no_python(spark, name):
    text = plan(spark, name)
    for banned in ("CartesianProduct", "NestedLoop", "EvalPython", "MapInPandas", "FlatMapGroups",
                   "CollectLimit", "collect_list", "collect_set"):
        assert banned not in text


def test_only_needed_columns_are_read(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        assert columns_read(plan(spark, "a1_last_movement"), "l_") == {
            "l_partkey", "l_suppkey", "l_shipdate"}
        assert columns_read(plan(spark, "g17_orphans"), "l_") == {
            "l_partkey", "l_suppkey"}
        trend = plan(spark, "g4_sales_trend")
        assert columns_read(trend, "l_") == {"l_orderkey", "l_partkey", "l_quantity",
                                             "l_extendedprice", "l_discount"}
        assert columns_read(trend, "o_") == {"o_orderkey", "o_orderdate"}
        assert "customer" not in trend and "supplier" not in trend
        stock = plan(spark, "g18_top_brands")
        assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,O)" in stock
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_orphans_shuffle_counts_only(spark):
    """Every source is counted per task ahead of the one shuffle by product; nothing is sorted."""
    from pyspark.sql import functions as F
    from shelfwise.plans import gold as G
    rows = spark.range(100).select((F.col("id") % 7).cast("string").alias("product_no"))
    df = G.orphans(rows.where("product_no < '5'"), a=rows, b=rows.where("product_no > '4'"))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "Sort " not in text and text.count("Exchange") == 1
    assert "partial_sum" in text[text.index("Exchange"):]
    assert {tuple(r) for r in df.collect()} == {("a", "5", 14), ("a", "6", 14), ("b", "5", 14),
                                                ("b", "6", 14)}
    assert "LeftAnti" not in plan(spark, "g17_orphans")


def test_orphans_without_a_number(spark):
    from shelfwise.plans import gold as G
    master = spark.createDataFrame([(None,), ("a",)], "product_no string")
    used = spark.createDataFrame([(None,), (None,), ("a",), ("b",)], "product_no string")
    assert {tuple(r) for r in G.orphans(master, s=used, t=master).collect()} == {
        ("s", None, 2), ("s", "b", 1), ("t", None, 1)}
    assert G.orphans(master, s=used.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["g8_stock_status_all_classes", "g8_stock_status_sku_all_classes"])
def test_days_are_not_filtered_below_the_cleaning(spark, name):
    """The brand a date is made from is cleaned once per row, not for every mention in a filter."""
    text = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    filters = [f.split("\n")[0] for f in text.split("Filter ")[1:]]
    assert filters and not any("trim(" in f or "split" in f for f in filters)


def test_windows_rank_bounded_rows_only(spark):
    """Per-group ranks are cut before the shuffle; global ones run over the n rows that are left."""
    assert plan(spark, "g18_top_skus_per_brand").count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan(spark, "g18_top_brands")


def test_distinct_counts_do_not_multiply_rows(spark):
    for name in ("g1_slow_moving", "g2_aging_profile", "g3_exec_kpi"):
        assert "Expand" not in plan(spark, name)
    cube = plan(spark, "g2_aging_cube")
    assert cube.count("Expand") == 1
    below = cube[cube.index("Expand"):]
    assert "bitmap_construct_agg" in below.split("Exchange")[1]  # the sets multiply cells, not rows


def test_only_blank_numbers_meet_row_offsets(spark, tmp_path):
    """The bulk rows are one scan without join or exchange; nothing is broadcast by a hint."""
    from pyspark.sql import functions as F
    from shelfwise.sources.row_ids import with_row_ids
    spark.range(0, 1000, 1, 4).write.parquet(str(tmp_path / "t"))
    df = with_row_ids(spark.read.parquet(str(tmp_path / "t")), where=F.col("id") == 7)
    text = df._jdf.queryExecution().executedPlan().toString()
    bulk = text[text.index("Union"):].split(":- ")[1].split("+- ")
    assert bulk[0].lstrip().startswith("Project") and not any(
        w in part for part in bulk[:3] for w in ("Exchange", "Join"))
    assert "ResolvedHint" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_days_read_only_their_months(spark, tmp_path):
    import datetime
    from pyspark.sql import functions as F
    from shelfwise.functions.dates import in_days
    from shelfwise.sinks import lake
    from shelfwise.operators.ageing import last_movement
    path = str(tmp_path / "t")
    days = spark.range(400).select(
        F.date_add(F.lit(datetime.date(2000, 1, 1)), F.col("id").cast("int")).alias("Date"),
        F.lit("p").alias("Product No."), F.lit("w").alias("Warehouse"))
    lake.write_table(days, path, month_of="Date")
    written = lake.read_table(spark, path, months=True)
    for df, n in ((in_days(written, "Date", datetime.date(2000, 3, 10), datetime.date(2000, 4, 9)), 30),
                  (last_movement(written, datetime.date(2000, 2, 1)), 1)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "month_of_date" in text.split("PartitionFilters: [")[1].split("]")[0]
        assert df.count() == n and "month_of_date" not in df.columns

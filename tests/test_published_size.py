"""What a published run moves: months and the ageing table stay in their tasks, keys move bare."""

import datetime
import os
import re

import pytest
from pyspark.sql import functions as F

from shelfwise import schemas as S
from shelfwise.functions.contents import content, row_hashes
from shelfwise.operators import ageing as A
from shelfwise.operators import quality as Q
from shelfwise.plans import refresh
from shelfwise.sinks import lake
from shelfwise.sources import driver_tables as D
from shelfwise.sources.exports import TABLES

DAY = datetime.date(2024, 3, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def dated(spark, months, tasks=3):
    day = F.add_months(F.lit(datetime.date(2020, 1, 5)), (F.col("id") % months).cast("int"))
    return spark.range(0, 600, 1, tasks).select(
        F.when(F.col("id") % 7 != 0, day).alias("Date"), F.col("id").alias("n"))


def setting(spark):
    return spark.conf.get(lake.WRITERS, "0")


def test_months_are_written_where_their_rows_are(spark, tmp_path):
    df, path, before = dated(spark, 2), str(tmp_path / "t"), setting(spark)
    lake.write_table(df, path, month_of="Date", codec="zstd")
    files = {m: [f for f in os.listdir(f"{path}/{m}") if f.endswith(".parquet")]
             for m in os.listdir(path) if m.startswith("month_of_date=")}
    assert len(files) == 3  # two months and no date
    assert all(len(f) == 3 and all(".zstd." in x for x in f) for f in files.values())
    assert sorted(map(tuple, lake.read_table(spark, path).collect()), key=repr) == sorted(
        map(tuple, df.collect()), key=repr)
    assert setting(spark) == before


def test_more_months_than_files_may_be_open(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lake, "OPEN_MONTHS", 2)
    df, path = dated(spark, 11), str(tmp_path / "t")
    lake.write_table(df, path, month_of="Date")
    back = spark.read.parquet(path)
    assert back.exceptAll(back.where("month_of_date <=> date_format(Date, 'yyyy-MM')")).isEmpty()
    assert sorted(r.n for r in back.collect()) == list(range(600))


def test_setting_returns_after_the_last_write(spark):
    before = setting(spark)
    with pytest.raises(RuntimeError), lake._months_open(spark):
        with lake._months_open(spark):
            assert setting(spark) == str(lake.OPEN_MONTHS)
        assert setting(spark) == str(lake.OPEN_MONTHS)
        raise RuntimeError
    assert setting(spark) == before
    try:
        spark.conf.set(lake.WRITERS, "7")
        with lake._months_open(spark):
            assert setting(spark) == "7"
        assert setting(spark) == "7"
    finally:
        spark.conf.set(lake.WRITERS, before)


def test_clustered_in_place(spark, tmp_path):
    df = spark.range(0, 600, 1, 3).select(
        F.concat(F.lit("b"), F.col("id") % 2).alias("Brand"), F.col("id").alias("n"))
    lake.write_table(df, str(tmp_path / "t"), cluster_by=["Brand", "n"], in_place=True)
    files = [f for f in os.listdir(tmp_path / "t") if f.endswith(".parquet")]
    assert len(files) == 3
    for f in files:
        rows = [tuple(r) for r in spark.read.parquet(str(tmp_path / "t" / f)).collect()]
        assert len(rows) == 200 and rows == sorted(rows)
    assert lake.layout("stg_stock_aging")["in_place"]
    assert not lake.layout("stg_stock_balance")["in_place"]


def stock(spark):
    rows = [("p", "w", 1), ("p", "w", 2), ("p", "v", 3), (None, "w", 4), ("q", None, 5), ("q", "w", 6)]
    balance = spark.createDataFrame(rows, "`Product No.` string, Warehouse string, n int")
    log = spark.createDataFrame(
        [("p", "w", DAY), ("p", "w", datetime.date(2024, 2, 1)), (None, "w", DAY), ("q", "w", None)],
        "`Product No.` string, Warehouse string, Date date")
    return balance, log


def test_ageing_join_moves_no_hash(spark):
    balance, log = stock(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = A._join_last(balance, A.last_movement(log))
        text = plan(joined)
        got = {r.n: r["Last Movement Date"] for r in joined.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert joined.columns == ["Product No.", "Warehouse", "n", "Last Movement Date"]
    assert got == {1: DAY, 2: DAY, 3: None, 4: None, 5: None, 6: None}
    join = next(line for line in text.splitlines() if "SortMergeJoin" in line)
    assert "xxhash64" in join  # own exchanges on both sides, so that AQE may split a pair
    assert text.count("Exchange hashpartitioning") == 3
    assert not re.search(r"xxhash64\([^)]*\) AS ", text)


def test_keys_of_ageing_counted_with_those_of_balance(spark):
    balance, _ = stock(spark)
    product = spark.createDataFrame([("p",), ("p",), ("q",)], "`Product No.` string")
    staged = {"stg_product": product, "stg_stock_balance": balance,
              "stg_stock_aging": balance.withColumn("age", F.lit(1))}
    once, apart = Q.declared_keys(staged, ageing_checked=True), Q.declared_keys(staged)
    assert once.columns == apart.columns
    assert plan(once).count("Exchange") == 2 and plan(apart).count("Exchange") == 3
    want = sorted(map(tuple, apart.collect()))
    assert sorted(map(tuple, once.collect())) == want
    assert {t for t, _, _ in want} == {"stg_product", "stg_stock_balance", "stg_stock_aging"}


def test_channel_is_made_before_lines_meet_their_orders(spark, tmp_path):
    sf = str(tmp_path)
    rows = {
        "lineitem": [(1, 5, 1, 1, 2.0, 3.0, 0.05, 0.0, "R", "O", None),
                     (2, 5, 1, 1, 2.0, 3.0, 0.05, 0.0, "N", "O", None),
                     (3, 5, 1, 1, 2.0, 3.0, 0.05, 0.0, "N", "O", None),
                     (9, 5, 1, 1, 2.0, 3.0, 0.05, 0.0, "N", "O", None)],
        "orders": [(1, 17, "O", 1.0, None, "x"), (2, 4, "O", 1.0, None, "x"),
                   (3, None, "O", 1.0, None, "x")],
        "customer": [(17, "c", 1, 0.0, "BUILDING"), (4, "d", 1, 0.0, "BUILDING")],
    }
    for name, data in rows.items():
        spark.createDataFrame(data, D.SCHEMAS[name]).write.parquet(f"{sf}/{name}.parquet")
    sales = D.raw_sales(spark, sf, ("Date", "Sales Channels"))
    assert sorted((r["Sales Channels"] for r in sales.collect()), key=repr) == [
        " ", " building", None, None]
    assert S.ROW_ID not in sales.columns
    lines = sales._jdf.queryExecution().optimizedPlan().toString().split("LeftOuter, (l_orderkey")[1]
    assert "o_channel" in lines.split("Join LeftOuter")[0]


def test_open_months_hold_small_dictionaries(spark, tmp_path):
    pq = pytest.importorskip("pyarrow.parquet")
    df = spark.range(0, 24_000, 1, 1).select(
        F.lit(DAY).alias("Date"), (F.col("id") % 6000).alias("many"), (F.col("id") % 5).alias("few"))
    lake.write_table(df, str(tmp_path / "t"), month_of="Date", codec="zstd")
    (name,) = [f for f in os.listdir(tmp_path / "t" / "month_of_date=2024-03") if f.endswith(".parquet")]
    group = pq.ParquetFile(tmp_path / "t" / "month_of_date=2024-03" / name).metadata.row_group(0)
    held = {c.path_in_schema: c.has_dictionary_page for c in map(group.column, range(group.num_columns))}
    assert held["few"] and not held["many"]  # 48 KB of values are over, five are not
    assert spark.read.parquet(str(tmp_path / "t")).groupBy("many").count().where("count = 4").count() == 6000


def exports(spark, src, number):
    texts = lambda names: ", ".join(f"`{n}` string" for n in names)
    for table, stem in TABLES.items():
        names = [*S.RAW_REQUIRED[table], *(["A- Stock on Hand"] if table == "stock_balance" else [])]
        rows = [tuple(number if n in ("Product No.", "Product NO.") and table == "sales" else
                      {"Date": "01/02/2024", "A- Stock on Hand": "3"}.get(n, "7") for n in names),
                tuple({"Date": "31/02/2024"}.get(n, "8") for n in names)]
        spark.createDataFrame(rows, texts(names)).coalesce(1).write.parquet(f"{src}/{stem}.parquet")


@pytest.mark.parametrize("number, placed", [("7", set()), (" nan ", {"sales"}), (None, {"sales"})])
def test_positions_only_where_a_number_is_blank(spark, tmp_path, monkeypatch, number, placed):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    exports(spark, src, number)
    seen, stage_all = {}, refresh.stage_all
    monkeypatch.setattr(refresh, "stage_all", lambda raw, *args: seen.update(raw) or stage_all(raw, *args))
    refresh.run_refresh(spark, src, dst, DAY, fmt="parquet")
    assert {n for n, df in seen.items() if S.ROW_ID in df.columns} == placed
    numbers = {r[0] for r in lake.current(spark, dst, "stg_sales").select("`Product NO.`").collect()}
    assert numbers == {"8", "UNSPECIFIED-0" if placed else "7"}


def test_sums_of_hashes_are_those_of_decimals(spark):
    # Sums of 64-bit hashes pass a long, on either side.
    df = spark.range(300).select((F.col("id") % 3).alias("k"), F.col("id").alias("a"),
                                 F.when(F.col("id") % 2 == 0, "x").alias("b"))
    rows = df.select("k", *[h.alias(n) for h, n in zip(row_hashes(F.col("a"), F.col("b")), "gh", strict=True)])
    want = {k: [0, 0, 0] for k in range(3)}
    for r in rows.collect():
        want[r.k] = [want[r.k][0] + 1, want[r.k][1] + r.g, want[r.k][2] + r.h]
    got = content(df, "k")
    assert {r.k: (r.rows, r.mark) for r in got.collect()} == {
        k: (n, f"{g}:{h}") for k, (n, g, h) in want.items()}
    assert any(abs(v) >= 2 ** 63 for _, *sums in want.values() for v in sums)
    assert [tuple(r) for r in content(df.limit(0).drop("k")).collect()] == [(0, "0:0")]
    assert "as decimal(20,0))), sum(" not in plan(got) and "partial_sum(cast(" not in plan(got)


def test_cells_of_many_warehouses_stay_compiled(spark):
    names = [*S.RAW_REQUIRED["stock_balance"], *[f"W{i}- Stock on Hand" for i in range(25)],
             *[f"W{i}-Inventory Asset Value" for i in range(24)]]
    row = ("7",) * 6 + tuple(str(i) for i in range(25)) + ("1.5",) * 23 + ("x",)
    sheet = spark.createDataFrame([row], ", ".join(f"`{n}` string" for n in names))
    cells = Q._carried_cells(sheet)
    got = {r.Warehouse: tuple(r)[5:] for r in cells.collect()}
    assert len(got) == 25 and got["W3"] == (3, None, 1.5) and got["W23"] == (23, None, None)
    assert got["W24"] == (24, None, None)
    sizes = []
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else the plan shows no code ahead of its run
    try:
        parts = content(cells)._jdf.queryExecution().debug().codegenToSeq().iterator()
        while parts.hasNext():
            sizes.append(parts.next()._3().maxMethodCodeSize())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and max(sizes) < 8000  # the JVM compiles no larger method


def test_cells_of_several_types(spark):
    names = [*S.RAW_REQUIRED["stock_balance"], "A- Stock on Hand", "A-Unit Cost", "B- Stock on Hand"]
    kinds = ["string"] * 6 + ["double", "decimal(18,4)", "string"]
    sheet = spark.createDataFrame([("7",) * 6 + (2.5, None, "n/a")],
                                  ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds, strict=True)))
    assert sorted(tuple(r)[4:] for r in Q._carried_cells(sheet).collect()) == [
        ("A", 2.5, None, None), ("B", 0, None, None)]

"""Sinks, whole runs and streams."""

import csv
import datetime
import os

import pytest
from pyspark.sql import functions as F

from shelfwise import schemas as S
from shelfwise.operators import ageing as A
from shelfwise.operators import staging as T
from shelfwise.plans import gold as G
from shelfwise.plans.refresh import run_refresh
from shelfwise.sinks import jdbc, lake
from shelfwise.streaming import incremental as X

DATE = datetime.date
RUN = DATE(2024, 3, 1)


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- sinks ----------------------------------------------------------------------------------
def test_publish_switches_all_tables_at_once(spark, base):
    one, two = spark.range(3).toDF("x"), spark.range(5).toDF("x")
    first = lake.publish(spark, {"a": one, "b": two}, base)
    assert lake.current_version(spark, base) == first
    assert lake.current(spark, base, "b").count() == 5

    def refuse(written):
        assert written["a"].count() == 5
        raise RuntimeError("not good")

    with pytest.raises(RuntimeError):
        lake.publish(spark, {"a": two, "b": one}, base, check=refuse)
    assert lake.current(spark, base, "a").count() == 3
    second = lake.publish(spark, {"a": two, "b": one}, base, snapshots=True)
    assert second != first and lake.current(spark, base, "a").count() == 5
    parts = [f for f in os.listdir(f"{base}/{second}/a_csv") if f.endswith(".csv")]
    assert parts and open(f"{base}/{second}/a_csv/{parts[0]}").readline() == "x\n"


def test_nothing_published(spark, base):
    lake.commit(spark, base, "v1")
    assert lake.current_version(spark, base) == "v1"
    lake.commit(spark, base, "v2")
    assert lake.current_version(spark, base) == "v2"


def test_month_layout_keeps_undated_rows(spark, base):
    df = spark.createDataFrame([(DATE(2024, 1, 5), 1), (DATE(2024, 1, 9), 2), (None, 3)],
                               "Date date, n int")
    lake.write_table(df, f"{base}/t", month_of="Date")
    back = lake.read_table(spark, f"{base}/t")
    assert back.columns == ["Date", "n"] and rows(back) == rows(df)
    january = spark.read.parquet(f"{base}/t").where("month_of_date = '2024-01'")
    assert january.count() == 2 and len(january.inputFiles()) >= 1
    assert "month_of_date=2024-01" in os.listdir(f"{base}/t")


def test_hot_month_and_hot_brand_are_spread(spark, base):
    """A third of the rows in one month or brand must not end up in one file."""
    hot = (F.col("id") % 3 == 0)
    df = spark.range(0, 90000, 1, 6).select(
        F.when(hot, F.lit("2024-01-05")).otherwise(F.lit("2023-01-05")).cast("date").alias("Date"),
        F.when(hot, F.lit("HOT")).otherwise(F.concat(F.lit("b"), F.col("id") % 50)).alias("Brand"),
        F.col("id").cast("string").alias("Product No."), F.md5(F.col("id").cast("string")).alias("m"))
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "65536",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        lake.write_table(df, f"{base}/m", month_of="Date")
        lake.write_table(df, f"{base}/b", cluster_by=["Brand", "Product No."])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    month = [f for f in os.listdir(f"{base}/m/month_of_date=2024-01") if f.endswith(".parquet")]
    assert len(month) > 1
    per_file = (spark.read.parquet(f"{base}/b").where("Brand = 'HOT'")
                .groupBy(F.col("_metadata.file_path")).count().collect())
    assert len(per_file) > 1 and sum(r["count"] for r in per_file) == 30000


class _Writer:
    """Stands in for a database: records what a JDBC write is asked to do."""

    def __init__(self, seen, stored):
        self.seen, self.stored = seen, stored
        self.write = self.sparkSession = self.read = self

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **kw):
        self.seen.update(kw)
        return self

    def mode(self, mode):
        self.seen["mode"] = mode
        return self

    def save(self):
        self.seen["saved"] = True

    def load(self):
        return _Writer(self.seen, self.stored[1:])

    def count(self):
        return self.stored[0]


def test_jdbc_options_and_count_check():
    seen = {}
    jdbc.load_table(_Writer(seen, [7, 7]), "stg_sales", "jdbc:x", {"user": "u"})
    assert seen == {"format": "jdbc", "url": "jdbc:x", "dbtable": "stg_sales", "mode": "overwrite",
                    "batchsize": "10000", "numPartitions": "16", "truncate": "true", "user": "u",
                    "saved": True}
    with pytest.raises(RuntimeError, match="stg_sales"):
        jdbc.load_all({"stg_sales": _Writer({}, [7, 8])}, "jdbc:x")


# --- a whole run over CSV exports -----------------------------------------------------------
def write_csv(path, header, lines):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(lines)


@pytest.fixture
def exports(tmp_path):
    src = tmp_path / "raw"
    src.mkdir()
    product = [*S.RAW_REQUIRED["product"], *[f"Unknown {i}" for i in range(18)]]
    write_csv(src / "PRODUCT.csv", product, [
        ["p1", "Cable, 1m", "t", "oraimo", "", "s", "pcs", "1", "2", "3", "4", "007", *"x" * 18],
        ["", "No number", "t", "NA", "", "s", "pcs", "x", "2", "3", "", "008", *"x" * 18]])
    write_csv(src / "SALES.csv", S.STG_SALES.names, [
        ["1/2/2024", "Cable", "p1", "t", "oraimo", "", "Main", "", "retail ", "0", "0", "10.5",
         "2", "6", "5.25", "3", "4.5", "42.9%"],
        ["bad", "?", "", "t", "", "", "", "", "", "0", "0", "1", "1", "1", "1", "1", "0", "0%"]])
    write_csv(src / "STOCK_BALANCE.csv", [
        "Product No.", "Product Name", "SKU No.", "Category", "Brand", "Unit of Measurement",
        "Main- Stock on Hand", "Main-Unit Cost", "Main-Inventory Asset Value",
        "main- Stock on Hand", "Summary- Stock on Hand"], [
        ["p1", "Cable, 1m", "s", "oraimo", "", "pcs", "4", "3", "12", "0", "4"],
        ["nan", "No number", "s", "", "", "pcs", "", "", "", "1", "1"]])
    write_csv(src / "STOCK_BALANCE_DETAILS.csv", S.RAW_REQUIRED["stock_balance_details"], [
        ["p1", "Cable", "s", "oraimo", "", "pcs", "Receive Stock", "d1", "16/1/2024", "Main", "4",
         "", "4", "12"],
        ["p1", "Cable", "s", "oraimo", "", "pcs", "", "d2", "1/1/2024", " Main ", "", "", "0", ""],
        ["p1", "Cable", "s", "oraimo", "", "pcs", "Deliveries", "d3", "2024-02-28", "Main", "", "1",
         "3", "9"]])
    return str(src)


def test_refresh_from_csv(spark, exports, base):
    version = run_refresh(spark, exports, f"{base}/out", RUN, snapshots=True)
    assert lake.current_version(spark, f"{base}/out") == version
    tables = {name: lake.current(spark, f"{base}/out", name) for name in S.STAGED}
    for name, df in tables.items():
        assert df.columns == S.STAGED[name].names, name
        assert [f.dataType for f in df.schema] == [f.dataType for f in S.STAGED[name]], name
    assert {n: df.count() for n, df in tables.items()} == {
        "stg_product": 2, "stg_sales": 2, "stg_stock_balance": 4, "stg_stock_movement": 3,
        "stg_stock_aging": 4}
    assert {r["Product No."] for r in tables["stg_product"].collect()} == {"p1", "UNSPECIFIED-1"}
    aging = {(r["Product No."], r["Warehouse"]): r for r in tables["stg_stock_aging"].collect()}
    assert set(aging) == {("p1", "Main"), ("UNSPECIFIED-1", "Main"), ("p1", "main"),
                          ("UNSPECIFIED-3", "main")}
    main = aging["p1", "Main"]
    assert (main["Last Movement Date"], main["Inventory Age Days"], main["Aging Bucket"],
            main["Is Aged 45 Plus"]) == (DATE(2024, 1, 16), 45, "31-45 Days", True)
    assert aging["p1", "main"]["Aging Bucket"] == "No Movement Data"
    snapshot = spark.read.option("header", True).csv(f"{base}/out/{version}/stg_stock_aging_csv")
    assert snapshot.count() == 4 and snapshot.columns == S.STG_STOCK_AGING.names


def test_command_publishes_staged_and_report_tables(spark, exports, base):
    import refresh
    out = f"{base}/out"
    refresh.main(["--src", exports, "--dst", out, "--run-date", "2024-03-01"], spark)
    assert lake.current(spark, out, "stg_stock_aging").count() == 4
    gold = out  # one version holds staged tables and reports
    kpi = lake.current(spark, gold, "exec_kpi").first()
    assert (kpi.n_skus, kpi.n_warehouses, float(kpi.units)) == (3, 2, 5.0)
    assert float(kpi.net_sales) == 11.5
    house = lake.current(spark, gold, "segment_house").collect()
    assert [(r.brand, float(r.amount)) for r in house] == [("ORAIMO", 10.5)]
    orphans = {(r.source_table, r.product_no) for r in lake.current(spark, gold, "orphans").collect()}
    assert orphans == {("stg_stock_balance", "UNSPECIFIED-3")}
    recon = {(r.product_no, r.warehouse): r["class"]
             for r in lake.current(spark, gold, "reconciliation").collect()}
    assert recon["p1", "Main"] == "MATCH" and recon["p1", "main"] == "NO_LOG"
    facts = lake.current(spark, gold, "fact_sales")
    assert facts.join(lake.current(spark, gold, "dim_brand"), ["brand_key"]).count() == 2


def test_incremental_command_publishes_the_same_tables(spark, exports, base):
    import refresh
    from shelfwise.functions.contents import content
    from shelfwise.sinks import parts
    common = ["--src", exports, "--run-date", "2024-03-01", "--csv-option", "multiLine=false"]
    full = refresh.main([*common, "--dst", f"{base}/full"], spark)
    first = refresh.main([*common, "--dst", f"{base}/parts", "--incremental"], spark)
    published = {n for n in os.listdir(f"{base}/full/{full}") if not n.startswith("raw_")}
    m = parts.manifest(spark, f"{base}/parts")
    assert set(m.tables) == published - {"rejected"}
    for name in ("exec_kpi", "brand_health", "quality_report", "stg_stock_aging", "reconciliation"):
        whole = lake.current(spark, f"{base}/full", name)
        if name == "quality_report":  # records that do not fit fail an incremental run
            whole = whole.where("field <> '(record)'")
        assert content(parts.read(spark, f"{base}/parts", name)).first()[:] == content(
            whole).first()[:], name
    with open(f"{exports}/SALES.csv", "a", encoding="utf-8") as f:
        f.write("3/2/2024,Cable,p1,t,oraimo,,Main,,retail,0,0,5,1,3,5,3,2,40%\r\n")
    second = refresh.main([*common, "--dst", f"{base}/parts", "--incremental", "--keep", "5"], spark)
    m = parts.manifest(spark, f"{base}/parts")
    fresh = {n for n, t in m.tables.items() if any(v == second for v, _, _ in t.parts.values())}
    assert {"stg_sales", "exec_kpi", "sales_trend"} <= fresh and first != second
    assert not fresh & {"stg_product", "stg_stock_balance", "stg_stock_aging", "brand_health"}
    with pytest.raises(SystemExit):
        refresh.main([*common, "--dst", f"{base}/parts", "--incremental", "--snapshots"], spark)


def test_report_tables_for_pages(spark, frame):
    from shelfwise.plans.dashboards import gold_tables
    staged = {name: spark.createDataFrame([], schema) for name, schema in S.STAGED.items()}
    tables = gold_tables(staged, RUN, pages={"phones": {"categories_in": ["PHONES"]}})
    assert {"segment_phones", "aging_phones", "channels_house"} <= set(tables)
    assert {n: df.count() for n, df in tables.items() if df.count()} == {"exec_kpi": 1}


def test_refresh_refuses_broken_records_and_large_numbers(spark, exports, base):
    path = f"{exports}/PRODUCT.csv"
    good = open(path, encoding="utf-8").read()
    for bad, found in (('p3,"two\nlines",t,c,b,s,pcs,1,2,3,4,009' + ",x" * 18, "broken record"),
                       ("p3,n,t,c,b,s,pcs,1,2,3,4,009" + ",x" * 19, "broken record"),
                       ("p3,n,t,c,b,s,pcs,100000000000000,2,3,4,009" + ",x" * 18, "too large")):
        with open(path, "w", encoding="utf-8") as f:
            f.write(good + bad + "\n")
        with pytest.raises(ValueError, match=found):
            run_refresh(spark, exports, f"{base}/out", RUN)
    assert not lake.is_published(spark, f"{base}/out")
    with open(path, "w", encoding="utf-8") as f:
        f.write(good + 'p3,"two\nlines",t,c,b,s,pcs,1,2,3,4,009' + ",x" * 18 + "\n")
    run_refresh(spark, exports, f"{base}/out", RUN, options={"multiLine": "true"})
    names = {r["Product Name"] for r in lake.current(spark, f"{base}/out", "stg_product").collect()}
    assert names == {"Cable, 1m", "No number", "two\nlines"}


BAD_ROWS = {
    "PRODUCT": ['p3,"two\nlines",t,c,b,s,pcs,1,2,3,4,009' + ",x" * 18,
                "p4,n,t,c,b,s,pcs,100000000000000,2,3e20,4,009" + ",x" * 18],
    "STOCK_BALANCE": ["p5,Big,s,c,b,pcs,1e15,1,1,0,0", ",No number,s,c,b,pcs,2,1,1,0,2"],
}


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_rows_that_do_not_fit_are_rejected_with_place_and_reason(spark, exports, base, fmt):
    for name, bad in BAD_ROWS.items():
        with open(f"{exports}/{name}.csv", "a", encoding="utf-8") as f:
            f.writelines(line + "\r\n" for line in bad)
    src = exports
    if fmt == "parquet":
        from shelfwise.sources.exports import TABLES, read_raw
        src = f"{base}/parquet"
        for table, stem in TABLES.items():
            df = read_raw(spark, table, f"{exports}/{stem}.csv", row_ids=False, broken=True)
            df = df.where(df[S.BROKEN].isNull()).drop(S.BROKEN)
            if table == "stock_balance":  # Parquet has no names that differ in case only
                df = df.toDF(*[n.replace("main-", "second-") for n in df.columns])
            df.coalesce(1).write.parquet(f"{src}/{stem}.parquet")
    with pytest.raises(ValueError, match="refused"):
        run_refresh(spark, src, f"{base}/out", RUN, fmt)
    with pytest.raises(ValueError, match="above 0.2"):
        run_refresh(spark, src, f"{base}/out", RUN, fmt, max_rejected=0.2)
    run_refresh(spark, src, f"{base}/out", RUN, fmt, max_rejected=0.7)
    found = lake.current(spark, f"{base}/out", "rejected").collect()
    lines = {(r.table_name, r.position, r.field, r.reason) for r in found}
    broken = {("product", 2, "(record)", "broken record"), ("product", 3, "(record)", "broken record")}
    at = 4 if fmt == "csv" else 2  # a line break in quotes makes two records of a line
    assert lines == (broken if fmt == "csv" else set()) | {
        ("product", at, "Purchase Price", "too large"), ("product", at, "Retail Price", "too large"),
        ("stock_balance", 2, "Main- Stock on Hand", "too large")}
    assert all(r.file.split("/")[-2 if fmt == "parquet" else -1].startswith(
        {"product": "PRODUCT", "stock_balance": "STOCK_BALANCE"}[r.table_name]) for r in found)
    assert {r.text for r in found if r.field == "Retail Price"} == {"3e20"}
    tables = {n: lake.current(spark, f"{base}/out", n) for n in S.STAGED}
    assert {n: df.count() for n, df in tables.items()} == {
        "stg_product": 2, "stg_sales": 2, "stg_stock_balance": 6, "stg_stock_movement": 3,
        "stg_stock_aging": 6}
    # Row 3 of a sheet of 4: positions are those in the file, whatever was rejected.
    assert {r[0] for r in tables["stg_stock_balance"].select("`Product No.`").collect()} == {
        "p1", "UNSPECIFIED-1", "UNSPECIFIED-3", "UNSPECIFIED-5", "UNSPECIFIED-7"}


@pytest.mark.parametrize("stage", ["stage_product", "stage_sales", "stage_movement"])
def test_a_row_swapped_for_a_copy_of_another_is_noticed(spark, exports, base, monkeypatch, stage):
    """Counts stay as they are, contents do not."""
    from shelfwise.plans import refresh
    whole = getattr(refresh, stage)

    def swapped(*args):
        df = whole(*args)
        by = [f"`{c}`" for c in df.columns]
        first, last = df.orderBy(*by).limit(1), df.orderBy(*[F.col(c).desc() for c in by]).limit(1)
        return df.exceptAll(first).unionByName(last)

    monkeypatch.setattr(refresh, stage, swapped)
    with pytest.raises(ValueError, match="contents not conserved"):
        run_refresh(spark, exports, f"{base}/out", RUN)
    assert not lake.is_published(spark, f"{base}/out")


def test_a_stock_cell_of_another_product_is_noticed(spark, exports, base, monkeypatch):
    from shelfwise.plans import refresh
    whole = refresh.unpivot_balance

    def moved(*args, **kw):
        df = whole(*args, **kw)
        stock = F.col("`Stock on Hand`")
        return df.withColumn("Stock on Hand", F.when(stock == 4, 1).when(stock == 1, 4).otherwise(
            stock).cast(S.NUMBER))

    monkeypatch.setattr(refresh, "unpivot_balance", moved)
    with pytest.raises(ValueError, match="stg_stock_balance"):
        run_refresh(spark, exports, f"{base}/out", RUN)


def test_refreshes_keep_the_declared_versions(spark, exports, base):
    out = f"{base}/out"
    os.makedirs(f"{out}/notes")
    lake.publish(spark, {"a": spark.range(1)}, out)
    kept = [lake.publish(spark, {"a": spark.range(k)}, out) for k in range(2, 10)]
    reader = lake.current(spark, out, "a")
    failed = lake.new_version()
    spark.range(3).write.parquet(lake.version_path(out, failed, "a"))
    assert lake.retain(spark, out, keep=2) == []  # all were current within the last hour
    last = run_refresh(spark, exports, out, RUN, keep=2)
    assert lake.retain(spark, out, keep=2, min_age=0)
    left = {n for n in os.listdir(out) if lake.VERSION_NAME.fullmatch(n)}
    assert left == {kept[-1], last} and os.path.isdir(f"{out}/notes")
    assert reader.count() == 9 and lake.current(spark, out, "stg_product").count() == 2
    assert lake.retain(spark, f"{base}/none") == []


def test_refresh_fails_on_a_lost_offset(spark, exports, base, monkeypatch):
    from shelfwise.sources import row_ids
    whole = row_ids.split_offsets
    monkeypatch.setattr(row_ids, "split_offsets", lambda *a: whole(*a).limit(0))
    with pytest.raises(Exception, match="no row offset"):
        run_refresh(spark, exports, f"{base}/out", RUN)
    assert not lake.is_published(spark, f"{base}/out")


def test_refresh_publishes_quality_and_keys(spark, exports, base):
    import refresh
    out = f"{base}/out"
    refresh.main(["--src", exports, "--dst", out, "--run-date", "2024-03-01", "--page",
                  "phones=phones,solar", "--as-of-strict", "--safe-keys"], spark)
    report = {(r.table_name, r.field, r.rule): r.n
              for r in lake.current(spark, out, "quality_report").collect() if r.n}
    assert report["sales", "Date", "unparsed date"] == 1
    assert lake.current(spark, out, "key_check").count() == 0
    assert lake.current(spark, out, "segment_phones").count() == 0


def test_folded_state_survives_a_repeated_batch(spark, base):
    src, dst, mark = f"{base}/in", f"{base}/state", f"{base}/mark"
    for k in range(3):
        spark.createDataFrame([("a", k), ("b", 10 - k)], "k string, v int").coalesce(1) \
            .write.mode("append").parquet(src)
    stream = spark.readStream.schema("k string, v int").option("maxFilesPerTrigger", 1).parquet(src)
    sums = stream.groupBy("k").agg(F.sum("v").alias("v"))
    X.run_folded(sums, dst, mark, ["k"])
    assert rows(X.folded(spark, dst)) == [("a", 3), ("b", 27)]
    X.run_folded(sums, dst, f"{base}/mark2", ["k"])  # all batches again: their versions are there
    assert rows(X.folded(spark, dst)) == [("a", 3), ("b", 27)]


def test_catalog_table(spark):
    lake.save_table(spark.range(3).toDF("Product No."), "stg_saved")
    lake.save_table(spark.range(2).toDF("Product No."), "stg_saved")
    assert spark.table("stg_saved").count() == 2
    spark.sql("DROP TABLE stg_saved")


def test_failed_refresh_leaves_the_old_version(spark, exports, base, monkeypatch):
    version = run_refresh(spark, exports, f"{base}/out", RUN)
    from shelfwise.plans import refresh
    monkeypatch.setattr(refresh, "assert_conserved", lambda *a: (_ for _ in ()).throw(ValueError()))
    with pytest.raises(ValueError):
        run_refresh(spark, exports, f"{base}/out", RUN)
    assert lake.current_version(spark, f"{base}/out") == version


# --- streams --------------------------------------------------------------------------------
MOVES = [  # three arrivals; the last brings an older date and a new pair
    [("p", "A", "10/01/2024"), ("q", "A", "05/01/2024"), ("r", "B", "bad")],
    [("p", "A", "20/01/2024"), ("q", "B", "06/01/2024")],
    [("p", "A", "01/01/2023"), ("q", "A", None), ("s", "C", "07/02/2024"), ("r", "B", "x")],
]
MOVE_SCHEMA = ", ".join(f"`{n}` string" for n in S.RAW_REQUIRED["stock_balance_details"])


def movement_rows(spark, moves):
    data = [(p, "n", "s", "c", "b", "u", "t", "d", d, w, "1", "1", "1", "1") for p, w, d in moves]
    return spark.createDataFrame(data, MOVE_SCHEMA)


def save_moves(spark, moves, path):
    # JSON lines keep dotted names as they are.
    movement_rows(spark, moves).coalesce(1).write.mode("append").json(path)


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_stream_equals_batch_in_any_order(spark, base, order):
    src, table, mark = f"{base}/in", f"{base}/table", f"{base}/mark"
    for i in order:  # one run per arrival, each a restart from the checkpoint
        save_moves(spark, MOVES[i], src)
        staged = T.stage_movement(spark.readStream.schema(MOVE_SCHEMA).json(src))
        X.run_available(X.moving_last_movement(staged), table, mark)
        X.run_available(staged, f"{base}/plain", f"{base}/mark2", mode="append",
                        per_batch=A.last_movement)
    batch = A.last_movement(T.stage_movement(movement_rows(spark, sum(MOVES, []))))
    got = rows(X.latest_movements(spark, table))
    assert rows(X.latest_movements(spark, f"{base}/plain")) == got
    assert got == rows(batch) and ("p", "A", DATE(2024, 1, 20)) in got
    assert not any(r[0] == "r" for r in got)
    balance = spark.createDataFrame(
        [(p, "n", "s", "C", "B", "u", w, None, None, None) for p in "pqr" for w in "AB"],
        S.STG_STOCK_BALANCE)
    assert rows(A.age_stock(balance, X.latest_movements(spark, table), RUN)) == rows(
        A.age_stock(balance, batch, RUN))
    # A replayed batch replaces its folder: nothing changes.
    last = max(int(n.split("=")[1]) for n in os.listdir(table) if "=" in n)
    again = spark.read.parquet(f"{table}/batch={last}").collect()
    spark.createDataFrame(again, "`Product No.` string, Warehouse string, "
                          "`Last Movement Date` date").write.mode("overwrite").parquet(
        f"{table}/batch={last}")
    assert rows(X.latest_movements(spark, table)) == got


SALES = [
    [(DATE(2024, 1, 1), "R", 10, 1, 2), (DATE(2024, 1, 2), "R", 5, 1, 1), (None, "R", 3, 1, 1)],
    [(DATE(2024, 1, 2), "R", 7, 2, 1), (DATE(2024, 1, 9), "O", 1, 1, 0)],
    [(DATE(2024, 1, 1), "R", 1, 1, 1), (None, "R", 4, 1, 1), (DATE(2024, 1, 9), "O", 2, 1, 1)],
]
SALE_SCHEMA = "date date, channel string, amount decimal(18,4), qty decimal(18,4), profit decimal(18,4)"


def sale_rows(spark, sales):
    df = spark.createDataFrame(sales, "date date, channel string, amount int, qty int, profit int")
    return df.select("date", "channel", *[F.col(c).cast("decimal(18,4)") for c in
                                          ("amount", "qty", "profit")])


def test_channel_days_count_late_and_undated_rows(spark, base):
    src, table, mark = f"{base}/in", f"{base}/table", f"{base}/mark"
    for part in SALES:
        sale_rows(spark, part).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(SALE_SCHEMA).parquet(src)
        X.run_available(X.channel_days(stream), table, mark)
    got = rows(X.latest_channel_days(spark, table))
    want = sale_rows(spark, sum(SALES, [])).groupBy("date", "channel").agg(
        F.count("*"), *[F.sum(c).cast("decimal(38,4)") for c in ("amount", "qty", "profit")])
    assert got == rows(want) and len(got) == 4


def test_channel_days_with_watermark_are_final(spark, base):
    """Behind a bounded delay every day is emitted once, when the watermark has passed it."""
    src, table, mark = f"{base}/in", f"{base}/table", f"{base}/mark"
    ordered = [[s for s in sum(SALES, []) if s[0] == d]
               for d in sorted({s[0] for s in sum(SALES, []) if s[0]})]
    for part in [*ordered, [(DATE(2025, 1, 1), "Z", 0, 0, 0)]]:
        sale_rows(spark, part).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(SALE_SCHEMA).parquet(src)
        X.run_available(X.channel_days(stream, watermark="2 days"), table, mark, mode="append")
    got = spark.read.parquet(table).drop("batch")
    daily = G.sales_trend(sale_rows(spark, sum(ordered, [])), grain="day")
    assert rows(got.groupBy("day").agg(F.sum("n_rows"), F.sum("amount"))) == rows(
        daily.groupBy("day").agg(F.sum("n_rows"), F.sum("amount")))

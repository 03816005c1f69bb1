"""Staged tables: headers, unpivot, ageing, quality checks."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from shelfwise import schemas as S
from shelfwise.operators import ageing as A
from shelfwise.operators import quality as Q
from shelfwise.operators import reshape as R
from shelfwise.operators import staging as T

DATE, DEC = datetime.date, decimal.Decimal
IDS = list(S.RAW_REQUIRED["stock_balance"])


def sheet(frame, headers, *rows, **kw):
    return frame([*IDS, *headers], *[(no, f"n{no}", "s", "Phones", None, "pcs", *cells)
                                     for no, *cells in rows], **kw)


def test_headers():
    names = [*IDS, "A- Stock on Hand", "A-Unit Cost", "B - Stock on Hand",
             "B-Inventory Asset Value", "X - Y-Stock on Hand", "Stock on Hand",
             "Summary- Stock on Hand", "SUMMARY- Stock on Hand", "C- Stock on Hand ",
             "A- stock on hand", "A- Stock on Hand.1"]
    blocks = R.plan_headers(names)
    assert [b.warehouse for b in blocks] == ["A", "B", "X - Y", "Stock on Hand"]
    assert [b.ordinal for b in blocks] == [0, 1, 2, 3]
    assert [(b.stock, b.cost, b.value) for b in blocks] == [
        (6, 7, None), (8, None, 9), (10, None, None), (11, None, None)]
    assert R.unread_headers(names) == ["C- Stock on Hand ", "A- Stock on Hand.1"]
    with pytest.raises(ValueError, match="Stock on Hand"):
        R.plan_headers(["Product No.", "Summary- Stock on Hand"])


def test_unpivot(frame):
    raw = sheet(frame, ["A- Stock on Hand", "A-Unit Cost", "A-Inventory Asset Value",
                        "B - Stock on Hand", "Summary- Stock on Hand"],
                ("p0", "1,234", "x", "9.5", "-3", "7"), (None, None, "1", None, "2", "7"),
                (" p2 ", "0", None, "1", "x", "7"))
    rows = R.unpivot_balance(raw).collect()
    got = {(r["Product No."], r["Warehouse"]): (r["Stock on Hand"], r["Unit Cost"],
                                                r["Inventory Asset Value"]) for r in rows}
    zero = DEC(0)
    assert got == {
        ("p0", "A"): (zero, None, DEC("9.5")), ("UNSPECIFIED-1", "A"): (zero, DEC(1), None),
        ("p2", "A"): (zero, None, DEC(1)), ("p0", "B"): (DEC(-3), None, None),
        ("UNSPECIFIED-4", "B"): (DEC(2), None, None), ("p2", "B"): (zero, None, None)}
    assert {r["Brand"] for r in rows} == {"PHONES - UNBRANDED"}
    assert R.unpivot_balance(raw).columns == S.STG_STOCK_BALANCE.names


def test_unpivot_odd_names_and_types(frame):
    quoted = "O'Hara `x` (1).2 \\ \"q\""
    raw = sheet(frame, ["a", "b"], ("p", "1", "2"), row_ids=False).withColumn("b", F.lit(2))
    raw = raw.toDF(*IDS, f"{quoted}- Stock on Hand", "Main- Stock on Hand")
    rows = R.unpivot_balance(raw).collect()
    assert {(r["Warehouse"], int(r["Stock on Hand"])) for r in rows} == {(quoted, 1), ("Main", 2)}


def test_unpivot_headers_that_differ_in_case(frame):
    raw = sheet(frame, ["a- Stock on Hand", "b- Stock on Hand"], ("p", "1", "2")).toDF(
        *IDS, "M- Stock on Hand", "m- Stock on Hand", "_row_id")
    got = {(r["Warehouse"], int(r["Stock on Hand"])) for r in R.unpivot_balance(raw).collect()}
    assert got == {("M", 1), ("m", 2)}


def test_unpivot_reads_only_what_is_asked(spark, frame, tmp_path):
    raw = sheet(frame, ["A- Stock on Hand", "A-Unit Cost", "B- Stock on Hand", "B-Unit Cost"],
                ("p", "1", "2", "3", "4"))
    raw.toDF(*[f"x{i}" for i in range(len(raw.columns))]).write.parquet(str(tmp_path / "w"))
    wide = spark.read.parquet(str(tmp_path / "w")).toDF(*raw.columns)
    some = R.unpivot_balance(wide).select("Warehouse", "`Stock on Hand`")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "x6" in plan and "x8" in plan
    assert "x7" not in plan and "x9" not in plan
    one = R.unpivot_balance(wide, warehouses=["B"])
    assert one.count() == 1 and one.first()["Stock on Hand"] == 3
    assert "x6" not in one._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="none of"):
        R.unpivot_balance(wide, warehouses=["Z"])


def test_restricted_unpivot_keeps_row_positions(frame):
    raw = sheet(frame, ["A- Stock on Hand", "B- Stock on Hand"], ("p", "1", "2"), ("", "3", "4"))
    full = {r["Product No."] for r in R.unpivot_balance(raw).where("Warehouse = 'B'").collect()}
    assert {r["Product No."] for r in R.unpivot_balance(raw, warehouses=["B"]).collect()} == full
    assert full == {"p", "UNSPECIFIED-3"}


def test_sales_keeps_every_column(frame):
    names = ["Extra", *S.STG_SALES.names]
    row = ("e", "1/2/2024", "P", None, "t", "phones", None, " w ", None, " retail ", "1", "2",
           "3.5", "4", "5", "6", "x", "1,5", "12%")
    df = T.stage_sales(frame(names, row))
    assert df.columns == [*S.STG_SALES.names, "Extra"]
    r = df.first().asDict()
    assert r["Date"] == DATE(2024, 2, 1) and r["Product NO."] == "UNSPECIFIED-0"
    assert (r["Tier 1 Category"], r["Brand"]) == ("PHONES", "PHONES - UNBRANDED")
    assert (r["Warehouse"], r["Store"], r["Sales Channels"]) == ("w", "UNSPECIFIED STORE", "RETAIL")
    assert r["Refund Order Count"] == 2 and r["Net Sales Amount"] == DEC("3.5")
    assert r["Net Sales Unit Cost"] is None and r["Net Sales Gross Profit"] is None
    assert r["Net Sales Gross Margin"] == "12%" and r["Extra"] == "e"


def test_product_and_movement(frame):
    product = T.stage_product(frame(
        [*S.RAW_REQUIRED["product"], "Extra"],
        (" 1 ", None, "t", " oraimo", "", "s", "pcs", "1", "x", "2.5", None, "007", "e")))
    assert product.schema == S.STG_PRODUCT or product.columns == S.STG_PRODUCT.names
    assert list(product.first()) == ["1", None, "t", "ORAIMO", "ORAIMO", "s", "pcs", DEC(1), None,
                                     DEC("2.5"), None, "007"]
    movement = T.stage_movement(frame(
        S.RAW_REQUIRED["stock_balance_details"],
        (None, "n", None, None, " b", "pcs", "NaT", "d1", "31/02/2024", "", "1", "x", "3", "4")))
    assert list(movement.first()) == [
        "UNSPECIFIED-0", "n", None, "UNCATEGORISED", "B", "pcs", "UNSPECIFIED MOVEMENT", "d1",
        None, "UNSPECIFIED WAREHOUSE", DEC(1), None, DEC(3), DEC(4)]


def test_missing_columns_are_named(frame):
    with pytest.raises(ValueError, match="Sales Channels"):
        T.stage_sales(frame(["Date", "Tier 1 Category", "Brand", "Product NO."], ("1",) * 4))


def stock(spark, *rows):
    return spark.createDataFrame(
        [(p, "n", "s", "C", "B", "u", w, DEC(q), None, DEC(1)) for p, w, q in rows],
        S.STG_STOCK_BALANCE)


def log(spark, *rows):
    return spark.createDataFrame(
        [(p, "n", "s", "C", "B", "u", "t", f"d{i}", d, w, None, None, None, None)
         for i, (p, w, d) in enumerate(rows)], S.STG_STOCK_MOVEMENT)


RUN = DATE(2024, 3, 1)


def test_ageing(spark):
    balance = stock(spark, ("p", "A", 5), ("p", "B", 0), ("q", "A", 1), ("r", "A", 1),
                    ("P", "A", 1), ("q", "A", 2))
    moves = log(spark, ("p", "A", DATE(2024, 1, 16)), ("p", "A", DATE(2023, 1, 1)),
                ("p", "A", None), ("q", "A", DATE(2024, 3, 5)), ("r", "A", None),
                ("p", "C", DATE(2024, 3, 1)))
    aged = A.stock_ageing(balance, moves, RUN)
    assert aged.columns == S.STG_STOCK_AGING.names
    assert not aged.schema["Is Aged 45 Plus"].nullable
    got = sorted((r["Product No."], r["Warehouse"], r["Last Movement Date"],
                  r["Inventory Age Days"], r["Aging Bucket"], r["Is Aged 45 Plus"])
                 for r in aged.where("`Product No.` != 'q'").collect())
    assert got == [("P", "A", None, None, "No Movement Data", False),
                   ("p", "A", DATE(2024, 1, 16), 45, "31-45 Days", True),
                   ("p", "B", None, None, "No Movement Data", False),
                   ("r", "A", None, None, "No Movement Data", False)]
    twice = aged.where("`Product No.` = 'q'").collect()
    assert [(r["Inventory Age Days"], r["Aging Bucket"]) for r in twice] == [
        (-4, "No Movement Data")] * 2
    strict = A.stock_ageing(balance, moves, RUN, as_of_strict=True)
    assert {r["Last Movement Date"] for r in strict.where("`Product No.` = 'q'").collect()} == {None}


def test_placeholder_keys(spark):
    balance, moves = stock(spark, ("UNSPECIFIED-5", "A", 1)), log(
        spark, ("UNSPECIFIED-5", "A", DATE(2024, 2, 28)))
    assert A.stock_ageing(balance, moves, RUN).first()["Inventory Age Days"] == 2
    safe = A.stock_ageing(balance, moves, RUN, safe_keys=True).first()
    assert safe["Inventory Age Days"] is None and safe["Aging Bucket"] == "No Movement Data"


def test_asof_series_equals_single_strict_runs(spark):
    balance = stock(spark, ("p", "A", 5), ("q", "A", 2), ("r", "B", 7))
    moves = log(spark, ("p", "A", DATE(2024, 1, 1)), ("p", "A", DATE(2024, 2, 20)),
                ("q", "A", DATE(2024, 2, 1)), ("r", "B", None))
    days = [DATE(2023, 12, 31), DATE(2024, 1, 10), RUN]
    got = {(r.run_date, r.aging_bucket): (r.n_rows, r.units)
           for r in A.asof_series(balance, moves, days).collect()}
    want = {}
    for day in days:
        for r in A.stock_ageing(balance, moves, day, as_of_strict=True).collect():
            n, units = want.get((day, r["Aging Bucket"]), (0, 0))
            want[day, r["Aging Bucket"]] = (n + 1, units + r["Stock on Hand"])
    assert got == want


def test_timestamps_survive_staging_and_round_down(spark, frame):
    raw = frame(S.RAW_REQUIRED["stock_balance_details"],
                ("p", "n", "s", "c", "b", "u", "t", "d", None, "A", "1", "1", "1", "1"))
    raw = raw.withColumn("Date", F.lit("2024-03-01 10:00:00").cast("timestamp_ntz"))
    moves = T.stage_movement(raw)
    aged = A.stock_ageing(stock(spark, ("p", "A", 1)), moves, RUN).first()
    assert aged["Inventory Age Days"] == -1 and aged["Aging Bucket"] == "No Movement Data"


def raw_tables(frame):
    return {
        "product": frame(S.RAW_REQUIRED["product"],
                         ("1", "n", "t", "c", None, "s", "u", "1.23456", "x", "", "4", "b"),
                         (None, "n", "t", "", "b", "s", "u", "1", "2", "3", "4", "b")),
        "sales": frame(S.STG_SALES.names, ("x", "p", "1", "t", "c", "b", "w", "s", "ch", *"12345678",
                                           "9%")),
        "stock_balance": sheet(frame, ["A- Stock on Hand", "B- Stock on Hand", "C- Stock on Hand "],
                               ("1", "x", "2", "3"), ("2", "1", "", "3")),
        "stock_balance_details": frame(
            S.RAW_REQUIRED["stock_balance_details"],
            ("1", "n", "s", "c", "b", "u", None, "d", "1/1/2024", "A", "1", None, "x", "1")),
    }


def test_quality_report(frame):
    got = {(r.table_name, r.field, r.rule): r.n
           for r in Q.quality_report(raw_tables(frame)).collect() if r.n}
    assert got == {
        ("product", "Product No.", "placeholder"): 1, ("product", "Category", "placeholder"): 1,
        ("product", "Brand", "placeholder"): 1, ("product", "Purchase Price", "rounded"): 1,
        ("product", "Wholesale Price", "not a number"): 1,
        ("sales", "Date", "unparsed date"): 1,
        ("stock_balance", "Brand", "placeholder"): 2,
        ("stock_balance", "Stock on Hand", "not a number"): 1,
        ("stock_balance", "C- Stock on Hand ", "header not read"): 1,
        ("stock_balance_details", "Type", "placeholder"): 1,
        ("stock_balance_details", "Closing-Quantity", "not a number"): 1}


def test_quality_of_balance_cells(frame):
    raw = {**raw_tables(frame), "stock_balance": sheet(
        frame, ["A- Stock on Hand", "B- Stock on Hand"],
        ("1", " nan ", "1.123456"), ("2", "\t", "1e14"), ("3", "\u00a0", "x"))}
    got = {r.rule: r.n for r in Q.quality_report(raw).collect()
           if (r.table_name, r.field) == ("stock_balance", "Stock on Hand")}
    assert got == {"not a number": 1, "rounded": 1, "too large": 1}


def test_numbers_too_large_are_refused(frame):
    from shelfwise.functions import clean as C
    df = frame(["x"], ("99999999999999",), ("1e14",), ("inf",), ("x",), (None,))
    good = df.where("x <> '1e14' or x is null").orderBy("_row_id").select(C.zero_filled(F.col("x")))
    assert [float(r[0]) for r in good.collect()] == [99999999999999.0, 0, 0, 0]
    with pytest.raises(Exception, match="too large"):
        df.select(C.zero_filled(F.col("x"))).collect()


def test_row_conservation(frame):
    from shelfwise.plans.refresh import stage_all
    raw = raw_tables(frame)
    staged = stage_all(raw, RUN)
    assert {r.table_name: (r.expected_rows, r.actual_rows, r.ok)
            for r in Q.row_conservation(raw, staged).collect()} == {
        "stg_product": (2, 2, True), "stg_sales": (1, 1, True), "stg_stock_balance": (4, 4, True),
        "stg_stock_movement": (1, 1, True), "stg_stock_aging": (4, 4, True)}
    Q.assert_conserved(raw, staged)
    staged["stg_sales"] = staged["stg_sales"].limit(0)
    with pytest.raises(ValueError, match="stg_sales"):
        Q.assert_conserved(raw, staged)


def test_observed_counts(frame, tmp_path):
    df, seen = Q.observed(raw_tables(frame)["product"], "product")
    df.toDF(*[f"c{i}" for i in range(len(df.columns))]).write.parquet(str(tmp_path / "o"))
    assert seen.get == {"rows": 2, "columns": 13}


def test_key_violations(spark):
    balance = stock(spark, ("p", "A", 1), ("p", "A", 2), ("q", "A", 1))
    got = Q.key_violations(balance, A.KEYS, "stg_stock_balance").collect()
    assert [tuple(r) for r in got] == [("stg_stock_balance", "p | A", 2)]


def test_conform_nulls_what_does_not_fit(spark):
    df = spark.createDataFrame([("1", "99999999999999999", "k", "x")],
                               "`Refund Order Count` string, `Net Sales Amount` string, "
                               "`Net Sales Gross Margin` string, z string")
    want = S.T.StructType([f for f in S.STG_SALES.fields if f.name in df.columns])
    got = T.conform(df, want)
    assert got.schema["Net Sales Amount"].dataType == S.NUMBER
    assert got.first()["Net Sales Amount"] is None and got.first()["Refund Order Count"] == 1
    assert got.columns[-1] == "z"

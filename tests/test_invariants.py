"""Properties that hold for any input and any layout."""

import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise import schemas as S
from shelfwise.functions import clean as C
from shelfwise.operators import ageing as A
from shelfwise.operators import reshape as R
from shelfwise.operators import staging as T

RELAXED = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
cell = st.one_of(st.none(), st.sampled_from(["", " ", "nan", "None", "NaT", "<NA>", " x ", " ",
                                             "oraimo", "\tPhones", "ß"]),
                 st.text(st.characters(codec="utf-8", exclude_characters="\0"), max_size=6))


def python_blank(v):
    text = "" if v is None else v.strip()
    return "" if text in S.BLANK_TOKENS else text


@RELAXED
@given(st.lists(st.tuples(cell, cell), min_size=1, max_size=30))
def test_cleaning_against_plain_python(spark, pairs):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, k string, b string")
    category = C.clean_category(F.col("k"))
    got = df.select("i", C.blank_str(F.col("k")).alias("t"), category.alias("k"),
                    C.clean_brand(category, F.col("b")).alias("b")).orderBy("i").collect()
    fields = C.strip_fields(df, "k", "b").orderBy("i").collect()
    for (k, b), r, f in zip(pairs, got, fields):
        assert r.t == python_blank(k)
        assert f.k == (None if k is None else k.strip())
        assert r.k != "" and r.b != ""
        if not python_blank(k):
            assert r.k == "UNCATEGORISED"
        if not python_blank(b):
            assert r.b == ("ORAIMO" if r.k == "ORAIMO" else f"{r.k} - UNBRANDED")


@RELAXED
@given(st.lists(st.tuples(cell, cell), min_size=1, max_size=30))
def test_cleaning_twice_changes_nothing(spark, pairs):
    df = spark.createDataFrame(pairs, "k string, b string")
    once = df.select(C.clean_category(F.col("k")).alias("k"),
                     C.clean_brand(C.clean_category(F.col("k")), F.col("b")).alias("b"),
                     C.clean_text(F.col("b"), "none given").alias("t"),
                     C.clean_channel(F.col("b")).alias("c"))
    twice = once.select(C.clean_category(F.col("k")), C.clean_brand(F.col("k"), F.col("b")),
                        C.clean_text(F.col("t"), "none given"), C.clean_channel(F.col("c")))
    assert [tuple(r) for r in once.collect()] == [tuple(r) for r in twice.collect()]


number = st.one_of(st.none(), st.sampled_from(["x", "1,5", "", "0"]),
                   st.integers(-999, 999).map(str))


@RELAXED
@given(st.lists(st.tuples(cell, number, number, number), min_size=1, max_size=20))
def test_unpivot_conserves_rows_and_stock(spark, sheet):
    names = [*S.RAW_REQUIRED["stock_balance"], *[f"W{i}- Stock on Hand" for i in range(3)], S.ROW_ID]
    df = spark.createDataFrame([(no, "n", "s", "c", "b", "u", *q, i)
                                for i, (no, *q) in enumerate(sheet)],
                               ", ".join(["c string"] * 9 + ["r bigint"]).replace(
                                   "c string", "{} string").format(*[f"c{i}" for i in range(9)])
                               ).toDF(*names)
    rows = R.unpivot_balance(df).collect()
    assert len(rows) == 3 * len(sheet)

    def stock(v):
        try:
            return int(v)
        except (TypeError, ValueError):
            return 0

    for w in range(3):
        want = sum(stock(row[1 + w]) for row in sheet)
        assert sum(r["Stock on Hand"] for r in rows if r["Warehouse"] == f"W{w}") == want
    blanks = [(w, i) for w in range(3) for i, row in enumerate(sheet) if not python_blank(row[0])]
    made = {r["Product No."] for r in rows}
    assert {f"UNSPECIFIED-{w * len(sheet) + i}" for w, i in blanks} <= made


def ageing_inputs(spark, n=4000):
    """A third of the stock rows and of the log share one (product, warehouse)."""
    hot = F.col("id") % 3 == 0
    product = F.when(hot, F.lit("HOT")).otherwise(F.concat(F.lit("p"), F.col("id") % 700))
    warehouse = F.when(hot, F.lit("W0")).otherwise(F.concat(F.lit("W"), F.col("id") % 9))
    base = spark.range(n).select("id", product.alias("Product No."), warehouse.alias("Warehouse"))
    text, none = F.lit("x"), F.lit(None)
    balance = base.select(
        "`Product No.`", text.alias("Product Name"), text.alias("SKU No."),
        text.alias("Tier 1 Category"), text.alias("Brand"), text.alias("Unit of Measurement"),
        "Warehouse", (F.col("id") % 5).cast("decimal(18,4)").alias("Stock on Hand"),
        none.cast("decimal(18,4)").alias("Unit Cost"),
        F.lit(1).cast("decimal(18,4)").alias("Inventory Asset Value"))
    moves = base.where("id % 7 != 1").select(
        "`Product No.`", "Warehouse",
        F.expr("CASE WHEN id % 4 = 0 THEN NULL ELSE date_sub(date'2024-03-01', "
               "cast(id % 120 as int)) END").alias("Date"))
    return balance, moves


@pytest.mark.parametrize("partitions, broadcast", [("1", "-1"), ("7", "-1"), ("31", "10485760")])
def test_ageing_does_not_depend_on_layout(spark, partitions, broadcast):
    run = datetime.date(2024, 3, 1)
    keys = ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in zip(keys, (partitions, broadcast)):
            spark.conf.set(k, v)
        balance, moves = ageing_inputs(spark)
        got = sorted(map(tuple, A.stock_ageing(balance.repartition(5), moves.repartition(3), run)
                         .select("`Product No.`", "Warehouse", "`Last Movement Date`",
                                 "`Aging Bucket`").collect()), key=repr)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    last = {}
    for r in moves.collect():
        key = (r["Product No."], r["Warehouse"])
        if r["Date"] is not None:
            last[key] = max(last.get(key, r["Date"]), r["Date"])
    assert len(got) == 4000
    assert all(r[2] == last.get((r[0], r[1])) for r in got)


def test_hot_key_of_the_ageing_join_is_split(spark):
    """With a sort-merge join, AQE spreads a third of the stock over several tasks."""
    settings_ = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.shuffle.partitions": "16",
                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
                 "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000"}
    old = {k: spark.conf.get(k, None) for k in settings_}
    try:
        for k, v in settings_.items():
            spark.conf.set(k, v)
        balance, moves = ageing_inputs(spark, 60000)
        balance = balance.withColumn("Product Name", F.md5(F.rand(7).cast("string")))
        aged = A.stock_ageing(balance, moves, datetime.date(2024, 3, 1))
        n = len(aged.collect())
        plan = aged._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert n == 60000 and "skew=true" in plan


def test_log_is_combined_before_the_shuffle(spark):
    _, moves = ageing_inputs(spark)
    plan = A.last_movement(moves)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and plan.count("Exchange") == 1


def test_stage_movement_parses_each_date_once(spark, frame):
    raw = frame(S.RAW_REQUIRED["stock_balance_details"], tuple("abcdefghijklmn"))
    plan = A.last_movement(T.stage_movement(raw))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("try_to_date") <= 1

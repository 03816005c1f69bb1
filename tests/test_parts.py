"""Incremental refreshes: what they write, what they publish, and what stays."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from shelfwise import schemas as S
from shelfwise.functions.contents import content
from shelfwise.plans.incremental import run_incremental
from shelfwise.plans.refresh import run_refresh
from shelfwise.sinks import files, lake, parts
from shelfwise.sources import driver_tables as D

SF = "/root/testdata/sf0.001"


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def log(spark, n, value=0, month=None):
    """A row a day from 2024 on; `value` in one month, or everywhere."""
    day = F.date_add(F.lit(datetime.date(2024, 1, 1)), F.col("id").cast("int"))
    there = F.lit(True) if month is None else F.date_format(day, "yyyy-MM") == month
    return spark.range(n).select(F.when(F.col("id") % 50 > 0, day).alias("Date"),
                                 F.col("id").alias("n"),
                                 F.when(there, F.lit(value)).otherwise(0).alias("v"))


def folders(spark, base, table):
    return {v.partition("=")[2]: sorted(p.partition("=")[2] for p in files.children(
        spark, f"{base}/parts/{table}/{v}") if "=" in p)
        for v in files.children(spark, f"{base}/parts/{table}")}


# --- contents -----------------------------------------------------------------------------------
def test_marks_tell_multisets_apart(spark):
    def mark(data):
        return content(spark.createDataFrame(data, "a string, b string, c int")).first()[:]

    one = [("x", None, 1), (None, "x", 1), ("y", "y", 2), ("y", "y", 2)]
    assert mark(one) == mark(one[::-1])
    others = [one[:3] + [one[0]], one[:3], [("x", "x", 1), *one[1:]], [(None, "x", 1)] * 2 + one[2:],
              [("x", None, 1), (None, "x", 2), ("y", "y", 1), ("y", "y", 2)]]
    assert len({mark(x) for x in others} | {mark(one)}) == len(others) + 1
    assert content(spark.createDataFrame([], "a int")).first()[:] == (0, "0:0")


# --- parts ----------------------------------------------------------------------------------------
def test_only_changed_months_are_written(spark, base):
    cut = parts.by_month("Date")
    first = parts.publish(spark, base, {"t": (log(spark, 300), cut)})
    assert set(first.tables["t"].parts) == {f"2024-{m:02d}" for m in range(1, 11)} | {"none"}
    second = parts.publish(spark, base, {"t": (log(spark, 300, 7, "2024-03"), cut)})
    third = parts.publish(spark, base, {"t": (log(spark, 320, 7, "2024-03").repartition(3), cut)})
    written = folders(spark, base, "t")
    assert written[second.version] == ["2024-03"]
    assert written[third.version] == ["2024-10", "2024-11", "none"]
    assert rows(parts.read(spark, base, "t")) == rows(log(spark, 320, 7, "2024-03"))
    assert rows(parts.read(spark, base, "t", first)) == rows(log(spark, 300))
    fourth = parts.publish(spark, base, {"t": (log(spark, 320, 7, "2024-03"), cut)})
    assert fourth.version not in folders(spark, base, "t")
    assert fourth.tables == third.tables
    last = parts.publish(spark, base, {"t": (log(spark, 20), cut)})  # months that are gone
    assert set(last.tables["t"].parts) == {"2024-01", "none"}
    assert rows(parts.read(spark, base, "t")) == rows(log(spark, 20))


def test_a_table_of_another_form_is_written_whole(spark, base):
    parts.publish(spark, base, {"t": (log(spark, 60), parts.by_month("Date"))})
    wider = log(spark, 60).withColumn("more", F.lit("x"))
    m = parts.publish(spark, base, {"t": (wider, parts.by_month("Date"))})
    assert {v for v, _, _ in m.tables["t"].parts.values()} == {m.version}
    m = parts.publish(spark, base, {"t": (wider, parts.by_key(["n"], 4))})
    assert sorted(m.tables["t"].parts) == [f"{k:06d}" for k in range(4)]
    assert rows(parts.read(spark, base, "t")) == rows(wider)
    m = parts.publish(spark, base, {"t": (wider.limit(0), parts.by_key(["n"], 4))})
    assert m.tables["t"].rows == 0 and parts.read(spark, base, "t").columns == wider.columns


def test_readers_prune_by_month(spark, base):
    from shelfwise.functions.dates import in_days
    parts.publish(spark, base, {"t": (log(spark, 300), parts.by_month("Date"))})
    df = in_days(parts.read(spark, base, "t", folders=True), "Date", datetime.date(2024, 3, 9),
                 datetime.date(2024, 4, 9))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "month_of_date" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert df.columns == ["Date", "n", "v"] and df.count() == 31


def test_a_failed_publish_leaves_the_old_version(spark, base, monkeypatch):
    cut = parts.by_month("Date")
    first = parts.publish(spark, base, {"t": (log(spark, 60), cut)})
    real = parts._marks
    calls = []

    def tampered(df, column):
        calls.append(1)
        got = real(df, column)
        return got if len(calls) % 2 else {p: (n, "other") for p, (n, _) in got.items()}

    monkeypatch.setattr(parts, "_marks", tampered)
    with pytest.raises(ValueError, match="do not hold"):
        parts.publish(spark, base, {"t": (log(spark, 60, 3), cut)})
    assert parts.manifest(spark, base).version == first.version
    assert rows(parts.read(spark, base, "t")) == rows(log(spark, 60))


def test_vacuum_counts_references(spark, base):
    cut = parts.by_month("Date")
    published = [parts.publish(spark, base, {"t": (log(spark, 90, k, "2024-02"), cut)})
                 for k in range(6)]
    assert parts.vacuum(spark, base, keep=2) == []  # readers may still have the old ones
    old = parts.read(spark, base, "t", published[4])
    gone = parts.vacuum(spark, base, keep=2, min_age=0)
    assert len([g for g in gone if g.startswith("manifests")]) == 4
    assert len(files.children(spark, f"{base}/manifests")) == 2
    # January and March of the first version are still named; February has an undated row too.
    assert folders(spark, base, "t")[published[0].version] == ["2024-01", "2024-03"]
    assert published[2].version not in folders(spark, base, "t")
    assert rows(old) == rows(log(spark, 90, 4, "2024-02"))
    assert rows(parts.read(spark, base, "t")) == rows(log(spark, 90, 5, "2024-02"))


# --- whole refreshes --------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def exports(spark, tmp_path_factory):
    """Two deliveries: the second has other sales in one month, and one more movement."""
    base = str(tmp_path_factory.mktemp("exports"))
    raw = {"PRODUCT": D.raw_product(spark, SF).drop(S.ROW_ID), "SALES": D.raw_sales(spark, SF),
           "STOCK_BALANCE": D.raw_balance_wide(spark, SF),
           "STOCK_BALANCE_DETAILS": D.raw_movement(spark, SF)}
    for name, df in raw.items():
        df.write.parquet(f"{base}/one/{name}.parquet")
        kept = spark.read.parquet(f"{base}/one/{name}.parquet")
        if name == "SALES":
            may = F.col("Date").endswith("/05/1997")
            kept = kept.withColumn("Net Sales Quantity", F.when(may, F.lit("1.5")).otherwise(
                F.col("`Net Sales Quantity`")).cast(kept.schema["Net Sales Quantity"].dataType))
        if name == "STOCK_BALANCE_DETAILS":
            more = kept.limit(1).withColumn("Date", F.lit("09/07/2001"))
            kept = kept.unionByName(more)
        kept.write.parquet(f"{base}/two/{name}.parquet")
    return base


def test_incremental_refreshes_equal_full_ones(spark, exports, base):
    kept = {}
    for delivery in ("one", "two"):
        m = run_incremental(spark, f"{exports}/{delivery}", f"{base}/parts", D.RUN_DATE, "parquet",
                            D.HOUSE)
        run_refresh(spark, f"{exports}/{delivery}", f"{base}/full-{delivery}", D.RUN_DATE,
                    "parquet", D.HOUSE)
        for name in S.STAGED:
            full = lake.current(spark, f"{base}/full-{delivery}", name)
            part = parts.read(spark, f"{base}/parts", name)
            assert part.columns == full.columns
            assert content(part).first()[:] == content(full).first()[:], name
        kept[delivery] = m
    fresh = {n: sorted(p for p, x in t.parts.items() if x[0] == kept["two"].version)
             for n, t in kept["two"].tables.items()}
    assert fresh["stg_sales"] == ["1997-05"] and fresh["stg_stock_movement"] == ["2001-07"]
    assert fresh["stg_product"] == fresh["stg_stock_balance"] == []
    assert len(fresh["stg_stock_aging"]) <= 1  # the bucket of the one pair that moved


def test_a_repeated_refresh_writes_and_joins_nothing(spark, exports, base, monkeypatch):
    first = run_incremental(spark, f"{exports}/one", base, D.RUN_DATE, "parquet", D.HOUSE)
    from shelfwise.plans import incremental
    with monkeypatch.context() as m:
        m.setattr(incremental, "declared_keys", lambda *a: pytest.fail("derived tables were made"))
        again = run_incremental(spark, f"{exports}/one", base, D.RUN_DATE, "parquet", D.HOUSE)
    assert again.tables == first.tables
    later = run_incremental(spark, f"{exports}/one", base, D.RUN_DATE + datetime.timedelta(40),
                            "parquet", D.HOUSE, keep=1)
    changed = {n for n, t in later.tables.items() if t != first.tables[n]}
    assert changed == {"stg_stock_aging"}
    assert os.listdir(f"{base}/manifests")

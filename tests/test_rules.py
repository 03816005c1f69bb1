"""Every cleaning and ageing rule against its table of cases."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import schemas as S
from shelfwise.functions import ageing as A
from shelfwise.functions import clean as C

DATE = datetime.date


def values(spark, column, cells, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(cells)], f"i int, c {dtype}")
    return [r[0] for r in df.orderBy("i").select(column.alias("x")).collect()]


BLANKS = [None, "", "  ", "nan", "None", "\tNaT ", "<NA>", "  ", "\x1c\x1f"]


def test_blank_str(spark):
    cells = BLANKS + ["NAN", "none", " a b ", "\tx ", "　é ", "~", "\x85z", "naïve"]
    want = [""] * len(BLANKS) + ["NAN", "none", "a b", "x", "é", "~", "z", "naïve"]
    assert values(spark, C.blank_str(F.col("c")), cells) == want


def test_strip_is_pythons_strip(spark):
    exotic = [c for c in map(chr, range(0x3001)) if c.isspace()]
    assert sorted(S.WHITESPACE) == exotic
    cells = [f"{c}{c} a{c}b {c}" for c in exotic] + ["\x7fa\x7f", "é ", "a\x00", " \t", "!"]
    want = [c.strip() for c in cells]
    assert values(spark, C.strip_ws(F.col("c")), cells) == want
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, `c.d` string")
    got = C.strip_fields(df, "c.d").orderBy("i").collect()
    assert [r["c.d"] for r in got] == want


def test_category(spark):
    cells = BLANKS + [" phones ", "none", "straße"]
    want = ["UNCATEGORISED"] * len(BLANKS) + ["PHONES", "NONE", "STRASSE"]
    assert values(spark, C.clean_category(F.col("c")), cells) == want


@pytest.mark.parametrize("category, brand, want", [
    ("oraimo", None, "ORAIMO"),
    ("Phones", " ", "PHONES - UNBRANDED"),
    (None, None, "UNCATEGORISED - UNBRANDED"),
    ("Phones", " tecno ", "TECNO"),
    ("ORAIMO CABLES", None, "ORAIMO CABLES - UNBRANDED"),
    ("oraimo", "oraimo battery", "ORAIMO BATTERY"),
    ("oraimo", "None", "ORAIMO"),
])
def test_brand(spark, category, brand, want):
    df = spark.createDataFrame([(category, brand)], "k string, b string")
    brand_rule = C.clean_brand(C.clean_category(F.col("k")), F.col("b"))
    assert df.select(brand_rule).first()[0] == want


def test_brand_with_other_house(spark):
    df = spark.createDataFrame([("acme", None), ("oraimo", None)], "k string, b string")
    got = df.select(C.clean_brand(C.clean_category(F.col("k")), F.col("b"), "ACME")).collect()
    assert [r[0] for r in got] == ["ACME", "ORAIMO - UNBRANDED"]


def test_product_no(frame):
    df = frame(["p"], ("A1",), (None,), (" b2 ",), ("",))
    got = df.orderBy("_row_id").select(C.clean_product_no(F.col("p"), F.col("_row_id"))).collect()
    assert [r[0] for r in got] == ["A1", "UNSPECIFIED-1", "b2", "UNSPECIFIED-3"]


def test_product_no_without_row_ids(frame):
    good = frame(["p"], ("A1",), row_ids=False)
    assert good.select(C.clean_product_no(F.col("p"), None)).first()[0] == "A1"
    bad = frame(["p"], ("A1",), (" ",), row_ids=False)
    with pytest.raises(Exception, match="without row ids"):
        bad.select(C.clean_product_no(F.col("p"), None)).collect()


def test_channel_and_texts(spark):
    assert values(spark, C.clean_channel(F.col("c")), [" retail ", None]) == ["RETAIL", "UNSPECIFIED"]
    assert values(spark, C.clean_text(F.col("c"), S.UNSPECIFIED_STORE), [" Main st ", "nan"]) == [
        "Main st", "UNSPECIFIED STORE"]


def test_dates(spark):
    cells = ["01/02/2024", "1/2/2024", "31/02/2024", "2024-01-02", "01/02/24",
             "01/02/2024 10:00", "x", None, " 01/02/2024", "29/02/2024", "29/02/2023"]
    want = [DATE(2024, 2, 1)] * 2 + [None] * 7 + [DATE(2024, 2, 29), None]
    assert values(spark, C.parse_date(F.col("c"), T.StringType()), cells) == want


def test_real_dates_pass_through(spark):
    assert values(spark, C.parse_date(F.col("c"), T.DateType()), [DATE(2024, 2, 1)], "date") == [
        DATE(2024, 2, 1)]


def test_numbers(spark):
    cells = ["1.5", " 2 ", "-3", "1e2", "1,234", "12.5%", "x", "", None, "1d", "inf", "NaN"]
    got = values(spark, C.to_number(F.col("c")), cells)
    assert [None if v is None else float(v) for v in got] == [1.5, 2, -3, 100] + [None] * 8
    stock = values(spark, C.zero_filled(F.col("c")), [None, "x", "1,234", "-3"])
    assert [float(v) for v in stock] == [0, 0, 0, -3]


def test_counts(spark):
    cells = ["2", "2.0", " 3 ", "x", None, "99999999999"]
    assert values(spark, C.to_whole(F.col("c")), cells) == [2, 2, 3, None, None, None]


BUCKETS = [(-1, "No Movement Data"), (None, "No Movement Data"), (0, "0-15 Days"),
           (15, "0-15 Days"), (16, "16-30 Days"), (30, "16-30 Days"), (31, "31-45 Days"),
           (45, "31-45 Days"), (46, "46-60 Days"), (60, "46-60 Days"), (61, "61-90 Days"),
           (90, "61-90 Days"), (91, "90+ Days"), (5000, "90+ Days")]


def test_buckets(spark):
    ages = [a for a, _ in BUCKETS]
    assert values(spark, A.aging_bucket(F.col("c")), ages, "int") == [b for _, b in BUCKETS]
    names = ["No Movement Data"] * 2 + ["Healthy"] * 2 + ["Watch"] * 2 + ["Review"] * 2 + [
        "Slow Moving"] * 2 + ["Critical"] * 2 + ["Dead Stock"] * 2
    assert values(spark, A.aging_status(F.col("c")), ages, "int") == names
    assert values(spark, A.bucket_order(F.col("c")), ages, "int") == [
        7, 7, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 6, 6]


def test_aged_flag(spark):
    got = values(spark, A.is_aged(F.col("c")), [44, -1, None, 45, 46], "int")
    assert got == [False, False, False, True, True]
    assert values(spark, A.is_aged(F.col("c"), 10), [9, 10], "int") == [False, True]


@pytest.mark.parametrize("dtype", [T.TimestampNTZType(), T.TimestampType()])
def test_age_is_rounded_down(spark, dtype):
    at = datetime.datetime
    cells = [at(2024, 5, 1, 10), at(2024, 5, 1), at(2024, 4, 30, 23, 59), at(2024, 4, 29), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(cells)],
                               T.StructType([T.StructField("i", T.IntegerType()),
                                             T.StructField("c", dtype)]))
    got = df.orderBy("i").select(A.age_days(DATE(2024, 5, 1), F.col("c"), dtype)).collect()
    assert [r[0] for r in got] == [-1, 0, 0, 2, None]


def test_missing_value_texts(spark):
    cells = list(S.NA_TOKENS) + ["na", " NA", "none", "0", "NAN"]
    assert values(spark, C.null_na(F.col("c")), cells) == [None] * len(S.NA_TOKENS) + [
        "na", " NA", "none", "0", "NAN"]

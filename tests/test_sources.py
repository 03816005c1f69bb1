"""Reading exports: missing values, headers, row positions."""

import pytest
from pyspark.sql import functions as F

from shelfwise import schemas as S
from shelfwise.sources.exports import read_all, read_raw, unique_headers
from shelfwise.sources.row_ids import (
    MARKS, join_offsets, mark_rows, number_rows, split_offsets, with_row_ids,
)

MOVEMENT = list(S.RAW_REQUIRED["stock_balance_details"])


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def product_csv(path, *rows):
    header = ",".join(S.RAW_REQUIRED["product"]) + ",Extra"
    return write(path, header, *rows)


def test_product_csv(spark, tmp_path):
    path = product_csv(
        tmp_path / "PRODUCT.csv",
        '1001,"Cable, 2m",T,phones,NA,s1,pcs,1.5,2,3,,007,x',
        'NULL,n,T,None,b,s2,pcs,1,2,3,4,,y',
        '  ,"say ""hi""",T,none,b,#N/A,pcs,1,2,3,4,1e3,z')
    rows = read_raw(spark, "product", path).orderBy("_row_id").collect()
    assert [r["_row_id"] for r in rows] == [0, 1, 2]
    assert [r["Product No."] for r in rows] == ["1001", None, "  "]
    assert [r["Product Name"] for r in rows] == ["Cable, 2m", "n", 'say "hi"']
    assert [r["Category"] for r in rows] == ["phones", None, "none"]
    assert [r["Brand"] for r in rows] == [None, "b", "b"]
    assert [r["SKU No."] for r in rows] == ["s1", "s2", None]
    assert [r["Product Barcode"] for r in rows] == ["007", None, "1e3"]
    assert [r["Extra"] for r in rows] == ["x", "y", "z"]


def test_missing_column_stops_at_plan_time(spark, tmp_path):
    path = write(tmp_path / "p.csv", "Product No.,Brand", "1,b")
    with pytest.raises(ValueError, match="Category"):
        read_raw(spark, "product", path)


def test_repeated_and_case_variant_headers(spark, tmp_path):
    assert unique_headers(["a", "b", "a", "a.1", "a", "A"]) == ["a", "b", "a.2", "a.1", "a.3", "A"]
    ids = "Product No.,Product Name,SKU No.,Category,Brand,Unit of Measurement"
    path = write(tmp_path / "b.csv", ids + ",X- Stock on Hand,X- Stock on Hand,x- Stock on Hand",
                 "1,n,s,c,b,u,5,6,7")
    df = read_raw(spark, "stock_balance", path)
    assert df.columns[6:9] == ["X- Stock on Hand", "X- Stock on Hand.1", "x- Stock on Hand"]
    assert list(df.collect()[0])[6:9] == ["5", "6", "7"]


def test_odd_header_texts(spark, tmp_path):
    ids = "Product No.,Product Name,SKU No.,Category,Brand,Unit of Measurement"
    path = write(tmp_path / "b.csv", ids + ",O'H `x`. (1)- Stock on Hand,", "1,n,s,c,b,u,5,y")
    df = read_raw(spark, "stock_balance", path)
    assert df.columns[6:] == ["O'H `x`. (1)- Stock on Hand", "Unnamed: 7", "_row_id"]
    assert list(df.first())[6:] == ["5", "y", 0]


def test_files_with_other_headers_are_refused(spark, tmp_path):
    folder = tmp_path / "movement"
    write(folder / "a.csv", ",".join(MOVEMENT), ",".join("a" * len(MOVEMENT)))
    write(folder / "b.csv", ",".join(reversed(MOVEMENT)), ",".join("b" * len(MOVEMENT)))
    with pytest.raises(Exception, match="CSV header"):
        read_raw(spark, "stock_balance_details", str(folder)).collect()


def numbered(i):
    return ",".join([str(i), *["x"] * (len(MOVEMENT) - 1)])


@pytest.mark.parametrize("by_marks", [False, True])
def test_row_positions_over_splits_and_files(spark, tmp_path, by_marks):
    """Files of many splits each: positions are those of the files read one after another."""
    folder = tmp_path / "movement"
    sizes, start = [700, 3, 1900, 0, 41], 0
    for n, size in enumerate(sizes):
        write(folder / f"part-{n}.csv", ",".join(MOVEMENT),
              *[numbered(i) for i in range(start, start + size)])
        start += size
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes",
                                          "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "512")
        df = read_raw(spark, "stock_balance_details", str(folder),
                      row_ids="marks" if by_marks else True)
        assert df.rdd.getNumPartitions() > 10
        if by_marks:  # written with the marks, positions worked out on reading back
            df.select("`Product No.`", *MARKS).toDF("c0", *MARKS).write.parquet(
                str(tmp_path / "marked"))
            spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
            df = number_rows(spark.read.parquet(str(tmp_path / "marked")), True).toDF(
                "Product No.", "_row_id")
        rows = df.select("`Product No.`", "_row_id").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(rows) == sum(sizes)
    assert all(int(r["Product No."]) == r["_row_id"] for r in rows)


def test_row_positions_of_parquet(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 5000, 1, 7).write.option("parquet.block.size", 2048).parquet(path)
    rows = with_row_ids(spark.read.parquet(path)).collect()
    assert sorted(r["_row_id"] for r in rows) == list(range(5000))
    assert all(r["id"] == r["_row_id"] for r in rows)


def test_positions_only_where_wanted(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 1000, 1, 5).write.parquet(path)
    df = with_row_ids(spark.read.parquet(path), where=F.col("id") % 100 == 7)
    assert {r["id"]: r["_row_id"] for r in df.collect()} \
        == {i: i if i % 100 == 7 else None for i in range(1000)}


def test_a_missing_offset_fails_and_loses_no_row(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 100, 1, 5).write.parquet(path)
    marked = mark_rows(spark.read.parquet(path))
    some = split_offsets(marked).orderBy("_file").limit(4)
    assert join_offsets(marked, some).count() == 100
    with pytest.raises(Exception, match="no row offset"):
        join_offsets(marked, some).collect()


BROKEN_ROWS = ['1,"two', 'lines",T,c,b,s,u,1,2,3,4,5,x', "2,n,T,c,b,s,u,1,2,3,4,5,x,more,cells",
               "3,n,T", "4,n,T,c,b,s,u,1,2,3,4,5,x"]


def test_broken_records_fail_or_are_marked(spark, tmp_path):
    path = product_csv(tmp_path / "PRODUCT.csv", *BROKEN_ROWS)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        read_raw(spark, "product", path).select("`Product No.`").collect()
    rows = read_raw(spark, "product", path, row_ids=False, broken=True).collect()
    assert [r[S.BROKEN] is None for r in rows] == [False, False, False, False, True]


def test_line_breaks_inside_cells(spark, tmp_path):
    path = product_csv(tmp_path / "PRODUCT.csv", BROKEN_ROWS[0], BROKEN_ROWS[1], BROKEN_ROWS[4])
    rows = read_raw(spark, "product", path, options={"multiLine": "true"}).collect()
    assert [(r["Product Name"], r["_row_id"]) for r in rows] == [("two\nlines", 0), ("n", 1)]


def test_table_source(spark, frame):
    frame(S.RAW_REQUIRED["product"], tuple("abcdefghijkl")).write.saveAsTable("raw_product_t")
    df = read_raw(spark, "product", "raw_product_t", fmt="table")
    assert df.columns[-1] == "_row_id" and df.count() == 1
    spark.sql("DROP TABLE raw_product_t")


def test_read_all_is_lazy_about_rows(spark, tmp_path):
    headers = {"PRODUCT": S.RAW_REQUIRED["product"], "SALES": S.STG_SALES.names,
               "STOCK_BALANCE": [*S.RAW_REQUIRED["stock_balance"], "A- Stock on Hand"],
               "STOCK_BALANCE_DETAILS": MOVEMENT}
    for stem, names in headers.items():
        write(tmp_path / f"{stem}.csv", ",".join(names), ",".join("1" for _ in names))
    raw = read_all(spark, str(tmp_path))
    assert set(raw) == {"product", "sales", "stock_balance", "stock_balance_details"}
    assert [raw[t].count() for t in raw] == [1, 1, 1, 1]


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="xlsx"):
        read_raw(spark, "product", "p", fmt="xlsx")


class _Session:
    """Stands in for the session of a cluster."""

    def __init__(self, master, **settings):
        self.conf, self.sparkContext, self.master = settings, self, master


@pytest.mark.parametrize("master, settings, good", [
    ("yarn", {"spark.sql.warehouse.dir": "file:/tmp/warehouse"}, False),
    ("spark://host:1", {"spark.sql.warehouse.dir": "/tmp/warehouse"}, False),
    ("yarn", {"spark.sql.warehouse.dir": "hdfs://name/warehouse"}, True),
    ("yarn", {"spark.sql.warehouse.dir": "/tmp/w", "spark.checkpoint.dir": "/shared"}, True),
    ("local[4]", {"spark.sql.warehouse.dir": "file:/tmp/warehouse"}, True)])
def test_scratch_tables_go_to_a_shared_folder(master, settings, good):
    from shelfwise.session import shared_dir
    session = _Session(master, **settings)
    if good:
        base = settings.get("spark.checkpoint.dir") or settings["spark.sql.warehouse.dir"] + "/scratch"
        assert shared_dir(session, "x").startswith(f"{base}/x-")
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(session, "x")

"""What the pipeline's language stage sends to Python."""

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm import language, store


def test_texts_go_to_python_in_short_batches(spark, monkeypatch):
    """Not 10,000 texts or Spark's 64 MB at once, and settings are as before."""
    docs = spark.range(0, 300, 1, 1).select(
        F.col("id").alias("doc_id"), F.lit("some words " * 10_000).alias("text"),
        F.lit("en").alias("lang"))
    before = spark.conf.get(store.BATCH_BYTES)

    def sized(docs, model, keep):
        schema = T.StructType([*[docs.schema[c] for c in keep],
                               T.StructField("lang_pred", T.StringType()),
                               T.StructField("score", T.DoubleType())])

        def run(batches):
            for batch in batches:
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(["en"] * n),
                     pa.array([float(batch.nbytes < 8 << 20)] * n)], names=schema.names)
        return docs.select(*keep, "text").mapInArrow(run, schema)

    monkeypatch.setattr(language, "identify", sized)
    assert language.accepted_documents(docs).count() == 300
    assert spark.conf.get(store.BATCH_BYTES) == before


def test_rows_that_come_twice_stay_twice(spark, tmp_path):
    """Each row is judged for itself, whatever its id; all columns come back as they are."""
    rows = [(1, "these are some words", "en", [1, None]), (1, "these are some words", "en", None),
            (1, None, "en", [2]), (None, "these are some words", None, [3]), (2, "12 34", None, None),
            (2, "und das sind Worte", "de", [4]), (2, "", "de", [4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, `more.of it` array<int>")
    docs.repartition(3).write.parquet(str(tmp_path / "d"))
    want = sorted((r for r in rows if r[1] and r[1][0] in "tu"), key=repr)
    for given in (docs, spark.read.parquet(str(tmp_path / "d"))):
        out = language.accepted_documents(given)
        assert out.columns == docs.columns and out.schema == docs.schema
        assert sorted(map(tuple, out.collect()), key=repr) == want

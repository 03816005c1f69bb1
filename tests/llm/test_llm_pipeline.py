"""The pipeline stage by stage against plain computations, and its contract."""

from collections import Counter

import corpus_pipeline as pipeline
import plain
import pytest

from shelfwise.llm.store import materialise
from test_llm_operators import _frame as odd_frame
from test_llm_operators import _rows as odd_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    """The input of each stage, and the result."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def test_stages_in_order(tables):
    assert [n for n, _ in pipeline.STAGES] \
        == ["language", "jaccard", "decontamination", "mixing", "sharding"]
    assert all(t.columns == tables[0].columns for t in tables[:-1])


def test_language_keeps_documents_with_a_language(tables):
    assert tables[1].count() == tables[0].count()


def test_one_document_of_each_group_stays(tables):
    rows = [(r.doc_id, r.text) for r in tables[1].collect()]
    want = {c for _, c in plain.components(rows)}
    assert {r.doc_id for r in tables[2].collect()} == want and tables[2].count() == len(want)


def test_leaks_go_and_others_stay(spark, tables):
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    short = {r.doc_id: r.text for r in tables[2].collect() if len(r.text) < 4000}
    left = {r.doc_id for r in tables[3].collect()}
    for d, text in short.items():
        assert (d not in left) == any(plain.overlaps(text, b) for b in items)


def test_mix_has_the_target_words(tables):
    sizes, taken = Counter(), Counter()
    for r in tables[3].collect():
        sizes[r.source] += len(plain.words(r.text))
    for r in tables[4].collect():
        taken[r.source] += len(plain.words(r.text))
    want = plain.targets(sizes)
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)


def test_run_is_the_stages(spark, tables):
    got = pipeline.run(spark, SF)
    assert got.columns == tables[-1].columns
    key = lambda r: (r.doc_id, r.size, r.text_crc32, r.shard, r.slot)
    assert sorted(map(key, got.collect())) == sorted(map(key, tables[-1].collect()))


def test_odd_rows_and_clashing_names(spark, tmp_path):
    """Every stage on its own over nulls, blanks, long texts, repeated rows and extra columns."""
    path = str(tmp_path / "documents.parquet")
    odd_frame(spark, odd_rows()).repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        texts = {r.text for r in docs.collect()}
        assert out.count() > 0 and (name == "mixing" or {r.text for r in out.collect()} <= texts)
    got = pipeline.STAGES[-1][1](spark, docs, SF)
    assert got.count() == docs.count()


def test_no_rows(spark, tables, tmp_path):
    docs = tables[0].limit(0)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0

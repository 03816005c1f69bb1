"""Registered operators against their SQL, and all of them for their columns."""

import pytest

import __spark_entry__ as contract
from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
COLUMNS = {
    1: ["doc_id", "held_out", "lang_pred", "score"],
    2: ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept"],
    3: ["doc_id", "held_out", "score", "predicted"],
    4: ["doc_id", "size", "source_size", "target", "taken"],
    5: ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    6: ["doc_id", "n_words", "n_removed", "kept_sha256"],
    7: ["doc_id", "item_id", "doc_word", "equal_words"],
    8: ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    9: ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    10: ["doc_id", "n_shingles", "component_id"],
    11: ["vec_id", "code", "error", "label_error", "codebooks_sha256"],
    12: ["doc_id", "fingerprint", "component_id"],
    13: ["doc_id", "n_features", "weight", "score", "rank"],
}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(n for n in contract.oracle_sql() if n.startswith("op")))
def test_against_sql(spark, con, name):
    assert compare(spark, con, name, contract.queries()[name], contract.oracle_sql()[name], SF) == ""


@pytest.mark.parametrize("n", sorted(COLUMNS))
def test_columns(spark, n):
    name, = [q for q in contract.queries() if q.startswith(f"op{n}_")]
    assert contract.queries()[name](spark, SF).columns == COLUMNS[n]

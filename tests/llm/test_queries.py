"""Registered text queries against SQL where SQL can express them, else their shape."""

import pytest

import __spark_entry__ as contract
from parity import SF_DIR, connect, differences


@pytest.mark.parametrize("name", sorted(contract.LLM_ORACLES))
def test_matches_sql(spark, name):
    query = contract.queries()[name]
    assert differences(query(spark, SF_DIR), connect(SF_DIR), contract.LLM_ORACLES[name]) is None


def test_language_is_learned_and_predicted(spark):
    found = contract.queries()["op7_language_id"](spark, SF_DIR)
    truth = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(truth, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows) > 0
    assert all(0 <= r.score <= 1 for r in rows)


def test_pipeline_keeps_clean_documents(spark):
    out = contract.queries()["pipeline"](spark, SF_DIR)
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    total = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert 0.5 * total < out.count() < total

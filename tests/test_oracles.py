"""Every registered query against its SQL, on the smallest tables unless TEST_SF_DIR is set."""

import subprocess
import sys

import pytest

import __spark_entry__ as contract
from parity import SF_DIR, connect, differences

# Text queries have their own tests, as far as SQL can express them.
QUERIES = {name: q for name, q in contract.queries().items() if name not in contract.LLM_QUERIES}
ORACLES = {name: sql for name, sql in contract.oracle_sql().items() if name not in contract.LLM_ORACLES}


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SF_DIR), connection, ORACLES[name]) is None


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns[:2] == ["c_nationkey", "c_mktsegment"]
    assert result.count() > 0


def test_queries_load_without_what_the_text_part_needs():
    code = "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    found = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=contract.__file__.rpartition("/")[0], check=True)
    assert found.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))]

"""Every registered query against its SQL oracle, on the smallest tables."""

import pytest

import __spark_entry__ as entry
import oracle

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return oracle.connect(FOLDER)


#: held against brute force, round trips or other libraries in tests/llm
WITHOUT_SQL = {
    "op3_pii_pseudonyms", "op5_quality_rules", "op10_best_fit_packing", "op12_sentencepiece", "pipeline",
}


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_agrees_with_its_oracle(spark, database, name):
    ok, _, detail = oracle.compare(spark, database, FOLDER, name)
    assert ok, detail


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(entry.queries()) - set(entry.oracle_sql()) <= WITHOUT_SQL
    assert entry.entry(spark).columns == ["user_id", "event_type", "value", "__START_AT", "__END_AT"]

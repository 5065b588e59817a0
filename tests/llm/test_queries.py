"""The registered queries: SQL twins, and one row per document where the contract says so."""

import re

import pytest

import __spark_entry__ as entry
from oracle import compare, connect
from sparkloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_all_queries_are_registered():
    names = {m[1] for n in QUERIES if (m := re.match(r"(op\d+)_", n))}
    assert names == {f"op{i}" for i in range(1, 14) if f"op{i}" in names} and "pipeline" in QUERIES and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_query_equals_sql(spark, sf, con, name):
    ok, message = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], sf)
    assert ok, message


@pytest.mark.parametrize("name", ["op1_suffix_dedup", "op4_simhash_ball", "op5_skip_chain_pii", "op6_sp_wfst", "op7_huffman_ids",
                                  "op8_subword_classifier"])
def test_one_row_per_document(spark, sf, name):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = [r["doc_id"] for r in entry.queries()[name](spark, sf).select("doc_id").collect()]
    assert sorted(got) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())


def test_leaks_are_few(spark, sf):
    got = entry.queries()["op3_spaced_seeds"](spark, sf).collect()
    assert 0 < len({r["doc_id"] for r in got}) < 0.2 * spark.read.parquet(f"{sf}/documents.parquet").count()

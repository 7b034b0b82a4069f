"""The corpus queries on the given tables: SQL where there is some, and what each result must hold."""

import glob
import hashlib
import os

import pytest

duckdb = pytest.importorskip("duckdb")

from varstrata.llm.queries import LLM_ORACLE, LLM_QUERIES  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.sql(f"create view {os.path.basename(path).removesuffix('.parquet')} as select * from '{path}'")
    return connection


def as_lists(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(columns), sorted([str(row[i]) for i in order] for row in rows)


def test_all_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_sql(spark, engine, name):
    ours, theirs = LLM_QUERIES[name](spark, SF), engine.sql(LLM_ORACLE[name])
    assert as_lists(ours.columns, ours.collect()) == as_lists(theirs.columns, theirs.fetchall())


@pytest.mark.parametrize("name", sorted(set(LLM_QUERIES) - set(LLM_ORACLE) - {"op3_secret_scan", "op11_prefix_trie"}))
def test_one_row_for_each_document(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id")
    out = LLM_QUERIES[name](spark, SF).select("doc_id")
    assert docs.exceptAll(out).isEmpty() and out.exceptAll(docs).isEmpty()


def test_pii_digests(spark):
    from test_pii import plain
    from varstrata.llm.pii import KINDS

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in LLM_QUERIES["op4_pii"](spark, SF).collect():
        spans = plain(texts[r.doc_id] or "")
        told = ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)
        assert r.base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert [r[f"n_{kind}"] for kind in KINDS] == [sum(k == i for k, _, _ in spans) for i in range(4)]
        assert set(told.split(",")) - {""} <= set(r.spans.split(","))

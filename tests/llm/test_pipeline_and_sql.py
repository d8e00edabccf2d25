"""Stages of the pipeline on their own inputs, and queries against their SQL."""

import os

import corpus_pipeline as C
import pytest

from legworks.llm import decontaminate as D, mixing as M, ngram_join as J, queries as Q
from legworks.llm import toxicity as X
from legworks.llm.common import table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF}/documents.parquet"),
                                reason="test tables not present")


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_stages_follow_their_operators(spark):
    docs = table(spark, SF, "documents")
    seen = {}
    for name, stage in C.STAGES:
        before = docs
        docs = stage(spark, docs, SF).cache()
        seen[name] = (before, docs)
        if name != "sharding":
            assert docs.columns == before.columns
    before, after = seen["toxicity"]
    bad = {r.doc_id for r in X.toxicity(before, table(spark, SF, "labels")).collect() if r.predicted}
    assert rows_of(after) == sorted(r for r in rows_of(before) if r[0] not in bad)
    before, after = seen["near_duplicates"]
    first = {r.doc_id for r in J.ngram_join(before).collect() if r.class_id == r.doc_id}
    assert rows_of(after) == sorted(r for r in rows_of(before) if r[0] in first)
    assert {r.class_id for r in J.ngram_join(after).collect()} == first
    before, after = seen["decontamination"]
    hit = {r.doc_id for r in D.decontaminate(before, table(spark, SF, "benchmark")).collect()
           if r.contaminated}
    assert rows_of(after) == sorted(r for r in rows_of(before) if r[0] not in hit)
    before, after = seen["mixing"]
    taken = {r.doc_id: r.taken // max(r["size"], 1) for r in M.mix_plan(before).collect()}
    copies = [r for r in rows_of(before) for _ in range(taken[r[0]])]
    assert [r for r in rows_of(after) if r[1].split()] == sorted(copies)
    before, after = seen["sharding"]
    assert after.count() == before.count()
    assert {r.shard for r in after.collect()} == set(range(8))


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_equals_its_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = Q.QUERIES[name](spark, SF)
    cur = con.execute(Q.ORACLE[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    norm = lambda v: round(v, 6) if isinstance(v, float) else v
    got = sorted(tuple(norm(r[c]) for c in columns) for r in df.collect())
    want = sorted(tuple(map(norm, r)) for r in cur.fetchall())
    assert list(map(str, got)) == list(map(str, want))


def test_registered_queries():
    assert [q.split("_")[0] for q in Q.QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert 4 <= len(C.STAGES) <= 5

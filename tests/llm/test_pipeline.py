"""The registered queries, and the pipeline against its stages' own rules."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from fiscalgrove.llm import decontaminate, quality
from fiscalgrove.llm.queries import QUERIES, SQL
from fiscalgrove.llm.shared import table
from tests.llm.conftest import TESTDATA
from tests.llm.test_operators import PATTERNS
from tests.llm.test_similar import plain_representatives


def test_all_are_registered():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{TESTDATA}/{t}.parquet')")
    df = QUERIES[name](spark, TESTDATA)
    cur = con.execute(SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect()), key=repr) == sorted(cur.fetchall(), key=repr)


@pytest.mark.parametrize("name", ["op2_license_scan", "op5_quality", "op10_personal_data", "op11_hilbert"])
def test_native_plans(spark, name):
    plan = QUERIES[name](spark, TESTDATA)._jdf.queryExecution().executedPlan().toString()
    assert not any(bad in plan for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"))


def test_pipeline(spark):
    docs = table(spark, TESTDATA, "documents")
    kept = {}
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, TESTDATA)
        if name != "mixture":
            assert at.columns == docs.columns
        kept[name] = at.collect()
        at = spark.createDataFrame(kept[name], at.schema)
    ids = {n: [r["doc_id"] for r in rows] for n, rows in kept.items()}
    judged = {r["doc_id"] for r in quality.assess(docs).collect() if r["kept"]}
    assert set(ids["quality_rules"]) == judged
    good = docs.where(F.col("doc_id").isin(sorted(judged)))
    assert sorted(ids["near_duplicates"]) == plain_representatives([(r["doc_id"], r["text"].encode().lower().decode()) for r in good.collect()])
    hit = {r["doc_id"] for r in decontaminate.contamination(good, table(spark, TESTDATA, "benchmark")).collect() if r["contaminated"]}
    assert set(ids["decontamination"]) == set(ids["near_duplicates"]) - hit and hit
    assert sorted(ids["personal_data"]) == sorted(ids["decontamination"])
    for r in kept["personal_data"]:
        assert r["n_chars"] == len(r["text"]) and not re.search(PATTERNS[0], r["text"])
    assert set(ids["mixture"]) <= set(ids["personal_data"]) and {"mix_shard", "mix_place", "mix_round"} <= set(at.columns)

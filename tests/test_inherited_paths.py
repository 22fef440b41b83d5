"""Ancestor paths that bring fields along: same rows as joins, one shuffle, no files left of the steps before."""

import datetime
import glob
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fiscalgrove.catalog import catalogue_from_mapping
from fiscalgrove.operators.columns import project_superset
from fiscalgrove.operators.lookup import handed_down, inherit_by_map
from fiscalgrove.operators.tree import chunk_carries, link_parents
from fiscalgrove.sources.records import tag_records, with_cols
from workbench import records

CATALOGUE = catalogue_from_mapping({"0000": "CO", "A": "A1 A2", "B": "B1", "C": "C1", "D": "D1"})
RULES = [{"parent": "0000", "children": ["A"]}, {"parent": "A", "children": ["B"]}, {"parent": "B", "children": ["C"], "children_override": ["D"]}]
MAP = {"A": {"from": "0000", "fields": ["CO"]}, "B": [{"from": "A", "fields": ["A1"]}, {"from": "0000", "fields": [{"CO": "OF"}]}],
       "C": [{"from": "B", "fields": ["B1"]}, {"from": "A", "fields": ["A1", {"A2": "X"}]}, {"from": "0000", "fields": ["CO"]}], "D": {"from": "0000", "fields": ["CO"]}}


def lines_of(spark, seed=3):
    """Four files with gaps, one without a root, one without a name; some parents and lines twice, some lines without a number."""
    rnd, lines = random.Random(seed), []
    for f in ("f0", "f1", "f2", None):
        regs = ["0000"] * (f != "f1") + rnd.choices(["A", "B", "C", "D", "Z", "0000"], [3, 4, 8, 2, 1, .4], k={"f0": 3, "f1": 60}.get(f, 250))
        for i, r in enumerate(regs):
            lines += [(f, i * rnd.choice([1, 1, 9]) if i % 50 == 0 else i * 3, f"|{r}|{r}{i}|v{i % 7}|")] * (2 if rnd.random() < .1 else 1)
        lines += [(f, None, "|C|lost|"), (f, None, "|Z|lost|")]
    return tag_records(spark.createDataFrame(lines, "_source_file string, _row_id long, value string"))


def counted(df, *cols):
    return Counter(tuple(str(x) for x in r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("chunk_bits", [1, 4, 18])
def test_brought_fields_are_those_of_joins(spark, chunk_bits):
    lines = lines_of(spark).localCheckpoint()
    brings = handed_down(MAP, CATALOGUE, F.split("value", r"\|"))
    joined = link_parents(lines, RULES, chunk_bits=chunk_bits, path_col="up")
    brought = link_parents(lines, RULES, chunk_bits=chunk_bits, path_col="up", brings=brings,
                           carried=chunk_carries(lines, RULES, chunk_bits=chunk_bits, brings=brings).localCheckpoint())
    got = []
    for linked in (joined, brought):
        out = inherit_by_map(project_superset(with_cols(linked), CATALOGUE), with_cols(lines), MAP, CATALOGUE, path_col="up")
        up = F.transform("up", lambda a: F.concat(a["reg"], F.lit(":"), a["id"])).alias("up")
        got.append(counted(out, "_source_file", "_row_id", "REG", "_expected_parent", "_parent_uid_final", up, "CO", "OF", "A1", "A2", "X", "B1", "C1", "D1"))
    assert got[0] == got[1]
    assert max(got[0].values()) >= 4 and sum(got[0].values()) > lines.filter("REG <> 'Z'").count()   # ancestors that come twice
    unnamed = {r["REG"]: r["n"] for r in joined.filter("_source_file IS NULL").groupBy("REG").agg(F.max(F.size("up")).alias("n")).collect()}
    assert unnamed["C"] == 1   # lines of no file are not compared with each other


def test_chunks_get_only_parents_that_they_ask_for(spark):
    """A chunk whose lines all come after their parent gets nothing from before; others get one row."""
    rows = [("f", 0, "0000"), ("f", 1, "A"), ("f", 16, "B"), ("f", 17, "C"), ("f", 32, "B"), ("f", 33, "C"), ("f", 48, "C"), ("f", 80, "Z")]
    lines = spark.createDataFrame(rows, "_source_file string, _row_id long, REG string")
    found = {r["_t_chunk"]: [None if c is None else [a["id"] for a in c["path"]] for c in r["_t_carry"]] for r in chunk_carries(lines, RULES, chunk_bits=4).collect()}
    assert found == {1: [None, [1, 0], None], 2: [None, [1, 0], None], 3: [None, None, [32, 1, 0]]}


def shuffled(spark):
    top = os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", "/tmp")
    return {f for f in glob.glob(f"{top}/**/blockmgr-*/**/shuffle_*.data", recursive=True)}


def test_inherited_map_moves_the_lines_once(spark, tmp_path):
    day = datetime.datetime(1997, 5, 1)
    tables = {
        "nation": ([(0, "N0"), (1, "N1")], "n_nationkey int, n_name string"),
        "customer": ([(i, f"c{i}", i % 2, "SEG") for i in range(20)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        "orders": ([(i, i % 20, "F", day) for i in range(400)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp"),
        "lineitem": ([(i // 4, i % 4 + 1, i % 33) for i in range(1600)], "l_orderkey long, l_linenumber int, l_partkey long")}
    for name, (rows, kinds) in tables.items():
        spark.createDataFrame(rows, kinds).write.parquet(f"{tmp_path}/{name}.parquet")
    before = shuffled(spark)
    out = records.inherited_map(spark, str(tmp_path))
    left = sum(os.path.getsize(f) for f in shuffled(spark) - before if os.path.exists(f))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Exchange") == 1 and "Join" not in plan
    assert left < 10_000
    deep = out.filter("levels = 3").select("file", "path", "CNPJ", "PARTICIPANTE", "NUM_DOC", "DT_NOTA")
    assert out.count() == 2 + 20 + 400 + 1600 and deep.filter("PARTICIPANTE IS NULL OR NUM_DOC IS NULL OR DT_NOTA <> '01051997'").count() == 0
    assert deep.filter(F.col("CNPJ").cast("long") == F.col("file")).count() == 1600

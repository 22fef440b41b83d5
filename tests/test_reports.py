"""Report kinds: grain, left-wins names, laterals, missing record types, contracts."""

import pytest
from pyspark.sql import functions as F

from fiscalgrove.catalog import ContractError
from fiscalgrove.plans.report import compile_report
from fiscalgrove.plans.spec import HierarchySpec, registers_needed, report_kind
from tests.conftest import rows

META = "_file_id string, FILE_ID string, _row_id long, _parent_uid_final long"


def reg(spark, data, extra):
    return spark.createDataFrame([(f, f, *rest) for f, *rest in data], f"{META}, {extra}")


@pytest.fixture()
def regs(spark):
    return {
        "M500": reg(spark, [("f", 1, 0, "c1", "top"), ("f", 9, 0, "c9", "top9"), ("g", 1, 0, "cg", "topg")], "COD string, NAME string"),
        "M505": reg(spark, [("f", 2, 1, "v2", "mid2"), ("f", 3, 1, "v3", "mid3"), ("g", 2, 1, "vg", "midg")], "VAL string, NAME string"),
        "M510": reg(spark, [("f", 4, 1, "adj4"), ("f", 5, 1, "adj5")], "ADJ string"),
        "M515": reg(spark, [("f", 6, 4, "det6")], "DET string"),
    }


SPEC = {"name": "R", "base_entity": "M500", "entities": {
    "0000": {"source": "0000", "fields": []},
    "M500": {"source": "M500", "join_on": "0000", "fields": ["COD", "NAME"]},
    "M505": {"source": "M505", "join_on": "M500", "fields": ["VAL", {"NAME": "NAME"}]},
    "M510": {"source": "M510", "join_on": "M500", "fields": ["ADJ"]},
    "M515": {"source": "M515", "join_on": "M510", "fields": ["DET"]}}}


def test_chain_laterals_and_nested_laterals(spark, regs):
    out = compile_report(spark, SPEC, regs)
    # the grain is the first leaf; parents without a child row vanish; ids never cross files
    assert rows(out, "FILE_ID", "VAL", "NAME", "COD", "ADJ", "DET") == sorted([
        ("f", "v2", "mid2", "c1", "adj4", "det6"), ("f", "v2", "mid2", "c1", "adj5", None),
        ("f", "v3", "mid3", "c1", "adj4", "det6"), ("f", "v3", "mid3", "c1", "adj5", None), ("g", "vg", "midg", "cg", None, None)], key=repr)
    assert out.columns[-2:] == ["REG", "row_id"] and {r[0] for r in rows(out, "REG")} == {"M505"}


def test_missing_registers_act_as_empty(spark, regs):
    out = compile_report(spark, SPEC, {**regs, "M500": None, "M510": None})
    assert rows(out, "VAL", "COD", "ADJ", "DET") == [("v2", None, None, None), ("v3", None, None, None), ("vg", None, None, None)]
    assert compile_report(spark, SPEC, {**regs, "M505": None}).count() == 0


def test_declared_grain_and_order(spark, regs):
    spec = {**SPEC, "grain": "M500", "output_columns": ["COD", "ZZ"], "column_policy": "only_listed"}
    out = compile_report(spark, spec, regs)
    assert out.columns == ["COD", "ZZ"] and ("c9", None) in rows(out)


def test_spec_contracts():
    assert HierarchySpec.parse(SPEC).laterals == ["M510", "M515"]
    assert registers_needed(SPEC) == ["0000", "M500", "M505", "M510", "M515"]
    with pytest.raises(ContractError):
        HierarchySpec.parse({"entities": {"A": {"source": "A", "join_on": "B"}}})
    with pytest.raises(ContractError):
        report_kind({"name": "nothing"})
    loop = {"entities": {"A": {"source": "A", "join_on": "B"}, "B": {"source": "B", "join_on": "A"}}, "base_entity": "A"}
    assert HierarchySpec.parse(loop).chain == ["B"]


@pytest.mark.parametrize("change, message", [
    ({"base_entity": "Q"}, "does not exist"),
    ({"entities": {"A": {"source": "A"}, "B": {"source": "B", "join": {"type": "left"}}}}, "no join keys"),
    ({"entities": {"A": {"source": "A"}, "B": {"source": "B", "join": {"keys": [{"left": "A_UID"}]}}}}, "incomplete"),
    ({"entities": {"A": {"source": "A"}, "B": {"source": "B", "join": {"keys": [{"left": "X", "right": "B_UID"}]}}}}, "no id column"),
    ({"entities": {"A": {"source": "A"}, "B": {"source": "B", "join": {"strategy": "parent_child", "keys": [{"left": "A_UID", "right": "Z_UID"}]}}}}, "unknown entity")])
def test_keyed_contracts(spark, regs, change, message):
    spec = {"name": "K", "base_entity": "A", "entities": {"A": {"source": "A"}, "B": {"source": "B", "join": {"keys": [{"left": "A_UID", "right": "B_UID"}]}}}, **change}
    with pytest.raises(ContractError, match=message):
        compile_report(spark, spec, {})


def test_leaf_is_shuffled_once(spark, tmp_path):
    """Three levels by sort-merge: the leaf takes part in one join only."""
    base = spark.range(2000).select(F.lit("f").alias("_file_id"), F.col("id").alias("_row_id"), (F.col("id") % 50).alias("_parent_uid_final"), F.col("id").cast("string").alias("LEAF"))
    base.write.parquet(str(tmp_path / "leaf"))
    leaf = spark.read.parquet(str(tmp_path / "leaf"))
    mid = base.filter("_row_id < 50").withColumnRenamed("LEAF", "MID")
    top = base.filter("_row_id < 50").withColumnRenamed("LEAF", "TOP")
    spec = {"name": "R", "entities": {"T": {"source": "T", "fields": ["TOP"]}, "M": {"source": "M", "join_on": "T", "fields": ["MID"]}, "L": {"source": "L", "join_on": "M", "fields": ["LEAF"]}}}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = compile_report(spark, spec, {"L": leaf, "M": mid, "T": top})
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 4   # leaf, mid, top, and mid+top once more
        assert out.count() == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

"""Plans: what is pushed down, what is shuffled, and what happens to a hot key."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from fiscalgrove.operators import lookup, subsidy, tree, version
from fiscalgrove.plans.report import compile_report
from fiscalgrove.sources.tables import registers_of, write_table
from fiscalgrove.session import sized_conf
from tests.conftest import rows


@contextmanager
def conf(spark, **settings):
    names = {k.replace("__", "."): str(v) for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def skewed(spark, tmp_path):
    """A third of all lines belongs to one file."""
    path = str(tmp_path / "lines")
    spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("f"), (F.col("id") % 400).cast("string"))).alias("_file_id"),
        F.col("id").alias("_row_id"), F.when(F.col("id") < 1200, "0000").otherwise("C100").alias("REG"),
        F.xxhash64("id").cast("string").alias("v")).write.parquet(path)
    return spark.read.parquet(path)


SMALL = dict(spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
             spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB", spark__sql__adaptive__skewJoin__skewedPartitionFactor=1.5,
             spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions=16)


def test_hot_file_is_split_in_joins(spark, skewed):
    with conf(spark, **SMALL):
        heads = tree.header_of_files(skewed, {"h": F.col("v")})
        out = tree.propagate_header(skewed, heads)
        got = out.collect()
        assert "skew=true" in plan_of(out)
    want = {r["_file_id"]: r["h"] for r in heads.collect()}
    assert len(got) == 60_000 and all(r["h"] == want.get(r["_file_id"]) for r in got)


def test_hot_version_key_is_split(spark, skewed):
    df = skewed.select(F.lit("c").alias("CNPJ"), F.col("_file_id").alias("DT_INI"), (F.col("_row_id") % 2).alias("IND_REC"), "v")
    with conf(spark, **SMALL):
        out = version.latest_version(df)
        got = out.collect()
        plan = plan_of(out)
    assert "Window" not in plan and "skew=true" in plan
    hot = [r for r in got if r["DT_INI"] == "hot"]
    assert len(hot) == 10_000 and {r["IND_REC"] for r in hot} == {1}
    assert len(got) - len(hot) == 40_000   # in the other files all lines have the same version


def test_rows_without_a_key_do_not_meet_in_one_task(spark, skewed):
    left = skewed.withColumn("k", F.when(F.col("_row_id") % 100 == 0, F.col("v")))
    right = skewed.select(F.col("v").alias("rk"), F.lit("x").alias("found"))
    with conf(spark, spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions=16):
        out = lookup.lookup(left, right, [{"k": "rk"}], ["found"])
        sizes = [r["n"] for r in out.select("v", "found", F.spark_partition_id().alias("p"))
                 .groupBy("p").agg(F.count("v").alias("n"), F.count("found")).collect()]
        assert max(sizes) < 60_000 / 4
        assert out.filter("found = 'x'").count() == 600


def test_tree_of_a_hot_file_keeps_groups_small(spark, skewed):
    rules = [{"parent": "0000", "children": ["C100"]}]
    linked = tree.link_parents(skewed, rules, file_col="_file_id", chunk_bits=10)
    chunks = skewed.groupBy("_file_id", F.shiftright("_row_id", 10)).count().agg(F.max("count")).first()[0]
    assert chunks <= 1024
    last = {}
    for f, i in rows(skewed.filter("REG='0000'"), "_file_id", "_row_id"):
        last[f] = max(last.get(f, -1), i)
    got = rows(linked.filter("REG='C100'"), "_file_id", "_parent_uid_final")
    assert len(got) == 60_000 - 1200 and all(p == last.get(f) for f, p in got)


def test_reports_read_only_their_folders_and_columns(spark, tmp_path):
    df = spark.createDataFrame([("f", 0, None, "0000", "n", None, "x"), ("f", 1, 0, "C100", None, "d", "x"), ("f", 2, 1, "C170", None, None, "x")],
                               "_file_id string, _row_id long, _parent_uid_final long, REG string, NOME string, NUM_DOC string, UNUSED string")
    write_table(df, str(tmp_path / "s"), partition_by=["REG"])
    wide = spark.read.parquet(str(tmp_path / "s"))
    spec = {"name": "R", "entities": {"C100": {"source": "C100", "fields": ["NUM_DOC"]}, "C170": {"source": "C170", "join_on": "C100", "fields": []}}}
    out = compile_report(spark, spec, registers_of(wide, ["C100", "C170"]))
    formatted = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    scans = [ln for ln in formatted.splitlines() if ln.startswith("ReadSchema")]
    assert len(scans) == 2 and not any("UNUSED" in ln for ln in scans)
    assert formatted.count("PartitionFilters: [isnotnull(REG") == 2
    assert rows(out, "NUM_DOC") == [("d",)]


def test_eligibility_is_pushed_to_the_scan(spark, tmp_path):
    spark.createDataFrame([("040", "5102", "1")], "CST_ICMS string, CFOP string, VL_OPR string").write.parquet(str(tmp_path / "c"))
    out = subsidy.eligible_totals(spark.read.parquet(str(tmp_path / "c")))
    formatted = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert "PushedFilters: [In(CST_ICMS" in formatted
    assert out.count() == 1


def test_rebalanced_write_splits_a_large_partition(spark, tmp_path):
    df = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") % 50 == 0, "small").otherwise("large").alias("REG"), F.xxhash64("id").alias("v"))
    with conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="256KB", spark__sql__shuffle__partitions=61):
        write_table(df, str(tmp_path / "w"), partition_by=["REG"])
    files = {p: len(list((tmp_path / "w" / f"REG={p}").glob("*.parquet"))) for p in ("small", "large")}
    assert files["large"] > 2 and files["small"] == 1
    assert spark.read.parquet(str(tmp_path / "w")).count() == 200_000


def test_shuffle_settings_grow_with_the_data():
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert sized_conf(1 << 30)[key] == "200" and int(sized_conf(100 << 40)[key]) == 819_200


def test_chunked_rollup_spreads_a_hot_parent(spark, skewed):
    with conf(spark, spark__sql__adaptive__enabled=False, spark__sql__shuffle__partitions=16):
        chunks = lookup.roll_up_chunks(skewed, "_file_id", ["v"], lines=600)
        assert plan_of(chunks).count("Exchange") == 1
        hot = chunks.filter("_file_id = 'hot'").select(F.spark_partition_id().alias("task"), F.size("v").alias("n")).collect()
    assert sum(r["n"] for r in hot) == 20_000 and max(r["n"] for r in hot) <= 600 and len(hot) == 100
    assert len({r["task"] for r in hot}) > 8

"""Upsert, replace, staged swaps, optional reads, dead letters."""

import json

import pytest
from pyspark.sql import functions as F

from fiscalgrove.catalog import ContractError
from fiscalgrove.sources import tables as t
from fiscalgrove.streaming import deadletter as d
from tests.conftest import rows

DDL = "k string, p string, v int"


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    mk = lambda *r: spark.createDataFrame(list(r), DDL)
    assert t.upsert(mk(("a", "1", 1), ("b", "1", 1), (None, "1", 9), ("c", "2", 2), ("c", "2", 3)), path, ["k", "p"], partition_by=["p"])
    assert rows(t.read_table(spark, path), "k", "p", "v") == [("a", "1", 1), ("b", "1", 1), ("c", "2", 2)]
    before = {f.name for f in (tmp_path / "t" / "p=2").iterdir()}
    for _ in range(2):
        t.upsert(mk(("b", "1", 7), ("d", "3", 4)).withColumn("extra", F.lit("e")), path, ["k", "p"], partition_by=["p"])
    assert rows(t.read_table(spark, path, mergeSchema="true"), "k", "p", "v", "extra") == sorted(
        [("a", "1", 1, None), ("b", "1", 7, "e"), ("c", "2", 2, None), ("d", "3", 4, "e")], key=repr)
    assert {f.name for f in (tmp_path / "t" / "p=2").iterdir()} == before   # untouched partition
    assert not t.upsert(mk((None, "1", 1)), path, ["k", "p"], partition_by=["p"])
    # the partition is no key: the row moves and its old partition empties
    other = str(tmp_path / "m")
    t.upsert(mk(("a", "1", 1), ("b", "2", 2)), other, ["k"], partition_by=["p"])
    t.upsert(mk(("a", "9", 5)), other, ["k"], partition_by=["p"])
    assert rows(t.read_table(spark, other), "k", "p", "v") == [("a", "9", 5), ("b", "2", 2)]
    plain = str(tmp_path / "u")
    t.upsert(mk(("a", "1", 1)), plain, ["k"])
    t.upsert(mk(("a", "1", 2), ("b", "1", 2)), plain, ["k"])
    assert rows(t.read_table(spark, plain), "k", "v") == [("a", 2), ("b", 2)]


def test_a_complete_stage_left_behind_is_swapped_in(spark, tmp_path):
    path = str(tmp_path / "t")
    mk = lambda *r: spark.createDataFrame(list(r), DDL)
    t.write_table(mk(("a", "1", 1), ("b", "2", 2)), path, mode="overwrite", partition_by=["p"])
    t.write_table(mk(("a", "1", 100)), str(tmp_path / "_t.stage" / "done"), mode="overwrite")
    half = tmp_path / "_t.stage" / "half"
    half.mkdir()
    (half / "part-0.parquet").write_bytes(b"junk")
    t.finish_pending(spark, path, ["p"])
    assert rows(t.read_table(spark, path), "k", "v") == [("a", 100), ("b", 2)]
    assert list((tmp_path / "_t.stage").iterdir()) == []


def test_optional_and_many_and_folder_reads(spark, tmp_path):
    assert t.read_optional(spark, str(tmp_path / "none")) is None and t.read_many(spark, [str(tmp_path / "none")]) is None
    assert t.load_registers(spark, str(tmp_path / "none"), ["A"]) == {"A": None}
    df = spark.createDataFrame([("x", "0000"), ("y", "C100")], "v string, REG string")
    t.write_table(df, str(tmp_path / "r"), partition_by=["REG"])
    assert t.table_exists(spark, str(tmp_path / "r"))
    assert rows(t.read_filtered(spark, str(tmp_path / "r"), where={"REG": "0000"}), "v", "REG") == [("x", "0000")]
    plan = t.read_filtered(spark, str(tmp_path / "r"), where={"REG": "0000"})._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(REG" in plan
    assert rows(t.load_register_folder(spark, str(tmp_path / "r"), "C100"), "v", "REG") == [("y", "C100")]
    with pytest.raises(ContractError):
        t.write_report(df.select("v", F.col("v").alias("V")), str(tmp_path / "w"))
    t.convert(spark, df, str(tmp_path / "csv"), target_fmt="csv")
    assert list((tmp_path / "csv").glob("*.csv"))
    assert rows(t.read_csv(spark, str(tmp_path / "csv"), schema="v string, REG string")) == [("x", "0000"), ("y", "C100")]


def test_subsidy_references(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    spark.createDataFrame([(102, "a", "Venda"), (102, "a", "Venda")], "cfop int, descricao string, natureza string").write.parquet(at("c"))
    spark.createDataFrame([(1, "SP"), (None, "XX")], "cod_mun int, uf string").write.parquet(at("m"))
    spark.createDataFrame([("SP", "RJ", 12.0)], "Origem string, Destino string, Aliquota double").write.parquet(at("r"))
    refs = t.load_subsidy_references(spark, at("c"), at("m"), at("r"))
    assert rows(refs["cfop"]) == [("0102", "a", "Venda")] and rows(refs["municipios"]) == [("1", "SP")]


def test_replay_verdicts(spark):
    env = lambda **k: json.dumps({"_failed_stream": "s", "_sped_type": "ECF", "status": "F", "_failed_at": "t", **k})
    ok = json.dumps({"a": 1})
    data = [("good", env(original_topic="t", kafka_value_truncated=ok)), ("no topic", env(kafka_value_truncated=ok)), ("no value", env(original_topic="t")),
            ("long", env(original_topic="t", kafka_value_truncated='{"a":"' + "é" * 4090)), ("accents", env(original_topic="t", kafka_value_truncated='{"a":"' + "é" * 3000 + '"}')), ("broken", env(original_topic="t", kafka_value_truncated="{a")),
            ("unreadable", "{{"), ("other", env(_sped_type="ECD", original_topic="t", kafka_value_truncated=ok))]
    df = spark.createDataFrame(data, "key string, value string")
    assert dict(rows(d.replay_verdicts(df), "key", "verdict")) == {
        "good": "replay", "no topic": "incomplete", "no value": "incomplete", "long": "truncated", "accents": "replay", "broken": "invalid_json", "unreadable": "unreadable", "other": "replay"}
    assert rows(d.replayable(d.replay_verdicts(df, stream="s", return_type="ECF", status="F", failed_at="t")), "key", "topic") == [("accents", "t"), ("good", "t")]
    assert d.replay_verdicts(df, failed_at="later").count() == 0


def test_retry_routing(spark):
    df = spark.createDataFrame([("t", "k", "v", "e", n) for n in (0, 4, 5)], "original_topic string, original_key string, original_value string, error_message string, retry_count int")
    now = F.timestamp_seconds(F.lit(1000))
    out = d.route_retries(df, now)
    assert rows(out, "route", "retry_count", "total_retries", F.unix_timestamp("next_retry_at")) == sorted(
        [(d.TOPICS["retry"], 1, None, 1001), (d.TOPICS["retry"], 5, None, 1016), (d.TOPICS["dlq"], None, 5, None)], key=repr)
    assert d.due_retries(out, F.timestamp_seconds(F.lit(1001))).count() == 1


def test_arrivals_and_recovery(spark):
    df = spark.createDataFrame([("TO_CONVERT/11/ECF/2023/a.txt",), ("TO_CONVERT/x/ECF/2023/b.txt",), ("TO_CONVERT/11/ECF/2023/c.zip",), ("else/d.txt",)], "resourceName string")
    assert rows(d.arrivals(df, bucket="b"), "file_name", "cnpj", "periodo") == [("a.txt", "11", "2023"), ("b.txt", None, None)]
    stored = spark.createDataFrame([("a.txt", "s3a://x/TO_CONVERT/1/ECF/2023/a.txt", "ECF")] * 3, "_file_id string, _source_file string, _sped_type string")
    assert rows(d.lost_handoffs(stored)) == [("a.txt", "ECF", "TO_CONVERT/1/ECF/2023/a.txt", "PROCESSED_BRONZE")]


def test_release_sends_once(spark, tmp_path):
    """Reruns send nothing twice; a release that died before it sent is finished; equal letters are one; NULL parts are kept apart."""
    at = lambda s: F.timestamp_seconds(F.lit(1_700_000_000 + s))
    letters = spark.createDataFrame([("t", "a", "1", 0), ("t", "a", "1", 0), ("t", None, "1", 0), ("t", "null", "1", 0), ("u", "b", "2", 3)],
                                    "original_topic string, original_key string, original_value string, retry_count int").withColumn("error_message", F.lit("e"))
    routed, claims, out = d.route_retries(letters, at(0)), str(tmp_path / "claims"), []

    def send(df, topic):
        out.extend((topic, r["key"]) for r in df.collect())

    def dies(df, topic):
        raise RuntimeError("no broker")

    assert d.release_due(routed, at(0), claims, send) == 0
    with pytest.raises(RuntimeError):
        d.release_due(routed, at(2), claims, dies)
    assert d.release_due(routed, at(2), claims, send) == 3
    assert d.release_due(routed, at(2), claims, send) == 0
    assert d.release_due(routed, at(60), claims, send) == 1
    assert sorted(out, key=repr) == [("t", "a"), ("t", "null"), ("t", None), ("u", "b")]


def _break(folder):
    """Make the data files of a folder unreadable: whoever opens one fails."""
    for file in folder.rglob("*.parquet"):
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
        file.write_bytes(b"junk")


@pytest.mark.parametrize("keys", [["k"], ["k", "p"]])
def test_a_merge_opens_only_partitions_of_its_keys(spark, tmp_path, keys):
    path = str(tmp_path / "t")
    mk = lambda *r: spark.createDataFrame(list(r), DDL)
    t.replace_by_file(mk(("a", "1", 1), ("a", "2", 2), ("b", "2", 3), ("c", "3", 4), (None, "1", 5)), path, file_keys=keys, partition_by=["p"])
    _break(tmp_path / "t" / "p=3")
    t.replace_by_file(mk(("a", "2", 20), ("d", "4", 6)), path, file_keys=keys, partition_by=["p"])
    left = spark.read.option("basePath", path).parquet(*[f"{path}/p={p}" for p in (1, 2, 4)])
    first = [("a", "1", 1)] if keys == ["k", "p"] else []
    assert rows(left, "k", "p", "v") == sorted([*first, ("a", "2", 20), ("b", "2", 3), ("d", "4", 6), (None, "1", 5)], key=repr)
    with pytest.raises(Exception, match="Parquet|parquet|read"):
        t.replace_by_file(mk(("c", "3", 7)), path, file_keys=keys, partition_by=["p"])   # this one needs the broken file


def test_key_places_follow_rows_and_can_be_built_anew(spark, tmp_path):
    path = str(tmp_path / "t")
    mk = lambda *r: spark.createDataFrame(list(r), "k long, p string, q int, v int")
    put = lambda *r: t.replace_by_file(mk(*r), path, file_keys=["k"], partition_by=["p", "q"])
    t.write_table(mk((1, "x/1", 1, 1), (2, None, 2, 2)), path, mode="overwrite", partition_by=["p", "q"])   # a table without key places
    put((1, "y", 1, 10))
    put((1, "x/1", 1, 100), (2, None, 2, 20), (2, "z", None, 21))
    t.forget_places(spark, path, ["k"])
    put((2, "x/1", 3, 200))
    put()
    assert rows(t.read_table(spark, path), "k", "p", "q", "v") == [(1, "x/1", "1", 100), (2, "x/1", "3", 200)]


def test_a_commit_that_died_is_finished_wherever_it_stopped(spark, tmp_path):
    path = str(tmp_path / "t")
    mk = lambda *r: spark.createDataFrame(list(r), DDL)
    t.write_table(mk(("a", "1", 1), ("b", "2", 2), ("c", "3", 3)), path, mode="overwrite", partition_by=["p"])
    commit = str(tmp_path / "_t.commit" / "one")
    t.write_table(mk(("a", "1", 10), ("d", "4", 4)), f"{commit}/rows", mode="overwrite", partition_by=["p"])
    spark.createDataFrame([("p=2",)], "folder string").write.parquet(f"{commit}/emptied")
    (tmp_path / "_t.commit" / "one" / "rows" / "p=4").rename(tmp_path / "t" / "p=4")   # died after its first move
    t.write_table(mk(("x", "3", 9)), str(tmp_path / "_t.commit" / "two" / "rows"), mode="overwrite", partition_by=["p"])   # incomplete
    t.replace_by_file(mk(("e", "5", 5)), path, file_keys=["k"], partition_by=["p"])
    assert rows(t.read_table(spark, path), "k", "v") == [("a", 10), ("c", 3), ("d", 4), ("e", 5)]
    assert list((tmp_path / "_t.commit").iterdir()) == []

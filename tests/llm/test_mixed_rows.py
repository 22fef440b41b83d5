"""The mixture stage on rows with null and repeated ids and with columns of the names it uses."""

from collections import Counter

from pyspark.sql import functions as F

from fiscalgrove.llm import mixing
from tests.llm.conftest import DDL


def test_null_and_repeated_ids_keep_their_share(spark):
    rows = [(None if i % 3 == 0 else i % 5, f"t{i} " + "w " * (i % 17), "en", "ab"[i % 2], i) for i in range(300)]
    docs = spark.createDataFrame(rows, DDL)
    size = {r[4]: len(r[1].split()) for r in rows}
    out = mixing.mixed_documents(docs).collect()
    words = Counter()
    for r in out:
        assert r["text"].split() == rows[r["n_chars"]][1].split()[: len(r["text"].split())]
        words[r["n_chars"]] += len(r["text"].split())
    assert all(words[i] <= 3 * n for i, n in size.items())
    assert max(Counter((r["n_chars"], r["mix_round"]) for r in out).values()) == 1
    totals = mixing.mix(docs)[1].groupBy("source").agg(F.first("target").alias("t")).collect()
    for r in totals:
        assert abs(sum(w for i, w in words.items() if "ab"[i % 2] == r["source"]) - r["t"]) <= 1


def test_nulls_repeats_and_clashing_names(clashing):
    names = ("_id", "_size", "_words", "of", "round", "shard", "place", "mix_round", "mix_place")
    docs = clashing.withColumns({c: F.lit("clash") for c in names})
    out = mixing.mixed_documents(docs)
    assert out.columns == [*docs.columns, "mix_round_", "mix_shard", "mix_place_"]
    rows = out.collect()
    assert rows and all(r["_id"] == r["mix_round"] == "clash" for r in rows)
    assert mixing.mixed_documents(docs.limit(0)).count() == 0

"""What steps leave on disk."""

import glob
import os

from pyspark.sql import functions as F

from fiscalgrove.llm import lm, pii, quality, shared


def shuffled(spark):
    top = os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", "/tmp")
    return {f for f in glob.glob(f"{top}/**/blockmgr-*/**/shuffle_*.data", recursive=True)}


def test_shuffle_files_go_with_the_write(spark):
    before = shuffled(spark)
    rows = spark.range(50_000).repartition(5, (F.col("id") % 101)).withColumn("x", F.rand(1))
    assert shared.stored(rows, "shuffled").count() == 50_000 and rows.sparkSession.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    left = sum(os.path.getsize(f) for f in shuffled(spark) - before if os.path.exists(f))
    assert left < 10_000   # that of the count


def test_stages_store_no_texts(spark, docs):
    folders = []
    token = shared._passing.set(folders)
    try:
        for stage in (quality.kept_documents, pii.masked):
            assert stage(docs).count() > 100
    finally:
        shared._passing.reset(token)
    kept = [f.dataType.simpleString() for path in folders for f in spark.read.parquet(path).schema]
    assert folders and not any("text:" in kind or kind == "string" and "text" in kind for kind in kept)


def test_scores_keep_no_shuffles_of_the_first_pass(spark, docs):
    before = shuffled(spark)
    scored = lm.score(docs)   # has learned the weights; the scores themselves are still to be made
    left = sum(os.path.getsize(f) for f in shuffled(spark) - before if os.path.exists(f))
    assert left < 10_000 and scored.columns[0] == "doc_id"

"""Small helpers that several operators of this package use."""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalgrove.session import freed, scratch_dir
from fiscalgrove.sources.tables import delete_path

#: a word: a run of anything but space, tab, line feed, vertical tab, form feed, carriage return
WORD = r"[^\x20\x09-\x0D]+"

#: folders written by ``stored`` within the innermost ``settled``
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared scratch folder and read back: the plan is cut, lost executors lose nothing.

    What was stored needs its shuffle files no more, so they go with the write: else disks fill up in a long chain of steps,
    for Spark's cleaner waits until the driver's collector happens to find the plan unused.
    """
    spark, schema = df.sparkSession, df.schema
    path = scratch_dir(spark, purpose)
    if (folders := _passing.get()) is not None:
        folders.append(path)
    with freed(spark):
        df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def settled(spark: SparkSession, step: Callable[[], DataFrame], purpose: str) -> DataFrame:
    """``stored(step(), purpose)``; then what the step stored on its way is deleted, for nothing reads it any more.

    The result is complete in the shared folder before anything goes, so a lost executor needs none of it. A step that
    fails leaves its folders. Frames that the step built must not be used outside it.
    """
    folders: list[str] = []
    token = _passing.set(folders)
    try:
        df = step()
    finally:
        _passing.reset(token)
    out = stored(df, purpose)
    for path in folders:
        delete_path(spark, path)
    return out


def words_of(text: Column) -> Column:
    """The words of a text as an array; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, however often the body (or a lambda in it) uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)

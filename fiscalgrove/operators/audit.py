"""Counts, profiles and file checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalgrove.operators.lookup import own_shuffle


def frequency_profile(df: DataFrame, by: Sequence[str], out: str = "count", ordered: bool = True) -> DataFrame:
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias(out))
    return counts.orderBy(F.col(out).desc(), *by) if ordered else counts


def fan_out_audit(df: DataFrame, key: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows against distinct keys: more rows than keys means a join multiplied lines.

    Counts per key are added up, which is exact, and a frequent key is combined before
    the shuffle.
    """
    per_key = df.groupBy(*by, *[k for k in key if k not in by]).agg(F.count(F.lit(1)).alias("_n"))
    sums = [F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("keys"),
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("extra_rows")]
    return per_key.groupBy(*by).agg(*sums) if by else per_key.agg(*sums)


def distinct_sets(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def missing_files(expected: DataFrame, produced: DataFrame, on: str = "_file_id") -> DataFrame:
    """Expected files that produced no line."""
    return expected.join(own_shuffle(produced.select(on).distinct(), [on]), [on], "left_anti")


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def within_last_years(df: DataFrame, year_col: str, years: int, *, by: Sequence[str] = (),
                      last_year: int | None = None) -> DataFrame:
    """Rows of the last years: counted from a fixed year, or from the data's own maximum.

    The maximum is computed inside the query (per group, or as a scalar subquery).
    """
    if last_year is not None:
        return df.filter(F.col(year_col) >= last_year - years)
    if by:
        top = df.groupBy(*by).agg(F.max(year_col).alias("_top"))
        return df.join(own_shuffle(top, by), list(by)).filter(F.col(year_col) >= F.col("_top") - years).select(*df.columns)
    top = df.agg(F.max(year_col)).scalar()
    return df.filter(F.col(year_col) >= top - years)

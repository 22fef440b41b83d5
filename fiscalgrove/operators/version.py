"""Which version of a return counts: amended beats original, newer history beats older.

All of these are reductions (which combine before the shuffle) joined back, not sorts of a
whole group, so one key may hold any number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalgrove.functions.files import is_amended_name, name_timestamp, version_key
from fiscalgrove.functions.scalars import as_col
from fiscalgrove.operators.columns import with_cnpj_base
from fiscalgrove.operators.lookup import one_per_key, own_shuffle


def latest_version(df: DataFrame | None, keys: Sequence[str] | None = None,
                   order: Sequence[str] | None = None) -> DataFrame | None:
    """Rows of the latest version per key; ties are all kept.

    By default the key is what there is of (CNPJ, DT_INI), and the latest version has the
    highest IND_REC, then the highest file id. Without a column to order by, exact duplicates
    are removed; without a key the frame is returned as it is.
    """
    if df is None:
        return None
    keys = [c for c in ("CNPJ", "DT_INI") if c in df.columns] if keys is None else list(keys)
    if not keys:
        return df
    if order is None:
        file_id = next((c for c in ("_file_id", "FILE_ID") if c in df.columns), None)
        order = [c for c in ("IND_REC", file_id) if c and c in df.columns]
    if not order:
        return df.dropDuplicates()
    rank = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    best = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.max(rank).alias("_best"))
    same_key = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return df.join(best, same_key & rank.eqNullSafe(F.col("_best")), "left_semi")


def resolve_amended_names(files: DataFrame, path: str = "file_path") -> DataFrame:
    """Per version key of the file name: the amendments if there are any, else the originals.

    Files whose name does not follow the pattern are all kept.
    """
    tagged = files.withColumns({"_vkey": version_key(path), "_amended": is_amended_name(path)})
    named = tagged.filter(F.col("_vkey").isNotNull())
    other = tagged.filter(F.col("_vkey").isNull())
    superseded = named.filter("_amended").select("_vkey").distinct().withColumn("_has", F.lit(True))
    kept = named.join(own_shuffle(superseded, ["_vkey"]), ["_vkey"], "left").filter(
        F.col("_amended") | F.col("_has").isNull())
    return kept.select(*files.columns).unionByName(other.select(*files.columns))


def resolve_amended_headers(files: DataFrame, *, keys: Sequence[str] = ("cnpj", "dt_ini", "dt_fin"),
                            amended: Column | str = "retificadora", path: str = "file_path") -> DataFrame:
    """Per (company, start, end) of the header: one file, amended before original, then newest.

    Newest means the timestamp in the file name; equal ones are settled by the whole path.
    Files without a header (all keys NULL) are kept.
    """
    flag = F.coalesce(F.upper(F.trim(as_col(amended).cast("string"))).isin("S", "TRUE"), F.lit(False))
    no_header = reduce(lambda a, b: a & b, [F.col(k).isNull() for k in keys])
    known = files.filter(~no_header)
    rank = F.struct(flag.alias("f"), name_timestamp(path).alias("t"), F.col(path).alias("p"))
    whole = F.struct(*files.columns)
    best = known.groupBy(*keys).agg(F.max_by(whole, rank).alias("_best"))
    return best.select("_best.*").unionByName(files.filter(no_header))


def not_superseded(history: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """History rows whose key the current rows do not replace."""
    return history.join(own_shuffle(current.select(*keys).distinct(), keys), list(keys), "left_anti")


def merge_history(current: DataFrame, history: DataFrame | None, *, keys: Sequence[str] = ("CNPJ", "DT_INI"),
                  company: str = "cnpj_base", years_back: int = 5) -> DataFrame:
    """Current rows plus the history they do not replace, per company.

    History counts from ``years_back`` years before its own latest year (so six calendar
    years). Company and key must be known.
    """
    current = one_per_key(current, list(keys))
    if history is None:
        return with_cnpj_base(current)
    year = F.substring("DT_INI", 5, 4).try_cast("int")
    old = with_cnpj_base(history).dropna(subset=list(keys)).withColumn("_year", year)
    last = old.groupBy(company).agg(F.max("_year").alias("_last"))
    recent = old.join(own_shuffle(last, [company]), [company]).filter(F.col("_year") >= F.col("_last") - years_back)
    kept = not_superseded(recent.select(*with_cnpj_base(history).columns), current, keys)
    return with_cnpj_base(current).unionByName(kept, allowMissingColumns=True)


def history_of_current_companies(current: DataFrame, history: DataFrame | None, *, this_year: int,
                                 keys: Sequence[str] = ("CNPJ", "DT_INI"), years_back: int = 5) -> DataFrame:
    """Variant with a fixed horizon, limited to companies that have current rows."""
    current = one_per_key(current, list(keys))
    if history is None:
        return current
    year = F.substring("DT_INI", 5, 4).try_cast("int")
    mine = history.join(own_shuffle(current.select("CNPJ").distinct(), ["CNPJ"]), ["CNPJ"], "left_semi")
    recent = mine.filter(year >= this_year - years_back)
    return current.unionByName(not_superseded(recent, current, keys), allowMissingColumns=True)

"""Stored tables: optional reads, pruned reads, partitioned writes, replace and upsert.

Tables are Parquet folders by default; ``fmt`` may name any other file format Spark knows.
Replace and upsert read and rewrite only the partitions the new rows touch. The merged partitions are
first written to a folder beside the table and then moved in, so a table is never read and
overwritten in one job; if a run dies between the two, the next one finishes the complete
commit first. A table has one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalgrove.catalog import ContractError
from fiscalgrove.operators.columns import plain_names, reject_duplicate_columns, void_to_string
from fiscalgrove.operators.lookup import one_per_key, own_shuffle

ROWS_PER_FILE = 500_000


# ------------------------------------------------------------------------ reads
def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return spark.read.format(fmt).options(**options).load(path)


def read_optional(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame | None:
    """The table, or None if there is nothing at the path."""
    try:
        return read_table(spark, path, fmt, **options)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    return read_optional(spark, path, fmt) is not None


def read_many(spark: SparkSession, paths: Iterable[str], fmt: str = "parquet") -> DataFrame | None:
    """Folders with differing partitions, each read on its own, then united by name."""
    frames = [f for f in (read_optional(spark, p, fmt) for p in paths) if f is not None]
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_csv(spark: SparkSession, path: str, *, sep: str = ";", header: bool = True,
             schema: str | None = None) -> DataFrame:
    """Delimited text; pass a schema for large input, or Spark reads it once more to infer it."""
    reader = spark.read.option("sep", sep).option("header", header)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def read_filtered(spark: SparkSession, path: str, *, fmt: str = "parquet",
                  where: Mapping[str, object] | None = None) -> DataFrame | None:
    """A table filtered by equality; on partition columns this prunes folders."""
    df = read_optional(spark, path, fmt)
    if df is None:
        return None
    for name, value in (where or {}).items():
        if value is not None:
            df = df.filter(F.col(name) == F.lit(value))
    return df


# --- fixed values -----------------------------------------------------------
DIAGNOSTIC_TABLES = {
    "company_tax_profile": "gold_company_tax_profile",
    "summary": "gold_pre_diagnostic_summary",
    "scores": "gold_pre_diagnostic_scores",
    "opportunities": "gold_pre_diagnostic_opportunities",
    "go_no_go": "gold_pre_diagnostic_go_no_go",
    "financials": "gold_pre_diagnostic_financials",
    "master": "gold_pre_diagnostic_master",
    "master_historical": "gold_pre_diagnostic_master_historical",
}
# ----------------------------------------------------------------------------


def read_diagnostic(spark: SparkSession, base: str, table: str, *, cnpj: str | None = None,
                    dt_ini: str | None = None) -> DataFrame | None:
    """One of the diagnostic tables, filtered by company and period start."""
    return read_filtered(spark, f"{base.rstrip('/')}/{DIAGNOSTIC_TABLES[table]}",
                         where={"CNPJ": cnpj, "DT_INI": dt_ini})


def registers_of(wide: DataFrame | None, registers: Iterable[str]) -> dict[str, DataFrame | None]:
    """One scan of the wide table, one pruned view per record type; None without a table."""
    return {r: None if wide is None else wide.filter(F.col("REG") == r) for r in registers}


def load_registers(spark: SparkSession, table: str, registers: Iterable[str], *,
                   where: Mapping[str, object] | None = None, fmt: str = "parquet") -> dict[str, DataFrame | None]:
    return registers_of(read_filtered(spark, table, fmt=fmt, where=where), registers)


def load_register_folder(spark: SparkSession, table: str, register: str, fmt: str = "parquet") -> DataFrame | None:
    """One record type by its partition folder, None where it does not exist."""
    df = read_optional(spark, f"{table.rstrip('/')}/REG={register}", fmt)
    return None if df is None else df.withColumn("REG", F.lit(register))


def load_subsidy_references(spark: SparkSession, cfop: str, municipalities: str, rates: str) -> dict[str, DataFrame]:
    """The three reference tables, one row per key, keys cleaned."""
    codes = spark.read.parquet(cfop).select(
        F.lpad(F.col("cfop").cast("string"), 4, "0").alias("cfop"), "descricao", "natureza")
    towns = spark.read.parquet(municipalities).select(F.col("cod_mun").cast("string").alias("cod_mun"), "uf")
    return {"cfop": one_per_key(codes, ["cfop"]), "municipios": towns.dropna(subset=["cod_mun"]),
            "aliquotas": spark.read.parquet(rates)}


# ----------------------------------------------------------------------- writes
def write_table(df: DataFrame, path: str, *, mode: str = "append", partition_by: Sequence[str] = (),
                fmt: str = "parquet", rows_per_file: int | None = None, **options: str) -> None:
    """Write a table; a partitioned one is rebalanced on its partition columns first.

    Rebalancing lets adaptive execution split the rows of a large partition over many tasks and
    put small partitions together: neither one huge task nor a file per task and partition.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.format(fmt).mode(mode).options(**options)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_registers(df: DataFrame, path: str, registers: Iterable[str], *, partition_by: Sequence[str] = ("REG",),
                    fmt: str = "parquet") -> None:
    """The wide table by record type, columns in sorted order, files of limited size."""
    kept = df.filter(F.col("REG").isin(sorted(registers)))
    ordered = void_to_string(kept.select(*sorted(kept.columns)))
    write_table(ordered, path, mode="overwrite", partition_by=partition_by, fmt=fmt, rows_per_file=ROWS_PER_FILE,
                partitionOverwriteMode="dynamic")


def write_report(df: DataFrame, path: str, *, fmt: str = "parquet", plain: bool = False,
                 partition_by: Sequence[str] = ()) -> None:
    """Checked overwrite: unique names, no void columns, optionally plain column names."""
    checked = void_to_string(reject_duplicate_columns(df))
    write_table(plain_names(checked) if plain else checked, path, mode="overwrite", fmt=fmt,
                partition_by=partition_by, partitionOverwriteMode="static")


def write_jdbc(df: DataFrame, url: str, table: str, *, mode: str = "append",
               properties: Mapping[str, str] | None = None, connections: int = 8) -> None:
    """Database table write with a bounded number of connections."""
    df.write.option("numPartitions", connections).jdbc(url, table, mode=mode, properties=dict(properties or {}))


def convert(spark: SparkSession, source: str | DataFrame, target: str, *, source_fmt: str = "parquet",
            target_fmt: str = "parquet", sep: str = ";") -> None:
    """text -> parquet, csv -> parquet, parquet -> csv (``;``, header)."""
    if isinstance(source, DataFrame):
        df = source
    elif source_fmt == "csv":
        df = read_csv(spark, source, sep=sep)
    else:
        df = spark.read.format(source_fmt).load(source)
    options = {"sep": sep, "header": "true"} if target_fmt == "csv" else {}
    write_table(df, target, mode="overwrite", fmt=target_fmt, **options)


# -------------------------------------------------------------- replace / upsert
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _beside(path: str, kind: str) -> str:
    """Folder next to the table (an overwrite of the table must not remove it)."""
    parent, name = path.rstrip("/").rsplit("/", 1)
    return f"{parent}/_{name}.{kind}"


def _swap_in(spark: SparkSession, path: str, stage: str, partition_by: Sequence[str]) -> None:
    mode = "dynamic" if partition_by else "static"
    staged = read_optional(spark, stage)
    if staged is not None:
        write_table(staged, path, mode="overwrite", partition_by=partition_by, partitionOverwriteMode=mode)
    delete_path(spark, stage)


def _folders_below(spark: SparkSession, root: str, depth: int) -> list[str]:
    """Partition folders ``depth`` levels below a folder, relative to it; none if it does not exist."""
    found = [""]
    for _ in range(depth):
        deeper = []
        for folder in found:
            fs, p = _fs(spark, f"{root}/{folder}".rstrip("/"))
            listed = fs.listStatus(p) if fs.exists(p) else []
            names = [x.getPath().getName() for x in listed if x.isDirectory()]
            deeper += [f"{folder}/{n}".lstrip("/") for n in names if "=" in n]
        found = deeper
    return found


def _move_in(spark: SparkSession, path: str, commit: str, partition_by: Sequence[str]) -> None:
    """Move a complete commit into the table: emptied partitions go, staged folders take the place of the table's.

    It may run again after it died anywhere: a staged folder is there until it has been moved.
    """
    for row in spark.read.schema("folder string").parquet(f"{commit}/emptied").toLocalIterator():
        delete_path(spark, f"{path}/{row['folder']}")
    for folder in _folders_below(spark, f"{commit}/rows", len(partition_by)):
        fs, target = _fs(spark, f"{path}/{folder}")
        _, staged = _fs(spark, f"{commit}/rows/{folder}")
        fs.delete(target, True)
        fs.mkdirs(target.getParent())
        if not fs.rename(staged, target):
            raise OSError(f"{path}: {folder} could not be moved in; the complete commit stays at {commit}")
    spark.catalog.refreshByPath(path)
    delete_path(spark, commit)


def finish_pending(spark: SparkSession, path: str, partition_by: Sequence[str]) -> None:
    """Bring in what a run that died left complete, drop what is incomplete."""
    path = path.rstrip("/")
    for kind, complete, finish in (("stage", "_SUCCESS", _swap_in), ("commit", "emptied/_SUCCESS", _move_in)):
        fs, p = _fs(spark, _beside(path, kind))
        for status in fs.listStatus(p) if fs.exists(p) else []:
            left = status.getPath().toString()
            if path_exists(spark, f"{left}/{complete}"):
                finish(spark, path, left, partition_by)
            else:
                delete_path(spark, left)


def prune_to(target: DataFrame, rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Filter partition columns to the values another frame has, so that folders are skipped.

    The distinct values come to the driver: as many as there are partitions to touch, which
    the file listing holds there anyway.
    """
    for name in columns:
        found = [r[0] for r in rows.select(F.col(name).cast("string")).distinct().toLocalIterator()]
        hit = F.col(name).isin([v for v in found if v is not None])
        target = target.filter(hit | F.col(name).isNull() if None in found else hit)
    return target


def partition_path(spark: SparkSession, path: str, row, partition_by: Sequence[str]) -> str:
    """The folder of a partition, with NULL and special characters written as Spark writes them."""
    utils = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    parts = [utils.getPartitionPathString(c, None if row[c] is None else str(row[c])) for c in partition_by]
    return "/".join([path.rstrip("/"), *parts])


def drop_partitions(path: str, partitions: DataFrame, partition_by: Sequence[str]) -> None:
    """Delete the folders of these partitions: as many as a batch has emptied."""
    spark = partitions.sparkSession
    for row in partitions.select(*partition_by).distinct().toLocalIterator():
        delete_path(spark, partition_path(spark, path, row, partition_by))


def _merge(new: DataFrame, path: str, match_on: Sequence[str], partition_by: Sequence[str],
           matching: DataFrame | None = None, places: DataFrame | None = None) -> None:
    """Old rows that match a new row give way to it; only touched partitions are listed, read and rewritten.

    ``matching`` names the rows to replace where it is more than the new rows' keys. ``places`` says in
    which partitions (by the first of ``partition_by``) rows of these keys lie. Without it, they are told by the keys
    if these have all partition columns, else by the table's key places (``_key_places``).
    """
    spark, path = new.sparkSession, path.rstrip("/")
    finish_pending(spark, path, partition_by)
    keys = (new if matching is None else matching).select(*match_on).distinct()
    if not partition_by:
        _merge_plain(new, path, match_on, keys)
        return
    if places is None and set(partition_by) <= set(match_on):
        places = keys.select(*partition_by)
    if places is not None:
        _rewrite(new, path, match_on, partition_by, keys, places)
        return
    found, folder = store_incoming(key_places(spark, path, match_on, partition_by, keys), path)
    try:
        # told before rows move in: a run that dies in between leaves places too many, never too few
        added = _keyed(new, match_on, partition_by).distinct()
        write_table(without(added, found, added.columns), _places_path(path, match_on), partition_by=["_key_bucket"])
        _rewrite(new, path, match_on, partition_by, keys, found.select(*[F.col(f"_p_{c}").alias(c) for c in partition_by]))
    finally:
        delete_path(spark, folder)


def _merge_plain(new: DataFrame, path: str, match_on: Sequence[str], keys: DataFrame) -> None:
    spark = new.sparkSession
    target = read_optional(spark, path, mergeSchema="true")
    if target is None:
        write_table(new, path, mode="overwrite", partitionOverwriteMode="static")
        return
    merged = target.join(own_shuffle(keys, match_on), list(match_on), "left_anti").unionByName(new, allowMissingColumns=True)
    stage = f"{_beside(path, 'stage')}/{uuid.uuid4().hex}"
    write_table(merged, stage, mode="overwrite")
    _swap_in(spark, path, stage, ())


def _rewrite(new: DataFrame, path: str, match_on: Sequence[str], partition_by: Sequence[str], keys: DataFrame,
             places: DataFrame) -> None:
    """Rewrite the partitions of ``places`` and of the new rows, beside the table, and move their folders in.

    The folders of one batch's partitions come to the driver, as Spark's own commit of a partitioned write has them there.
    """
    spark, cols = new.sparkSession, list(places.columns)
    if cols != list(partition_by[:len(cols)]):
        raise ContractError(f"{path}: places {cols} are not the first of {list(partition_by)}")
    text = [F.col(c).cast("string").alias(c) for c in cols]
    touched = places.select(*text).unionByName(new.select(*text)).distinct()
    folders = [partition_path(spark, path, row, cols) for row in touched.toLocalIterator()]
    present = [f for f in folders if path_exists(spark, f)]
    old = read_optional_folders(spark, path, present)
    merged = new if old is None else old.join(own_shuffle(keys, match_on), list(match_on), "left_anti").unionByName(
        new, allowMissingColumns=True)
    commit = f"{_beside(path, 'commit')}/{uuid.uuid4().hex}"
    write_table(merged, f"{commit}/rows", mode="overwrite", partition_by=partition_by, partitionOverwriteMode="static")
    filled = set(_folders_below(spark, f"{commit}/rows", len(partition_by)))
    before = [f"{f[len(path) + 1:]}/{deep}".rstrip("/") for f in present for deep in _folders_below(spark, f, len(partition_by) - len(cols))]
    emptied = spark.createDataFrame([(f,) for f in before if f not in filled], "folder string")
    emptied.coalesce(1).write.parquet(f"{commit}/emptied")   # its marker makes the commit complete
    _move_in(spark, path, commit, partition_by)


def read_optional_folders(spark: SparkSession, path: str, folders: Sequence[str]) -> DataFrame | None:
    """Some partitions of a table with their partition columns; the other folders are neither listed nor opened."""
    if not folders:
        return None
    try:
        return spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*folders)
    except AnalysisException as exc:
        if exc.getCondition() == "UNABLE_TO_INFER_SCHEMA":   # folders without files
            return None
        raise


KEY_BUCKETS = 64   # folders of the table of key places


def _places_path(path: str, match_on: Sequence[str]) -> str:
    return _beside(path, "places_" + "_".join(match_on))


def _keyed(rows: DataFrame, match_on: Sequence[str], partition_by: Sequence[str] = ()) -> DataFrame:
    """Keys that can match (no NULL) and partitions of rows as text, with the folder of their key places."""
    text = [F.col(c).cast("string").alias(f"_k_{c}") for c in match_on] + [F.col(c).cast("string").alias(f"_p_{c}") for c in partition_by]
    keys = [f"_k_{c}" for c in match_on]
    return rows.select(*text).dropna(subset=keys).withColumn("_key_bucket", F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS)).cast("string"))


def key_places(spark: SparkSession, path: str, match_on: Sequence[str], partition_by: Sequence[str], keys: DataFrame) -> DataFrame:
    """Which partitions may hold rows of these keys, from a narrow table beside one whose partitions its keys do not tell.

    It has each key with each partition that ever held rows of it, in folders by a hash of the key; a merge reads the folders
    of its keys and appends what is new. A place too many costs reading a partition, no more; ``forget_places`` has
    it built anew. A table without it is read once, key and partition columns only.
    """
    index = _places_path(path, match_on)
    if not path_exists(spark, f"{index}/_SUCCESS"):
        stored = read_optional(spark, path, mergeSchema="true")
        if stored is not None:
            write_table(_keyed(stored, match_on, partition_by).distinct(), index, mode="overwrite", partition_by=["_key_bucket"],
                        partitionOverwriteMode="static")
    wanted = _keyed(keys, match_on)
    buckets = [r[0] for r in wanted.select("_key_bucket").distinct().toLocalIterator()]
    known = read_optional_folders(spark, index, [f for f in (f"{index}/_key_bucket={b}" for b in buckets) if path_exists(spark, f)])
    if known is None:
        names = [*[f"_k_{c}" for c in match_on], *[f"_p_{c}" for c in partition_by], "_key_bucket"]
        return spark.createDataFrame([], ", ".join(f"`{n}` string" for n in names))
    on = wanted.columns
    return known.withColumn("_key_bucket", F.col("_key_bucket").cast("string")).join(own_shuffle(wanted, on), on, "left_semi").distinct()


def forget_places(spark: SparkSession, path: str, match_on: Sequence[str]) -> None:
    """Drop the key places of a table; the next merge builds them anew from its rows."""
    delete_path(spark, _places_path(path, match_on))


def without(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows whose keys the right side has not; NULL keys are equal."""
    other = right.select(*[F.col(k).alias(f"_w_{k}") for k in keys])
    return left.join(other, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_w_{k}")) for k in keys]), "left_anti")


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], wanted: DataFrame) -> None:
    """Write a result that stands for all ``wanted`` partitions: those without rows are emptied, others stay."""
    missing = [c for c in partition_by if c not in df.columns]
    if missing:
        raise ContractError(f"{path}: the result lacks {missing}, so it cannot replace single partitions")
    spark = df.sparkSession
    rows, folder = store_incoming(df, path)
    try:
        write_table(rows, path, mode="overwrite", partition_by=partition_by, partitionOverwriteMode="dynamic")
        empty = without(wanted.select(*partition_by).distinct(), rows.select(*partition_by).distinct(), partition_by)
        drop_partitions(path, empty, partition_by)
    finally:
        delete_path(spark, folder)


def store_incoming(df: DataFrame, path: str) -> tuple[DataFrame, str]:
    """Write the new rows once, so that merging does not compute their plan twice.

    Returns them as read back (the schema is given: no rows may mean no files) and the folder.
    """
    folder = f"{_beside(path, 'incoming')}/{uuid.uuid4().hex}"
    plain = void_to_string(df)
    write_table(plain, folder, mode="overwrite")
    return df.sparkSession.read.schema(plain.schema).parquet(folder), folder


def replace_by_file(df: DataFrame, path: str, *, file_keys: Sequence[str] = ("_file_id",),
                    partition_by: Sequence[str] = ("REG",), stored: bool = False,
                    files: DataFrame | None = None, places: DataFrame | None = None) -> None:
    """Write rows so that all earlier rows of the same files are gone.

    ``file_keys`` tell files apart; partition columns among them limit which folders are read.
    ``files`` names files to replace that may have no rows now; ``places`` the partitions their
    old rows lie in. Running it again with the same files gives the same table. ``stored`` says that
    ``df`` is read from storage already.
    """
    if stored:
        _merge(df, path, list(file_keys), partition_by, files, places)
        return
    rows, folder = store_incoming(df, path)
    try:
        _merge(rows, path, list(file_keys), partition_by, files, places)
    finally:
        delete_path(df.sparkSession, folder)


def upsert(df: DataFrame, path: str, keys: Sequence[str], *, partition_by: Sequence[str] = (),
           prefer: Sequence[str] = ()) -> bool:
    """Update rows with known keys, insert the others, create the table if absent.

    Rows with a NULL key are dropped; several rows for one key are settled by the smallest
    row (``prefer`` columns first). Nothing is written for an empty frame. With all
    ``partition_by`` columns among the keys, only partitions of incoming keys are read.
    """
    spark = df.sparkSession
    new, folder = store_incoming(one_per_key(df.dropna(subset=list(keys)), list(keys), prefer), path)
    try:
        filled = not new.isEmpty()
        if filled:
            _merge(new, path, keys, partition_by)
        return filled
    finally:
        delete_path(spark, folder)

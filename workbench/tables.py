"""Stored tables: upsert, replace by file, conversions, pruned and optional reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from fiscalgrove.session import scratch_dir
from fiscalgrove.sources import tables as t
from workbench.derive import table


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("y"), "o_totalprice")


def upsert_table(spark, sf):
    """Insert, then update two statuses and insert the rest twice over: the same table."""
    path, o = scratch_dir(spark, "upsert"), _orders(spark, sf)
    t.upsert(o.filter("o_orderstatus <> 'P'").withColumn("src", F.lit("first")), path, ["o_orderkey", "y"], partition_by=["y"])
    later = o.filter("o_orderstatus <> 'O'").withColumn("src", F.lit("second"))
    for _ in range(2):
        t.upsert(later, path, ["o_orderkey", "y"], partition_by=["y"])
    return t.read_table(spark, path).select("o_orderkey", F.col("y").cast("int").alias("y"), "o_orderstatus", "src")


UPSERT_SQL = """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, o_orderstatus, CASE WHEN o_orderstatus='O' THEN 'first' ELSE 'second' END AS src FROM orders"""


def replace_by_file(spark, sf):
    """Files written again replace their earlier rows, also in partitions they leave."""
    path, o = scratch_dir(spark, "replace"), _orders(spark, sf)
    rows = o.select(F.col("o_custkey").alias("_file_id"), "o_orderkey", F.col("o_orderstatus").alias("REG"))
    t.replace_by_file(rows, path)
    again = rows.filter("_file_id % 2 = 0 AND REG <> 'P'")
    for _ in range(2):
        t.replace_by_file(again, path)
    return t.read_table(spark, path).select("_file_id", "o_orderkey", "REG")


REPLACE_SQL = """SELECT o_custkey AS _file_id, o_orderkey, o_orderstatus AS "REG" FROM orders o WHERE NOT (o_orderstatus='P' AND o_custkey % 2 = 0
 AND EXISTS (SELECT 1 FROM orders x WHERE x.o_custkey=o.o_custkey AND x.o_orderstatus<>'P'))"""


def convert_formats(spark, sf):
    """parquet -> csv -> parquet; text with a header line and ``;``."""
    base = scratch_dir(spark, "convert")
    t.convert(spark, table(spark, sf, "part"), f"{base}/csv", target_fmt="csv")
    t.convert(spark, f"{base}/csv", f"{base}/parquet", source_fmt="csv")
    return t.read_table(spark, f"{base}/parquet").select(F.col("p_partkey").cast("long").alias("p_partkey"), "p_name", "p_brand", F.col("p_size").cast("int").alias("p_size"),
                                                         F.col("p_retailprice").cast("double").alias("p_retailprice"))


CONVERT_SQL = "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part"


def register_store(spark, sf):
    """The wide table by record type, read back by pruned views; an absent table is None."""
    path = scratch_dir(spark, "silver")
    o = _orders(spark, sf).select(F.col("o_custkey").alias("_file_id"), F.col("o_orderkey").alias("_row_id"), F.col("o_orderstatus").alias("REG"), "y")
    t.write_registers(o, path, ["F", "O"])
    views = t.load_registers(spark, path, ["F", "O", "P"])
    folder = t.load_register_folder(spark, path, "F")
    assert t.load_register_folder(spark, path, "P") is None and t.read_optional(spark, f"{path}-none") is None
    both = views["F"].unionByName(views["O"]).unionByName(views["P"]).unionByName(folder.select(*views["F"].columns))
    return both.groupBy("REG", "y").agg(F.count(F.lit(1)).alias("n"))


STORE_SQL = """SELECT o_orderstatus AS "REG", CAST(year(o_orderdate) AS INTEGER) AS y, count(*) * CASE WHEN o_orderstatus='F' THEN 2 ELSE 1 END AS n FROM orders
 WHERE o_orderstatus IN ('F','O') GROUP BY 1,2"""


def many_folders(spark, sf):
    """Folders with differing partitions, read one by one and united; missing ones left out."""
    base, o = scratch_dir(spark, "many"), _orders(spark, sf)
    o.filter("y < 1998").drop("o_totalprice").write.partitionBy("o_orderstatus").parquet(f"{base}/a")
    o.filter("y >= 1998").write.partitionBy("y").parquet(f"{base}/b")
    out = t.read_many(spark, [f"{base}/a", f"{base}/gone", f"{base}/b"])
    return out.select("o_orderkey", "o_orderstatus", F.col("y").cast("int").alias("y"), "o_totalprice")


MANY_SQL = """SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS y, CASE WHEN year(o_orderdate)>=1998 THEN o_totalprice END AS o_totalprice FROM orders"""


def filtered_report(spark, sf):
    """A checked report write, then a read filtered on its partition column."""
    path = scratch_dir(spark, "report")
    t.write_report(_orders(spark, sf).withColumn("Descrição nula", F.lit(None)), path, plain=True, partition_by=["Y"])
    out = t.read_filtered(spark, path, where={"Y": "1997", "O_ORDERSTATUS": None})
    return out.select("O_ORDERKEY", "O_ORDERSTATUS", F.col("Y").cast("int").alias("Y"), "DESCRICAO_NULA")


FILTERED_SQL = """SELECT o_orderkey AS "O_ORDERKEY", o_orderstatus AS "O_ORDERSTATUS", 1997 AS "Y", CAST(NULL AS VARCHAR) AS "DESCRICAO_NULA" FROM orders WHERE year(o_orderdate)=1997"""

QUERIES = {
    "upsert_table": (upsert_table, UPSERT_SQL), "replace_by_file": (replace_by_file, REPLACE_SQL), "convert_formats": (convert_formats, CONVERT_SQL),
    "register_store": (register_store, STORE_SQL), "many_folders": (many_folders, MANY_SQL), "filtered_report": (filtered_report, FILTERED_SQL),
}

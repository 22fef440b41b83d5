"""Declarative reports and lookups."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fiscalgrove.operators.lookup import (
    asof_regime, code_lookup, enrich, inherit_fields, lookup, numbered_children, outer_consolidate, roll_up_children, roll_up_chunks, safe_join, stamp_regime)
from fiscalgrove.operators.reshape import unpivot_registers
from fiscalgrove.operators.tree import header_of_files, link_parents, propagate_header
from fiscalgrove.operators.columns import project_superset
from fiscalgrove.plans.report import compile_report
from fiscalgrove.sources.records import tag_records, with_cols
from fiscalgrove.session import scratch_dir
from fiscalgrove.sources.tables import registers_of, write_table
from workbench.derive import CATALOGUE, RULES, one_name, record_lines, stored, table

CHAIN = {
    "name": "ITEMS", "base_entity": "C100",
    "entities": {
        "0000": {"source": "0000", "uid": "_row_id", "fields": ["CNPJ", "NOME"]},
        "C100": {"source": "C100", "uid": "_row_id", "parent_uid": "_parent_uid_final", "join_on": "0000",
                 "fields": ["NUM_DOC", "COD_SIT", {"DT_DOC": "DATA"}]},
        "C170": {"source": "C170", "uid": "_row_id", "parent_uid": "_parent_uid_final", "join_on": "C100",
                 "fields": ["NUM_ITEM", "COD_ITEM", "QTD"]},
    },
}


def report_chain(spark, sf):
    """Flagship: text lines -> parse -> tree -> header -> wide table -> item-level report."""
    bronze = stored(tag_records(record_lines(spark, sf)), "bronze")
    wide = project_superset(with_cols(link_parents(bronze, RULES)).drop("value"), CATALOGUE)
    heads = header_of_files(with_cols(bronze), {"CNPJ": F.get("cols", F.lit(2)), "NOME": F.get("cols", F.lit(3))})
    silver = scratch_dir(spark, "silver")
    write_table(propagate_header(wide, heads), silver, partition_by=("REG",))   # a report reads its record types' folders
    out = compile_report(spark, CHAIN, registers_of(spark.read.parquet(silver), ["0000", "C100", "C170"]))
    return out.select("CNPJ", "NOME", "NUM_DOC", "COD_SIT", "DATA", "NUM_ITEM", "COD_ITEM", "QTD",
                      F.col("row_id").cast("long").alias("row_id"))


CHAIN_SQL = """SELECT lpad(CAST(c_custkey AS VARCHAR),14,'0') AS "CNPJ", c_name AS "NOME", CAST(o_orderkey AS VARCHAR) AS "NUM_DOC",
 o_orderstatus AS "COD_SIT", strftime(o_orderdate,'%d%m%Y') AS "DATA", CAST(l_linenumber AS VARCHAR) AS "NUM_ITEM",
 CAST(l_partkey AS VARCHAR) AS "COD_ITEM", CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS "QTD", (l_orderkey + 1) * 16 + l_linenumber AS row_id
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey"""


def star_registers(spark, sf):
    """Registers straight from the tables, linked by natural ids (one 'file' per customer)."""
    cust, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    items = table(spark, sf, "lineitem")
    file_of = orders.select(F.col("o_orderkey").alias("_ok"), F.col("o_custkey").alias("_file_id"))
    owned = items.join(file_of, F.col("l_orderkey") == F.col("_ok")).drop("_ok")
    totals = owned.groupBy("_file_id", "l_orderkey", "l_returnflag").agg(
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("CENTS"), F.count(F.lit(1)).alias("N"))
    return {
        "0000": cust.select(F.col("c_custkey").alias("_file_id"), F.col("c_custkey").alias("FILE_ID"), F.lit(0).cast("long").alias("_row_id"),
                            F.lit(None).cast("long").alias("_parent_uid_final"), "c_name", "c_nationkey"),
        "C100": orders.select(F.col("o_custkey").alias("_file_id"), F.col("o_custkey").alias("FILE_ID"), F.col("o_orderkey").alias("_row_id"),
                              F.lit(0).cast("long").alias("_parent_uid_final"), "o_orderkey", "o_orderstatus", "o_orderpriority"),
        "C170": owned.select("_file_id", F.col("_file_id").alias("FILE_ID"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("_row_id"),
                             F.col("l_orderkey").alias("_parent_uid_final"), "l_partkey", "l_linenumber", "l_quantity"),
        "C190": totals.select("_file_id", F.col("_file_id").alias("FILE_ID"), F.col("l_orderkey").alias("_row_id"),
                              F.col("l_orderkey").alias("_parent_uid_final"), "l_returnflag", "CENTS", "N"),
    }


LATERAL = {
    "name": "ITEMS_AND_TOTALS",
    "entities": {
        "0000": {"source": "0000", "fields": ["c_name"]},
        "C100": {"source": "C100", "join_on": "0000", "fields": ["o_orderkey", "o_orderstatus"]},
        "C170": {"source": "C170", "join_on": "C100", "fields": ["l_linenumber", "l_partkey"]},
        "C190": {"source": "C190", "join_on": "C100", "fields": [{"l_returnflag": "flag"}, "CENTS", "N"]},
        "D990": {"source": "D990", "join_on": "C190", "fields": ["ABSENT"]},
    },
}


def report_lateral(spark, sf):
    """Items of each document times its totals (a lateral child), plus an absent record type."""
    out = compile_report(spark, LATERAL, star_registers(spark, sf))
    return out.select("c_name", "o_orderkey", "o_orderstatus", "l_linenumber", "l_partkey", "flag", "CENTS", "N", "ABSENT")


_TOTALS = """t AS (SELECT l_orderkey AS k, l_returnflag AS flag, CAST(sum(CAST(round(l_extendedprice*100) AS BIGINT)) AS BIGINT) AS "CENTS", count(*) AS "N"
 FROM lineitem GROUP BY 1,2)"""
LATERAL_SQL = f"""WITH {_TOTALS} SELECT c_name, o_orderkey, o_orderstatus, l_linenumber, l_partkey, flag, "CENTS", "N", CAST(NULL AS VARCHAR) AS "ABSENT"
 FROM lineitem JOIN orders ON l_orderkey=o_orderkey LEFT JOIN customer ON c_custkey=o_custkey LEFT JOIN t ON t.k=o_orderkey"""


def report_same_names(spark, sf):
    """Files of all companies share one name, and their line ids start alike: only the path tells them apart."""
    regs = star_registers(spark, sf)
    nth = F.row_number().over(Window.partitionBy("_file_id").orderBy("o_orderkey")).cast("long")
    docs = regs["C100"].withColumn("_nth", nth)
    place = docs.select(F.col("o_orderkey").alias("_ok"), "_nth")
    items = regs["C170"].join(place, F.col("_parent_uid_final") == F.col("_ok")).withColumn("_parent_uid_final", F.col("_nth")).drop("_ok", "_nth")
    spec = {"name": "ITEMS", "entities": {k: LATERAL["entities"][k] for k in ("0000", "C100", "C170")}}
    out = compile_report(spark, spec, one_name({"0000": regs["0000"], "C100": docs.withColumn("_row_id", F.col("_nth")).drop("_nth"), "C170": items}))
    return out.select("c_name", "o_orderkey", "o_orderstatus", "l_linenumber", "l_partkey")


SAME_SQL = """SELECT c_name, o_orderkey, o_orderstatus, l_linenumber, l_partkey FROM lineitem JOIN orders ON l_orderkey=o_orderkey
 LEFT JOIN customer ON c_custkey=o_custkey"""


def report_document_grain(spark, sf):
    """A declared grain: documents without items stay, items come as lateral rows."""
    spec = {"name": "DOCS", "grain": "C100", "entities": {k: LATERAL["entities"][k] for k in ("0000", "C100", "C170")}}
    return compile_report(spark, spec, star_registers(spark, sf)).select("c_name", "o_orderkey", "l_linenumber", "l_partkey")


GRAIN_SQL = """SELECT c_name, o_orderkey, l_linenumber, l_partkey FROM orders LEFT JOIN lineitem ON l_orderkey=o_orderkey
 LEFT JOIN customer ON c_custkey=o_custkey"""

DOC_UNION = {
    "name": "GENERAL",
    "document_sources": {
        "C100_C170": {"reg_type": "C100/C170", "base": "C100",
                      "children": [{"source": "C170", "join_on": "_parent_uid_final", "join_to": "_row_id"}],
                      "fields": ["FILE_ID", "o_orderkey", {"l_partkey": "COD_ITEM"}, "l_linenumber", "NOT_THERE"]},
        "C190": {"source": "C190", "fields": ["FILE_ID", {"_row_id": "o_orderkey"}, "CENTS"]},
        "D100": {"source": "D100", "fields": ["FILE_ID", "ONLY_D100"]},
    },
    "enrichments": {
        "item": {"source": "PART", "join_keys": [{"COD_ITEM": "p_partkey"}], "fields": [{"p_name": "NOME_ITEM"}]},
        "client": {"source": "0000", "join_keys": [{"FILE_ID": "FILE_ID"}], "fields": [{"c_name": "NOME"}]},
        "none": {"source": "0500", "join_keys": ["COD_CTA"], "fields": ["NOME_CTA"]},
    },
    "output_columns": ["REG_TIPO", "FILE_ID", "NOME", "COD_ITEM", "NOME_ITEM", "o_orderkey"],
}


def report_document_union(spark, sf):
    """Documents flattened with items, their totals, an absent block; then lookups."""
    regs = {**star_registers(spark, sf), "PART": table(spark, sf, "part")}
    out = compile_report(spark, DOC_UNION, regs)
    return out.select("REG_TIPO", F.col("FILE_ID").cast("long").alias("FILE_ID"), "NOME", F.col("COD_ITEM").cast("long").alias("COD_ITEM"), "NOME_ITEM",
                      F.col("o_orderkey").cast("long").alias("o_orderkey"), "l_linenumber", "NOT_THERE", "CENTS", "ONLY_D100", "NOME_CTA")


DOC_UNION_SQL = f"""WITH {_TOTALS}, u AS (SELECT 'C100/C170' AS "REG_TIPO", o_custkey AS "FILE_ID", l_partkey AS "COD_ITEM", o_orderkey, l_linenumber, CAST(NULL AS BIGINT) AS "CENTS"
  FROM orders LEFT JOIN lineitem ON l_orderkey=o_orderkey
 UNION ALL SELECT 'C190', o_custkey, NULL, o_orderkey, NULL, "CENTS" FROM t JOIN orders ON k=o_orderkey)
SELECT "REG_TIPO", "FILE_ID", c_name AS "NOME", "COD_ITEM", p_name AS "NOME_ITEM", o_orderkey, l_linenumber, CAST(NULL AS VARCHAR) AS "NOT_THERE", "CENTS",
 CAST(NULL AS VARCHAR) AS "ONLY_D100", CAST(NULL AS VARCHAR) AS "NOME_CTA" FROM u LEFT JOIN part ON p_partkey="COD_ITEM" LEFT JOIN customer ON c_custkey="FILE_ID\""""

KEYED = {
    "name": "KEYED", "base_entity": "C170",
    "entities": {
        "C170": {"source": "C170", "uid": "_row_id", "parent_uid": "_parent_uid_final", "fields": ["FILE_ID", "l_partkey", "l_linenumber"]},
        "0000": {"source": "0000", "uid": "FILE_ID", "fields": ["c_name"], "join": {"keys": [{"left": "FILE_ID", "right": "0000_UID"}], "type": "left"}},
        "C100": {"source": "C100", "uid": "_row_id", "fields": ["o_orderkey", "o_orderstatus"],
                 "join": {"strategy": "parent_child", "type": "inner", "keys": [{"left": "C170_PARENT_UID", "right": "C100_UID"}]}},
    },
}


def report_keyed(spark, sf):
    """Explicit keyed joins from a base entity; the root is joined last."""
    return compile_report(spark, KEYED, star_registers(spark, sf)).select("FILE_ID", "l_partkey", "l_linenumber", "o_orderkey", "o_orderstatus", "c_name")


KEYED_SQL = """SELECT o_custkey AS "FILE_ID", l_partkey, l_linenumber, o_orderkey, o_orderstatus, c_name FROM lineitem JOIN orders ON l_orderkey=o_orderkey
 LEFT JOIN customer ON c_custkey=o_custkey"""

SOURCE_UNION = {
    "name": "UNION", "mode": "union", "output_schema": ["FILE_ID", "DOC", "ITEM", "NOME", "N_ITEMS"],
    "sources": {
        "items": {"root": "C170", "doc_type": "ITEM", "enrichments": [
            {"register": "C100", "strategy": "parent_ref", "key": {"from": "_parent_uid_final", "to": "_row_id"}, "fields": ["o_orderkey"]},
            {"register": "0000", "strategy": "file_ref", "key": {"from": "_file_id", "to": "_file_id"}, "fields": [{"c_name": "client"}]}],
            "field_mapping": {"FILE_ID": "FILE_ID", "o_orderkey": "DOC", "l_partkey": "ITEM", "client": "NOME", "absent": "N_ITEMS"}},
        "docs": {"root": "C100", "doc_type": "DOC", "enrichments": [
            {"register": "C170", "strategy": "child_agg", "agg": "first", "key": {"from": "_row_id", "to": "_parent_uid_final"}, "fields": [{"l_linenumber": "first_line"}]}],
            "field_mapping": {"FILE_ID": "FILE_ID", "o_orderkey": "DOC", "first_line": "N_ITEMS"}},
        "gone": {"root": "Z999", "doc_type": "Z"},
    },
}


def report_source_union(spark, sf):
    """Enriched sources mapped to one declared schema and united."""
    out = compile_report(spark, SOURCE_UNION, star_registers(spark, sf))
    return out.select("DOC_TYPE", *[F.col(c).cast("string").alias(c) for c in SOURCE_UNION["output_schema"]])


SOURCE_UNION_SQL = """SELECT 'ITEM' AS "DOC_TYPE", CAST(o_custkey AS VARCHAR) AS "FILE_ID", CAST(o_orderkey AS VARCHAR) AS "DOC", CAST(l_partkey AS VARCHAR) AS "ITEM", c_name AS "NOME", CAST(NULL AS VARCHAR) AS "N_ITEMS"
 FROM lineitem JOIN orders ON l_orderkey=o_orderkey LEFT JOIN customer ON c_custkey=o_custkey
UNION ALL SELECT 'DOC', CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR), NULL, NULL, CAST(min(l_linenumber) AS VARCHAR)
 FROM orders LEFT JOIN lineitem ON l_orderkey=o_orderkey GROUP BY o_custkey, o_orderkey"""


def coalesce_lookup(spark, sf):
    """Supplier by key; where there is none, by nation."""
    cust = table(spark, sf, "customer").withColumn("code", F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(" "), F.col("c_custkey").cast("string"))))
    by_nation = table(spark, sf, "nation").select(F.lit(None).cast("long").alias("s_key"), F.col("n_nationkey").alias("nat"), F.col("n_name").alias("label"))
    by_key = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("s_key"), F.lit(None).cast("int").alias("nat"), F.col("s_name").alias("label"))
    return lookup(cust, by_key.unionByName(by_nation), [{"code": "s_key"}, {"c_nationkey": "nat"}], ["label"], mode="coalesce").select("c_custkey", "label")


COALESCE_SQL = """SELECT c_custkey, coalesce(s_name, n_name) AS label FROM customer LEFT JOIN supplier ON c_custkey % 3 = 0 AND s_suppkey = c_custkey
 LEFT JOIN nation ON n_nationkey = c_nationkey"""


def simple_lookup(spark, sf):
    """Trimmed text keys, all of which must agree; the source reduced to one row per key."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lit("  "), F.col("l_suppkey").cast("string")).alias("sk"), "l_partkey")
    src = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("p"), F.col("l_quantity").alias("least_qty"))
    return lookup(li, src, [{"sk": "s"}, {"l_partkey": "p"}], ["least_qty"]).select("l_orderkey", "l_linenumber", "l_partkey", "least_qty")


SIMPLE_SQL = """SELECT l_orderkey, l_linenumber, l_partkey, q AS least_qty FROM lineitem JOIN
 (SELECT l_suppkey AS s, l_partkey AS p, min(l_quantity) AS q FROM lineitem GROUP BY 1,2) x ON s=l_suppkey AND p=l_partkey"""


def child_rollup(spark, sf):
    """Children aggregated before the join: the first part by line number and all parts in order."""
    items = table(spark, sf, "lineitem").withColumn("_row_id", F.col("l_linenumber"))
    orders = table(spark, sf, "orders").select("o_orderkey")
    first = enrich(orders, items, strategy="child_agg", key={"from": "o_orderkey", "to": "l_orderkey"}, fields=[{"l_partkey": "first_part"}])
    every = roll_up_children(items, "l_orderkey", [{"l_partkey": "parts"}], "collect_list")
    return first.join(every, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey", "first_part", F.array_join(F.transform("parts", lambda x: x.cast("string")), ",").alias("parts"))


ROLLUP_SQL = """SELECT o_orderkey, first_part, parts FROM orders LEFT JOIN (SELECT l_orderkey, (array_agg(l_partkey ORDER BY l_linenumber, l_partkey))[1] AS first_part,
 string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey) AS parts FROM lineitem GROUP BY 1) ON l_orderkey=o_orderkey"""


def child_rollup_chunks(spark, sf):
    """Children as chunked arrays, a third of all lines under one parent; every value with its place among its parent's."""
    hot = F.when(F.col("l_orderkey") % 3 == 0, F.lit(-1).cast("long")).otherwise(F.col("l_orderkey").cast("long"))
    items = table(spark, sf, "lineitem").select(hot.alias("parent"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long").alias("_row_id"), "l_partkey")
    chunks = roll_up_chunks(items, "parent", [{"l_partkey": "part"}], lines=4096)
    return numbered_children(chunks, "parent", "part")


CHUNKS_SQL = """SELECT parent, row_number() OVER (PARTITION BY parent ORDER BY line, part) - 1 AS place, part FROM
 (SELECT CASE WHEN l_orderkey % 3 = 0 THEN -1 ELSE l_orderkey END AS parent, l_orderkey * 8 + l_linenumber AS line, l_partkey AS part FROM lineitem)"""


def field_inheritance(spark, sf):
    """Document fields copied to item lines."""
    r = star_registers(spark, sf)
    return inherit_fields(r["C170"], r["C100"], ["o_orderstatus", "o_orderpriority"]).select("_row_id", "l_partkey", "o_orderstatus", "o_orderpriority")


INHERIT_SQL = """SELECT l_orderkey*8+l_linenumber AS _row_id, l_partkey, o_orderstatus, o_orderpriority FROM lineitem JOIN orders ON l_orderkey=o_orderkey"""


def asof_lookup(spark, sf):
    """Latest yearly regime up to the year of shipment."""
    orders = table(spark, sf, "orders")
    regimes = orders.groupBy(F.col("o_custkey").alias("cnpj"), F.year("o_orderdate").alias("ano")).agg(F.max("o_orderpriority").alias("regime"))
    items = table(spark, sf, "lineitem").join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    out = asof_regime(items, regimes, root=F.col("o_custkey").cast("string"), year=F.year("l_shipdate") - 2)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "REGIME_TRIBUTARIO")


ASOF_SQL = """WITH r AS (SELECT o_custkey AS c, year(o_orderdate) AS y, max(o_orderpriority) AS g FROM orders GROUP BY 1,2),
i AS (SELECT row_number() OVER () AS id, l_orderkey, l_linenumber, l_partkey, o_custkey, year(l_shipdate)-2 AS y FROM lineitem JOIN orders ON l_orderkey=o_orderkey)
SELECT any_value(l_orderkey) AS l_orderkey, any_value(l_linenumber) AS l_linenumber, any_value(l_partkey) AS l_partkey, coalesce(arg_max(g, r.y),'NAO_LOCALIZADO') AS "REGIME_TRIBUTARIO"
 FROM i LEFT JOIN r ON r.c=o_custkey AND r.y<=i.y GROUP BY id"""


def code_attributes(spark, sf):
    """Attributes of a zero-padded code."""
    codes = table(spark, sf, "nation").select((F.col("n_nationkey") + 5).alias("cfop"), F.col("n_name").alias("DESC"))
    return code_lookup(table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("CFOP")), codes, code="CFOP", source_code="cfop", fields=["DESC"])


CODE_SQL = """SELECT c_custkey, lpad(CAST(c_nationkey AS VARCHAR),4,'0') AS "CFOP", n_name AS "DESC" FROM customer LEFT JOIN nation ON n_nationkey+5=c_nationkey"""


def consolidate_outer(spark, sf):
    """Full outer join of metric frames on (company, year); a clash keeps the left column."""
    o = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("y"), "o_orderstatus")
    part = lambda s, n: o.filter(F.col("o_orderstatus") == s).groupBy("o_custkey", "y").agg(
        F.count(F.lit(1)).alias(n), F.count(F.lit(1)).alias("both"))
    out = outer_consolidate([part("F", "nf"), None, part("O", "no"), part("P", "np")], ["o_custkey", "y"])
    return safe_join(out, None, ["o_custkey"])


OUTER_SQL = """WITH f AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS nf, count(*) AS "both" FROM orders WHERE o_orderstatus='F' GROUP BY 1,2),
o AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS no FROM orders WHERE o_orderstatus='O' GROUP BY 1,2),
p AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS np FROM orders WHERE o_orderstatus='P' GROUP BY 1,2),
k AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders WHERE o_orderstatus IN ('F','O','P'))
SELECT o_custkey, y, nf, "both", no, np FROM k LEFT JOIN f USING (o_custkey,y) LEFT JOIN o USING (o_custkey,y) LEFT JOIN p USING (o_custkey,y)"""


def regime_stamp(spark, sf):
    """Regime of the company as of the period's year on documents; headers stay without."""
    o = table(spark, sf, "orders")
    lines = o.select(F.lpad(F.col("o_custkey").cast("string"), 8, "0").alias("CNPJ"), F.date_format("o_orderdate", "ddMMyyyy").alias("DT_INI"),
                     F.when(F.col("o_orderstatus") == "P", "0000").otherwise("C100").alias("REG"), "o_orderkey")
    c = table(spark, sf, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("cnpj"), "c_mktsegment", "c_nationkey")
    regimes = c.select("cnpj", F.lit(1993).alias("ano"), F.col("c_mktsegment").alias("regime")).unionByName(
        c.filter("c_nationkey < 12").select("cnpj", F.lit(1996).alias("ano"), F.lit("LATER").alias("regime")))
    return stamp_regime(lines, regimes, source="TABLE", registers=["C100"]).select("o_orderkey", "REG", "REGIME_TRIBUTARIO", "REGIME_FONTE")


REGIME_SQL = """SELECT o_orderkey, CASE WHEN o_orderstatus='P' THEN '0000' ELSE 'C100' END AS "REG",
 CASE WHEN o_orderstatus='P' THEN NULL WHEN year(o_orderdate) >= 1996 AND c_nationkey < 12 THEN 'LATER' WHEN year(o_orderdate) >= 1993 AND c_custkey IS NOT NULL THEN c_mktsegment
  ELSE 'NAO_LOCALIZADO' END AS "REGIME_TRIBUTARIO", CASE WHEN o_orderstatus<>'P' THEN 'TABLE' END AS "REGIME_FONTE" FROM orders LEFT JOIN customer ON c_custkey=o_custkey"""


def unpivot_wide(spark, sf):
    """Suffixed wide columns to one row per record type."""
    wide = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("C100_UID"), F.col("o_orderstatus").alias("SIT_C100"),
        F.col("o_orderpriority").alias("PRI_C100"), F.col("c_custkey").alias("A010_UID"), F.col("c_mktsegment").alias("SIT_A010"))
    return unpivot_registers(wide, {"C100": {"fields": ["SIT", "PRI"]}, "A010": {"fields": ["SIT"]}, "Z100": {"fields": []}})


UNPIVOT_SQL = """SELECT o_orderkey, 'C100' AS "TIPO_REG", o_orderstatus AS "SIT", o_orderpriority AS "PRI" FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_orderkey, 'A010', c_mktsegment, NULL FROM orders JOIN customer ON c_custkey=o_custkey"""

QUERIES = {
    "report_chain": (report_chain, CHAIN_SQL), "report_lateral": (report_lateral, LATERAL_SQL),
    "report_document_grain": (report_document_grain, GRAIN_SQL), "report_same_names": (report_same_names, SAME_SQL), "report_document_union": (report_document_union, DOC_UNION_SQL),
    "report_keyed": (report_keyed, KEYED_SQL), "report_source_union": (report_source_union, SOURCE_UNION_SQL),
    "coalesce_lookup": (coalesce_lookup, COALESCE_SQL), "simple_lookup": (simple_lookup, SIMPLE_SQL),
    "child_rollup": (child_rollup, ROLLUP_SQL), "child_rollup_chunks": (child_rollup_chunks, CHUNKS_SQL), "field_inheritance": (field_inheritance, INHERIT_SQL),
    "asof_lookup": (asof_lookup, ASOF_SQL), "code_lookup": (code_attributes, CODE_SQL),
    "consolidate_outer": (consolidate_outer, OUTER_SQL), "regime_stamp": (regime_stamp, REGIME_SQL), "unpivot_wide": (unpivot_wide, UNPIVOT_SQL),
}

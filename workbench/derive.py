"""Fiscal-looking inputs derived from the given tables (whole tables, no sampling)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalgrove.catalog import catalogue_from_mapping
from fiscalgrove.session import freed, scratch_dir

CATALOGUE = catalogue_from_mapping({
    "0000": "CNPJ NOME UF DT_INI",
    "C100": "NUM_DOC COD_SIT VL_DOC DT_DOC",
    "C170": "NUM_ITEM COD_ITEM QTD VL_ITEM CST CFOP",
})
RULES = [{"parent": "0000", "children": ["C100"]}, {"parent": "C100", "children": ["C170"]}]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared scratch folder and read back: cuts the plan, survives executors. Its shuffle files go with the write."""
    path = scratch_dir(df.sparkSession, name)
    with freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def one_name(registers: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The same records as if all files had one name; their paths tell them apart."""
    return {k: df.withColumns({"_file_key": F.col("_file_id").cast("string"), "_file_id": F.lit("sped.txt")}) for k, df in registers.items()}


def br_text(c: Column) -> Column:
    """1234.5 -> ``1.234,50``"""
    return F.translate(F.format_number(c, 2), ",.", ".,")


def br_amount(c: Column) -> Column:
    """1234.5 -> ``1234,50`` (no thousands separators)"""
    return F.translate(c.cast("decimal(18,2)").cast("string"), ".", ",")


def pipe(*cols: Column) -> Column:
    return F.concat_ws("|", F.lit(""), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols], F.lit(""))


def cnpj(custkey: str) -> Column:
    return F.lpad(F.col(custkey).cast("string"), 14, "0")


def record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipe-delimited lines: a header per customer, a document per order, an item per lineitem.

    ``_row_id`` follows the order of a return: header, then each document with its items.
    """
    customers = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders")
    items = table(spark, sf_dir, "lineitem").join(
        orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("_cust")), "l_orderkey")
    head = customers.select(
        F.col("c_custkey").alias("_source_file"), F.lit(0).cast("long").alias("_row_id"),
        pipe(F.lit("0000"), cnpj("c_custkey"), F.col("c_name"), F.col("c_nationkey"), F.lit("01032023")).alias("value"))
    docs = orders.select(
        F.col("o_custkey").alias("_source_file"), ((F.col("o_orderkey") + 1) * 16).alias("_row_id"),
        pipe(F.lit("C100"), F.col("o_orderkey"), F.col("o_orderstatus"), br_amount(F.col("o_totalprice")),
             F.date_format("o_orderdate", "ddMMyyyy")).alias("value"))
    lines = items.select(
        F.col("_cust").alias("_source_file"),
        ((F.col("l_orderkey") + 1) * 16 + F.col("l_linenumber")).alias("_row_id"),
        pipe(F.lit("C170"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_quantity").cast("int"),
             br_amount(F.col("l_extendedprice")), F.col("l_returnflag"), F.col("l_linestatus")).alias("value"))
    every = head.unionByName(docs).unionByName(lines)
    return every.withColumns({"_source_file": F.col("_source_file").cast("string"),
                              "_file_id": F.col("_source_file").cast("string")})


# ------------------------------------------------------ annual-return sources
_L300_CODE = {"1-URGENT": "3.01", "2-HIGH": "3.01.01.07.01.13", "3-MEDIUM": "3.01.01.05.01.04",
              "4-NOT SPECIFIED": "3.01.01.09.01.04", "5-LOW": "9"}
_M310_CODE = {"1-URGENT": "106", "2-HIGH": "106.05", "3-MEDIUM": "106.10", "4-NOT SPECIFIED": "166.03", "5-LOW": "7"}
_PAY_CODE = {"1-URGENT": "5993", "2-HIGH": "2484", "3-MEDIUM": "2089", "4-NOT SPECIFIED": "2372", "5-LOW": "0001"}


def _coded(mapping: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]),
                            F.col("o_orderpriority"))


def yearly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with company number, period start and a signed amount."""
    signed = F.when(F.col("o_orderstatus") == "P", -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    return table(spark, sf_dir, "orders").select(
        cnpj("o_custkey").alias("CNPJ"),
        F.concat(F.lit("0101"), F.year("o_orderdate").cast("string")).alias("DT_INI"),
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", signed.alias("_signed"),
        F.when(F.col("o_orderstatus") == "O", "A12").otherwise("A00").alias("PER_APUR"))


def annual_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    o = yearly_orders(spark, sf_dir)
    keys = ["CNPJ", "DT_INI"]
    first = F.min("o_orderpriority")
    regime = o.groupBy(*keys).agg(
        F.when(first == "1-URGENT", "RRRR").when(first == "2-HIGH", "P").otherwise("A").alias("FORMA_TRIB_PER"))
    return {
        "0010": regime,
        "L300": o.select(*keys, _coded(_L300_CODE).alias("CODIGO"), "PER_APUR", br_text(F.col("_signed")).alias("VALOR")),
        "M310": o.select(*keys, _coded(_M310_CODE).alias("CODIGO"), "PER_APUR", br_text(F.col("_signed")).alias("VL_CTA")),
        "L100": o.select(*keys, F.when(F.col("o_orderpriority") == "2-HIGH", "2.03").otherwise("1").alias("CODIGO"),
                         "PER_APUR", F.col("o_orderkey").alias("_row_id"),
                         br_text(F.col("_signed")).alias("VAL_CTA_REF_INI")),
        "N500": o.select(*keys, br_text(F.col("_signed")).alias("VALOR")),
        "Y570": o.withColumn("_held", F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice")).otherwise(0.0)).select(
            *keys, br_text(F.col("_held")).alias("IR_RET"),
            F.when(F.col("o_orderpriority") == "5-LOW", br_text(F.col("_held"))).alias("CSLL_RET")),
        "payments": o.select(*keys, _coded(_PAY_CODE).alias("codigo_receita"),
                             F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0.0)
                             .alias("valor_principal")),
        "company": table(spark, sf_dir, "customer").select(cnpj("c_custkey").alias("CNPJ"), F.col("c_name").alias("NOME"))
        .join(o.select(*keys).distinct(), "CNPJ"),
    }

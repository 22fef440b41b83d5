"""Subsidy valuation, eligibility and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from fiscalgrove.operators.audit import distinct_sets, fan_out_audit, frequency_profile, missing_files
from fiscalgrove.operators.subsidy import (
    eligibility_funnel, eligible_periods, periods_until, unexpected_cfops, value_operations, with_cfop_sign)
from workbench.derive import br_text, one_name, table


def _by(column: str, mapping: dict[str, str], default=None):
    out = None
    for k, v in mapping.items():
        out = F.when(F.col(column) == k, v) if out is None else out.when(F.col(column) == k, v)
    return out.otherwise(default)


def registers(spark, sf):
    orders, items = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    nation, cust, supp = (table(spark, sf, t) for t in ("nation", "customer", "supplier"))
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    totals = items.join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate"), "l_orderkey").groupBy(
        "o_custkey", "l_orderkey", "o_orderdate", "l_returnflag", "l_linestatus").agg(
        F.sum(cents).alias("cents"), F.sum(F.when(F.col("l_linenumber") > 3, F.col("l_quantity").cast("long")).otherwise(0)).alias("red"))
    code = _by("l_returnflag", {"A": "0", "R": "2"}, "4").cast("long") + F.when(F.col("l_linestatus") == "O", 1).otherwise(0)
    cfop = F.when(F.col("l_linestatus") == "O", "5102").when(F.col("l_returnflag") == "A", "2201").otherwise("1202")
    c190 = totals.select(
        F.col("o_custkey").alias("_file_id"), (F.col("l_orderkey") * 8 + code).alias("_row_id"), F.col("l_orderkey").alias("_parent_uid_final"),
        F.lpad(F.col("o_custkey").cast("string"), 14, "0").alias("CNPJ"), F.date_format("o_orderdate", "ddMMyyyy").alias("DT_INI"),
        _by("l_returnflag", {"A": "040", "R": "020"}, "051").alias("CST_ICMS"), cfop.alias("CFOP"), br_text(F.col("cents") / 100).alias("VL_OPR"),
        F.when(F.col("red") > 0, br_text(F.col("red").cast("double"))).alias("VL_RED_BC"), F.lit("18,00").alias("ALIQ_ICMS"))
    part = (F.col("o_orderkey") % 200).cast("string")
    c100 = orders.select(
        F.col("o_custkey").alias("_file_id"), F.col("o_orderkey").alias("_row_id"), _by("o_orderstatus", {"F": "1", "O": "0"}).alias("IND_OPER"),
        F.when(F.col("o_orderpriority") == "5-LOW", "65").otherwise("55").alias("COD_MOD"), part.alias("COD_PART"),
        F.date_format("o_orderdate", "ddMMyyyy").alias("DT_DOC"), F.col("o_orderkey").cast("string").alias("NUM_DOC"), F.lit("0").alias("IND_FRT"))
    people = orders.select(F.col("o_custkey").alias("_file_id"), F.col("o_orderkey").alias("_row_id"), part.alias("COD_PARTICIPANTE")).join(
        supp.select(F.col("s_suppkey").cast("string").alias("COD_PARTICIPANTE"), F.col("s_name").alias("NOME_PARTICIPANTE"),
                    F.col("s_nationkey").cast("string").alias("COD_MUN_PARTICIPANTE")), "COD_PARTICIPANTE").withColumns(
        {c: F.lit(None).cast("string") for c in ("CNPJ_PARTICIPANTE", "CPF_PARTICIPANTE", "IE_PARTICIPANTE")})
    head = cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("_file_id"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("UF"))
    return {"C190": c190, "C100": c100, "0150": people, "0000": head}


def references(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    towns = nation.select(F.col("n_nationkey").alias("cod_mun"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("uf"))
    pair = region.select(F.col("r_regionkey").alias("o"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("d"))
    rates = pair.filter((F.col("o") + F.col("d")) % 4 != 3).select(
        F.concat(F.lit("R"), F.col("o").cast("string")).alias("Origem"), F.concat(F.lit("R"), F.col("d").cast("string")).alias("Destino"),
        (F.col("o") + F.col("d") + 7).cast("double").alias("Aliquota"))
    status = table(spark, sf, "lineitem").select("l_linestatus").distinct()
    cfop = status.select(F.when(F.col("l_linestatus") == "O", 5102).otherwise(1202).alias("cfop"), F.concat(F.lit("CFOP "), F.col("l_linestatus")).alias("descricao"),
                         F.when(F.col("l_linestatus") == "O", "Venda").otherwise("Devolução de venda").alias("natureza"))
    return {"cfop": cfop, "municipios": towns, "aliquotas": rates}


_PICK = ["CNPJ", "NUMERO_DOCUMENTO", "CST_ICMS", "CFOP", "CFOP_FATURAMENTO", "DESCRICAO_CFOP", "TIPO_OPERACAO", "NOME_PARTICIPANTE", "UF_ORIGEM_DESTINO",
         "ORIGEM", "DESTINO", "ALIQUOTA", "VLR_OPERACAO", "VLR_REDUCAO_BASE_ICMS", "ANO", "MODELO", "INDICADOR_FRETE"]
_SUB = """t AS (SELECT o_custkey AS cust, l_orderkey AS k, l_returnflag AS rf, l_linestatus AS ls, CAST(sum(CAST(round(l_extendedprice*100) AS BIGINT)) AS BIGINT)/100.0 AS opr,
  nullif(CAST(sum(CASE WHEN l_linenumber>3 THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS DOUBLE),0) AS red FROM lineitem JOIN orders ON o_orderkey=l_orderkey GROUP BY 1,2,3,4),
d AS (SELECT t.*, o_orderdate, o_orderstatus AS st, o_orderpriority='5-LOW' AS m65, s_name, 'R'||cn.n_regionkey AS own, 'R'||sn.n_regionkey AS par FROM t JOIN orders ON o_orderkey=k
  JOIN customer ON c_custkey=cust JOIN nation cn ON cn.n_nationkey=c_nationkey LEFT JOIN supplier ON s_suppkey=k%200 LEFT JOIN nation sn ON sn.n_nationkey=s_nationkey),
e AS (SELECT *, CASE WHEN m65 THEN own||'/'||own ELSE coalesce(CASE st WHEN 'F' THEN own||'/'||par WHEN 'O' THEN par||'/'||own END, own||'/'||own) END AS pair FROM d),
f AS (SELECT *, CASE WHEN (CAST(substr(pair,2,1) AS INT)+CAST(substr(pair,5,1) AS INT))%4<>3 THEN CAST(CAST(substr(pair,2,1) AS INT)+CAST(substr(pair,5,1) AS INT)+7 AS DOUBLE) END AS rate,
  CASE WHEN ls='O' THEN 1 ELSE -1 END AS sgn, CASE WHEN ls='O' THEN 5102 WHEN rf='A' THEN 2201 ELSE 1202 END AS cf FROM e)"""
_COLS = """lpad(CAST(cust AS VARCHAR),14,'0') AS "CNPJ", CAST(k AS VARCHAR) AS "NUMERO_DOCUMENTO", CASE rf WHEN 'A' THEN '040' WHEN 'R' THEN '020' ELSE '051' END AS "CST_ICMS", cf AS "CFOP",
 CASE cf WHEN 5102 THEN 'Faturamento' WHEN 1202 THEN 'Devolução Faturamento' END AS "CFOP_FATURAMENTO", CASE cf WHEN 5102 THEN 'CFOP O' WHEN 1202 THEN 'CFOP F' END AS "DESCRICAO_CFOP",
 CASE st WHEN 'F' THEN '1 - Saida' WHEN 'O' THEN '0 - Entrada' END AS "TIPO_OPERACAO", s_name AS "NOME_PARTICIPANTE", pair AS "UF_ORIGEM_DESTINO", substr(pair,1,2) AS "ORIGEM", substr(pair,4,2) AS "DESTINO",
 rate AS "ALIQUOTA", CAST(opr AS DOUBLE) AS "VLR_OPERACAO", red AS "VLR_REDUCAO_BASE_ICMS", CAST(year(o_orderdate) AS INTEGER) AS "ANO", CASE WHEN m65 THEN '65' ELSE '55' END AS "MODELO",
 '0 - Contratação do frete por conta do remetente(CIF)' AS "INDICADOR_FRETE\""""


def subsidy_exemption(spark, sf):
    """Operation value x rate of the state pair x sign, for exempt totals."""
    out = value_operations(registers(spark, sf), references(spark, sf))["exemption"]
    return out.select(*_PICK, F.round("CALCULO_DA_ISENCAO", 4).alias("CALCULO_DA_ISENCAO"))


EXEMPT_SQL = f"""WITH {_SUB} SELECT {_COLS}, round(CAST(opr AS DOUBLE)*(rate/100.0)*sgn,4) AS "CALCULO_DA_ISENCAO" FROM f WHERE rf='A' OR (rf='N' AND red IS NULL)"""


def subsidy_same_names(spark, sf):
    """The exemption where the files of all companies share one name."""
    out = value_operations(one_name(registers(spark, sf)), references(spark, sf))["exemption"]
    return out.select(*_PICK, F.round("CALCULO_DA_ISENCAO", 4).alias("CALCULO_DA_ISENCAO"))


def subsidy_reduction(spark, sf):
    """Base reduction x own rate x sign, for reduced totals."""
    out = value_operations(registers(spark, sf), references(spark, sf))["reduction"]
    return out.select(*_PICK, F.round("CALCULO_DA_REDUCAO", 4).alias("CALCULO_DA_REDUCAO"))


REDUCE_SQL = f"""WITH {_SUB} SELECT {_COLS}, round(red*(18.0/100.0)*sgn,4) AS "CALCULO_DA_REDUCAO" FROM f WHERE rf='R' OR (rf='N' AND red IS NOT NULL)"""


def subsidy_without_documents(spark, sf):
    """No document records: no exemption, the reduction goes on with empty columns."""
    regs = {"C190": registers(spark, sf)["C190"]}
    out = value_operations(regs, references(spark, sf))
    assert out["exemption"] is None
    return out["reduction"].select("CNPJ", "CST_ICMS", "CFOP", "UF_ORIGEM_DESTINO", "ALIQUOTA", F.round("CALCULO_DA_REDUCAO", 4).alias("CALCULO_DA_REDUCAO"))


NODOC_SQL = f"""WITH {_SUB} SELECT lpad(CAST(cust AS VARCHAR),14,'0') AS "CNPJ", CASE rf WHEN 'R' THEN '020' ELSE '051' END AS "CST_ICMS", cf AS "CFOP", CAST(NULL AS VARCHAR) AS "UF_ORIGEM_DESTINO",
 CAST(NULL AS DOUBLE) AS "ALIQUOTA", round(red*(18.0/100.0)*sgn,4) AS "CALCULO_DA_REDUCAO" FROM f WHERE rf='R' OR (rf='N' AND red IS NOT NULL)"""


def _item_codes(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("ano"), F.date_format("l_shipdate", "yyyyMM").alias("period"), _by("l_returnflag", {"A": "040", "R": "020"}, "000").alias("CST_ICMS"),
        F.when(F.col("l_linestatus") == "O", "5102").when(F.col("l_quantity") > 10, "1202").otherwise("bad").alias("CFOP"), "l_orderkey", "l_linenumber")


def funnel(spark, sf):
    """Rows in all, after the CST list, after the CFOP list; per year, one aggregate."""
    return eligibility_funnel(_item_codes(spark, sf), ["ano"])


FUNNEL_SQL = """SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, count(*) AS total, count(*) FILTER (l_returnflag IN ('A','R')) AS after_cst,
 count(*) FILTER (l_returnflag IN ('A','R') AND (l_linestatus='O' OR l_quantity>10)) AS after_cfop FROM lineitem GROUP BY 1"""


def eligibility(spark, sf):
    """0/1 per part: any eligible line? Periods up to a year."""
    return eligible_periods(periods_until(_item_codes(spark, sf), last_year=1996), ["period", "l_orderkey"])


ELIG_SQL = """SELECT strftime(l_shipdate,'%Y%m') AS period, l_orderkey, max(CASE WHEN l_returnflag IN ('A','R') AND (l_linestatus='O' OR l_quantity>10) THEN 1 ELSE 0 END) AS has_candidates
 FROM lineitem WHERE year(l_shipdate)<=1996 GROUP BY 1,2"""


def cfop_signs(spark, sf):
    """Sign by nature, else by first digit; codes that are no number count as issues."""
    c = _item_codes(spark, sf).withColumn("CFOP", F.when(F.col("l_linenumber") == 7, "2201").otherwise(F.col("CFOP")))
    return with_cfop_sign(c, references(spark, sf)["cfop"]).select("l_orderkey", "l_linenumber", "CFOP", "_SINAL_CFOP", "_NATUREZA")


SIGN_SQL = """SELECT l_orderkey, l_linenumber, c AS "CFOP", CASE WHEN c IN (1202,2201) THEN -1 ELSE 1 END AS "_SINAL_CFOP", CASE c WHEN 5102 THEN 'Venda' WHEN 1202 THEN 'Devolução de venda' END AS "_NATUREZA"
 FROM (SELECT *, CASE WHEN l_linenumber=7 THEN 2201 WHEN l_linestatus='O' THEN 5102 WHEN l_quantity>10 THEN 1202 END AS c FROM lineitem)"""


def odd_cfops(spark, sf):
    """Codes in use that the table lacks."""
    c = _item_codes(spark, sf).select(F.when(F.col("l_linenumber") == 7, "2201").otherwise(F.col("CFOP")).alias("CFOP"))
    return unexpected_cfops(c, references(spark, sf)["cfop"])


ODD_SQL = """SELECT DISTINCT c AS "CFOP", CAST(NULL AS VARCHAR) AS "_NATUREZA" FROM (SELECT CASE WHEN l_linenumber=7 THEN 2201 WHEN l_linestatus='O' THEN 5102 WHEN l_quantity>10 THEN 1202 END AS c FROM lineitem)
 WHERE c IS NULL OR c NOT IN (5102,1202)"""


def profile(spark, sf):
    """Rows per flag and status, most frequent first."""
    return frequency_profile(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], out="n")


PROFILE_SQL = "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1,2"


def fan_out(spark, sf):
    """Rows against distinct (order, line) keys per flag."""
    return fan_out_audit(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], by=["l_returnflag"])


FAN_SQL = """SELECT l_returnflag, count(*) AS rows, count(DISTINCT (l_orderkey,l_linenumber)) AS keys, count(*)-count(DISTINCT (l_orderkey,l_linenumber)) AS extra_rows FROM lineitem GROUP BY 1"""


def sets(spark, sf):
    """Distinct (status, year) combinations."""
    return distinct_sets(table(spark, sf, "orders").withColumn("y", F.year("o_orderdate")), ["o_orderstatus", "y"])


SETS_SQL = "SELECT DISTINCT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders"


def reconcile(spark, sf):
    """Expected orders that produced no line."""
    expected = table(spark, sf, "orders").select(F.col("o_orderkey").alias("_file_id"), "o_orderstatus")
    return missing_files(expected, table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("_file_id")))


RECON_SQL = "SELECT o_orderkey AS _file_id, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"

QUERIES = {
    "subsidy_exemption": (subsidy_exemption, EXEMPT_SQL), "subsidy_same_names": (subsidy_same_names, EXEMPT_SQL), "subsidy_reduction": (subsidy_reduction, REDUCE_SQL),
    "subsidy_without_documents": (subsidy_without_documents, NODOC_SQL), "eligibility_funnel": (funnel, FUNNEL_SQL),
    "eligibility_scan": (eligibility, ELIG_SQL), "cfop_sign": (cfop_signs, SIGN_SQL), "unexpected_cfops": (odd_cfops, ODD_SQL),
    "frequency_profile": (profile, PROFILE_SQL), "fan_out_audit": (fan_out, FAN_SQL), "distinct_sets": (sets, SETS_SQL),
    "reconcile_files": (reconcile, RECON_SQL),
}

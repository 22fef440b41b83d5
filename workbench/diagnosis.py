"""Annual-return metrics, scores and the whole diagnosis, from order-derived sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalgrove.operators import metrics as m
from fiscalgrove.operators.audit import within_last_years
from fiscalgrove.operators.columns import anchored_nulls
from fiscalgrove.operators.score import opportunity_rows, viability
from fiscalgrove.operators.version import merge_history
from fiscalgrove.plans.diagnostic import diagnose, store, tributary_summary
from fiscalgrove.session import scratch_dir
from fiscalgrove.sources.tables import DIAGNOSTIC_TABLES, read_table
from workbench.derive import annual_sources, stored, table, yearly_orders

K = ["CNPJ", "DT_INI"]


def money(df, *cols, digits=4):
    """Sums of doubles depend on their order in the last bits; compare them rounded."""
    return df.withColumns({c: F.round(c, digits) for c in cols})


# ---- SQL building blocks: the same sources and rules -------------------------
_SRC = """o AS (SELECT lpad(CAST(o_custkey AS VARCHAR),14,'0') AS "CNPJ", '0101' || CAST(year(o_orderdate) AS VARCHAR) AS "DT_INI", year(o_orderdate) AS y,
  o_orderkey, o_orderstatus AS s, o_orderpriority AS p, left(o_orderpriority,1) AS c, o_totalprice AS t,
  CASE WHEN o_orderstatus='P' THEN -o_totalprice ELSE o_totalprice END AS v, o_orderstatus <> 'O' AS a00 FROM orders)"""
_W = 'PARTITION BY "CNPJ" ORDER BY y ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW'
_L = 'PARTITION BY "CNPJ" ORDER BY y'
_KY = '"CNPJ", "DT_INI", y'
_REG = f"""r0 AS (SELECT {_KY}, CASE min(c) WHEN '1' THEN 'RRRR' WHEN '2' THEN 'P' ELSE 'A' END AS "FORMA_TRIB_PER" FROM o GROUP BY ALL),
r AS (SELECT *, CASE "FORMA_TRIB_PER" WHEN 'RRRR' THEN 'Lucro Real' WHEN 'P' THEN 'Lucro Presumido' END AS regime_descricao,
  CASE "FORMA_TRIB_PER" WHEN 'RRRR' THEN 30 WHEN 'P' THEN 10 ELSE 0 END AS regime_score_pts,
  "FORMA_TRIB_PER" <> lag("FORMA_TRIB_PER") OVER ({_L}) AS regime_alternado, "FORMA_TRIB_PER"='P' AS is_lucro_presumido,
  CAST(sum(CASE WHEN "FORMA_TRIB_PER"='P' THEN 1 ELSE 0 END) OVER ({_W}) AS BIGINT) AS anos_consecutivos_lp, "FORMA_TRIB_PER"='RRRR' AS is_lucro_real FROM r0)"""


def _result(name, src, x, sfx, rec):
    """Signed result split and counted; ``x`` is the aggregate, ``src`` the filter."""
    return f"""{name}0 AS (SELECT {_KY}, {x} AS res FROM o {src} GROUP BY ALL),
{name} AS (SELECT {_KY}, res AS resultado_{sfx}, CASE WHEN res>0 THEN res ELSE 0.0 END AS lucro_{sfx}, CASE WHEN res<0 THEN abs(res) ELSE 0.0 END AS prejuizo_{sfx},
  res>0 AS tem_lucro_{sfx}, res<0 AS tem_prejuizo_{sfx}, CAST(sum(CASE WHEN res>0 THEN 1 ELSE 0 END) OVER ({_W}) AS BIGINT) AS recorrencia_lucro_{rec},
  CAST(sum(CASE WHEN res<0 THEN 1 ELSE 0 END) OVER ({_W}) AS BIGINT) AS recorrencia_prejuizo_{rec} FROM {name}0)"""


_ACC = _result("acc", "WHERE c='1' AND a00", "max(v)", "contabil", "anos")
_FIS = _result("fis", "", "round(sum(v),2)", "fiscal", "fiscal_anos")
_PL = f"""pl0 AS (SELECT {_KY}, arg_min(v, o_orderkey) AS x FROM o WHERE c='2' AND a00 GROUP BY ALL),
pl AS (SELECT {_KY}, x AS patrimonio_liquido, x>0 AS pl_positivo, CASE WHEN lag(x) OVER ({_L}) <> 0 THEN (x - lag(x) OVER ({_L})) / abs(lag(x) OVER ({_L})) * 100.0 END AS evo,
  CASE WHEN x>0 THEN x*0.06 ELSE 0.0 END AS jcp FROM pl0)"""
_RET = f"""ret AS (SELECT {_KY}, sum(CASE WHEN s='O' THEN t ELSE 0.0 END) AS ir, sum(CASE WHEN c='5' AND s='O' THEN t ELSE 0.0 END) AS csll FROM o GROUP BY ALL)"""
_PAY = f"""pay AS (SELECT {_KY}, {", ".join(f"sum(CASE WHEN s='F' AND c='{c}' THEN t ELSE 0.0 END) AS {n}" for c, n in
  (("1", "irpj_lr_pago"), ("2", "csll_lr_pago"), ("3", "irpj_lp_pago"), ("4", "csll_lp_pago")))}, sum(CASE WHEN s='F' THEN t ELSE 0.0 END) AS total_darf_pago,
  count(DISTINCT c) AS qtd_codigos_receita FROM o GROUP BY ALL)"""
_L3 = [("pat", "2", 20), ("receita_jcp", "3", 10), ("despesa_jcp", "4", 15)]
_M3 = [("subvencao", "1", 20), ("art30", "2", 20), ("credito_irpj", "3", 20), ("jcp_dedutivel", "4", 20)]


def _opp(name, family, rules, flag):
    cols, total = [], []
    for key, code, pts in rules:
        hit = f"c='{code}'" + (" AND a00" if flag else "")
        cols.append(f"bool_or({hit}) AS opp_{family}_{key}_encontrado, round(sum(CASE WHEN c='{code}' AND a00 THEN v ELSE 0.0 END),2) AS opp_{family}_{key}_valor, "
                    f"max(CASE WHEN {hit} THEN {pts} ELSE 0 END) AS opp_{family}_{key}_score")
        total.append(f"opp_{family}_{key}_score")
    return (f"{name}0 AS (SELECT {_KY}, {', '.join(cols)} FROM o GROUP BY ALL),\n"
            f"{name} AS (SELECT *, {' + '.join(total)} AS score_{family}_total FROM {name}0)")


_OL, _OM = _opp("ol", "l300", _L3, False), _opp("om", "m310", _M3, True)


def regime_profile(spark, sf):
    """Regime label, points, change, running presumed-regime count, five-period rule."""
    return m.regime_profile(annual_sources(spark, sf)["0010"])


REGIME_SQL = f"""WITH {_SRC}, {_REG} SELECT "CNPJ","DT_INI","FORMA_TRIB_PER",anos_consecutivos_lp,regime_descricao,regime_score_pts,regime_alternado,is_lucro_presumido,
 anos_consecutivos_lp>=5 AS regime_no_go_presumido,is_lucro_real FROM r"""


def presumed_streak(spark, sf):
    """Length of the unbroken run of presumed-regime periods."""
    df = annual_sources(spark, sf)["0010"].withColumn("p", F.col("FORMA_TRIB_PER") == "P")
    return m.streak(df, "p", "streak").select(*K, "streak")


STREAK_SQL = f"""WITH {_SRC}, {_REG}, g AS (SELECT *, sum(CASE WHEN "FORMA_TRIB_PER"='P' THEN 0 ELSE 1 END) OVER ({_W}) AS run FROM r0)
SELECT "CNPJ","DT_INI", CAST(sum(CASE WHEN "FORMA_TRIB_PER"='P' THEN 1 ELSE 0 END) OVER (PARTITION BY "CNPJ", run ORDER BY y) AS BIGINT) AS streak FROM g"""


def accounting_result(spark, sf):
    return m.accounting_result(annual_sources(spark, sf)["L300"])


ACC_SQL = f"WITH {_SRC}, {_ACC} SELECT * EXCLUDE (y) FROM acc"


def fiscal_result(spark, sf):
    return money(m.fiscal_result(annual_sources(spark, sf)["N500"]), "resultado_fiscal", "lucro_fiscal", "prejuizo_fiscal", "base_tributavel", digits=2)


FIS_SQL = f"WITH {_SRC}, {_FIS} SELECT * EXCLUDE (y), lucro_fiscal AS base_tributavel FROM fis"


def equity_position(spark, sf):
    return money(m.equity_position(annual_sources(spark, sf)["L100"]), "evolucao_patrimonial_pct", "capacidade_jcp_estimada", digits=6)


EQ_SQL = f"""WITH {_SRC}, {_PL} SELECT "CNPJ","DT_INI",patrimonio_liquido,pl_positivo,round(evo,6) AS evolucao_patrimonial_pct,round(jcp,6) AS capacidade_jcp_estimada FROM pl"""


def withholdings(spark, sf):
    return money(m.withholdings(annual_sources(spark, sf)["Y570"]), "irpj_retido", "csll_retido", "total_retencoes", "potencial_compensacao", digits=2)


RET_SQL = f"""WITH {_SRC}, {_RET} SELECT "CNPJ","DT_INI",round(ir,2) AS irpj_retido,round(csll,2) AS csll_retido,round(ir+csll,2) AS total_retencoes,
 ir+csll<=0 AS divergencia_retencao,round(ir+csll,2) AS potencial_compensacao FROM ret"""

_PAID = ["irpj_lr_pago", "csll_lr_pago", "irpj_lp_pago", "csll_lp_pago", "total_darf_pago"]


def payments_by_regime(spark, sf):
    return money(m.payments_by_regime(annual_sources(spark, sf)["payments"]), *_PAID, digits=2)


PAY_SQL = f"""WITH {_SRC}, {_PAY} SELECT "CNPJ","DT_INI",{",".join(f"round({c},2) AS {c}" for c in _PAID)},qtd_codigos_receita,total_darf_pago<=0 AS ausencia_darf,
 CAST(sum(CASE WHEN total_darf_pago>0 THEN 1 ELSE 0 END) OVER ({_W}) AS BIGINT) AS anos_com_darf FROM pay"""


def l300_opportunities(spark, sf):
    return money(m.l300_opportunities(annual_sources(spark, sf)["L300"]), *[f"opp_l300_{k}_valor" for k, *_ in _L3], digits=2)


def m310_opportunities(spark, sf):
    return money(m.m310_opportunities(annual_sources(spark, sf)["M310"]), *[f"opp_m310_{k}_valor" for k, *_ in _M3], digits=2)


L3_SQL = f"WITH {_SRC}, {_OL} SELECT * EXCLUDE (y) FROM ol"
M3_SQL = f"WITH {_SRC}, {_OM} SELECT * EXCLUDE (y) FROM om"


def anchored_metrics(spark, sf):
    """An absent source: distinct anchor keys with typed NULL metrics."""
    return anchored_nulls(yearly_orders(spark, sf), K, {"irpj_retido": "double", "divergencia_retencao": "boolean", "n": "long"})


ANCHOR_SQL = f"""WITH {_SRC} SELECT DISTINCT "CNPJ","DT_INI",CAST(NULL AS DOUBLE) AS irpj_retido,CAST(NULL AS BOOLEAN) AS divergencia_retencao,CAST(NULL AS BIGINT) AS n FROM o"""


def consolidate_anchor(spark, sf):
    """All metrics on the regime rows with the company name; NULLs filled by role."""
    s = annual_sources(spark, sf)
    out = m.consolidate_all(
        m.regime_profile(s["0010"]), m.consolidate_fiscal(m.accounting_result(s["L300"]), m.fiscal_result(s["N500"]), m.equity_position(s["L100"])),
        m.consolidate_money(m.payments_by_regime(s["payments"]), m.withholdings(s["Y570"])),
        m.consolidate_opportunities(m.l300_opportunities(s["L300"]), m.m310_opportunities(s["M310"])), s["company"])
    return money(out.select(*K, "cnpj_base", "NOME", "resultado_contabil", "resultado_fiscal", "patrimonio_liquido", "pl_positivo", "total_retencoes",
                            "total_darf_pago", "total_opportunity_score"), "resultado_fiscal", "total_retencoes", "total_darf_pago", digits=2)


_ALL = f"""{_SRC}, {_REG}, {_ACC}, {_FIS}, {_PL}, {_RET}, {_PAY}, {_OL}, {_OM},
j AS (SELECT r.*, substr("CNPJ",1,8) AS cnpj_base, c_name AS "NOME", coalesce(resultado_contabil,0.0) AS resultado_contabil, resultado_fiscal, tem_lucro_fiscal, lucro_fiscal, recorrencia_prejuizo_fiscal_anos,
  CASE WHEN acc.res0 IS NULL AND fis.y IS NULL AND pl.y IS NULL THEN NULL ELSE coalesce(patrimonio_liquido,0.0) END AS patrimonio_liquido, coalesce(pl_positivo,false) AS pl_positivo,
  coalesce(ir,0.0) AS ir, coalesce(csll,0.0) AS csll, coalesce(ir+csll,0.0) AS total_retencoes, pay.* EXCLUDE ("CNPJ","DT_INI",y), ol.* EXCLUDE ("CNPJ","DT_INI",y), om.* EXCLUDE ("CNPJ","DT_INI",y)
  FROM r LEFT JOIN (SELECT *, resultado_contabil AS res0 FROM acc) acc USING ({_KY}) LEFT JOIN fis USING ({_KY}) LEFT JOIN pl USING ({_KY}) LEFT JOIN ret USING ({_KY}) LEFT JOIN pay USING ({_KY})
  LEFT JOIN ol USING ({_KY}) LEFT JOIN om USING ({_KY}) LEFT JOIN customer ON lpad(CAST(c_custkey AS VARCHAR),14,'0')="CNPJ"),
s0 AS (SELECT *, anos_consecutivos_lp>=5 AS regime_no_go_presumido, total_darf_pago<=0 AS ausencia_darf,
  (CASE WHEN is_lucro_real THEN 30.0 ELSE 0.0 END)+(CASE WHEN pl_positivo THEN 10.0 ELSE 0.0 END)+(CASE WHEN tem_lucro_fiscal THEN 20.0 ELSE 0.0 END)
  +(CASE WHEN total_retencoes>0 THEN 15.0 ELSE 0.0 END)+(CASE WHEN total_darf_pago<=0 THEN -20.0 ELSE 15.0 END)+score_l300_total+score_m310_total
  +(CASE WHEN recorrencia_prejuizo_fiscal_anos>=2 THEN -25.0 ELSE 0.0 END) AS raw_d FROM j),
s1 AS (SELECT *, CAST(raw_d AS DOUBLE) AS raw_score, CAST(greatest(0.0,least(100.0,raw_d)) AS DOUBLE) AS final_score FROM s0),
s2 AS (SELECT *, CASE WHEN final_score>=80 THEN 'OPORTUNIDADE_ALTISSIMA' WHEN final_score>=60 THEN 'OPORTUNIDADE_FORTE' WHEN final_score>=40 THEN 'OPORTUNIDADE_MODERADA'
  WHEN final_score>=20 THEN 'BAIXA_ATRATIVIDADE' ELSE 'NO_GO' END AS classification,
  CASE WHEN regime_no_go_presumido THEN 'NO_GO' WHEN is_lucro_real AND patrimonio_liquido>0 THEN 'GO' ELSE 'ANALISAR' END AS go_no_go FROM s1),
s AS (SELECT *, CASE WHEN go_no_go='GO' THEN (CASE WHEN final_score>=80 THEN 'ALTISSIMA' WHEN final_score>=60 THEN 'ALTA' WHEN final_score>=40 THEN 'MEDIA' ELSE 'NO_GO' END)
  WHEN go_no_go='ANALISAR' THEN 'BAIXA' ELSE 'NO_GO' END AS commercial_priority FROM s2)"""
CONS_SQL = f"""WITH {_ALL} SELECT "CNPJ","DT_INI",cnpj_base,"NOME",resultado_contabil,resultado_fiscal,patrimonio_liquido,pl_positivo,round(total_retencoes,2) AS total_retencoes,
 round(total_darf_pago,2) AS total_darf_pago, CAST(score_l300_total+score_m310_total AS DOUBLE) AS total_opportunity_score FROM j"""


def _scored(spark, sf):
    return diagnose(annual_sources(spark, sf))


def scorecard_query(spark, sf):
    """Raw and final score, class, decision, priority."""
    return _scored(spark, sf)[0].select(*K, "raw_score", "final_score", "classification", "go_no_go", "commercial_priority", "regime_no_go_presumido")


SCORE_SQL = f"""WITH {_ALL} SELECT "CNPJ","DT_INI",raw_score,final_score,classification,go_no_go,commercial_priority,regime_no_go_presumido FROM s"""


def opportunities(spark, sf):
    """One row per opportunity found, with estimated credit and score impact."""
    return money(_scored(spark, sf)[1], "estimated_credit")


_CODES = {"pat": ("3.01.01.07.01.13", "PAT"), "receita_jcp": ("3.01.01.05.01.04", "Receita JCP"), "despesa_jcp": ("3.01.01.09.01.04", "Despesa JCP"),
          "subvencao": ("106", "subvencao"), "art30": ("106.05", "art30"), "credito_irpj": ("106.10", "credito_irpj"), "jcp_dedutivel": ("166.03", "jcp_dedutivel")}


def _opp_rows():
    out = []
    for family, rules in (("l300", _L3), ("m310", _M3)):
        for key, _, pts in rules:
            code, desc = _CODES[key]
            credit = f"abs(opp_{family}_{key}_valor)"
            if family == "l300":
                credit = f"{credit}*0.15" if key == "pat" else "0.0"
            out.append(f"""SELECT "CNPJ","DT_INI",'{family.upper()}_{key.upper()}' AS opportunity_id,'{desc}' AS description,'{code}' AS reference_code,
 CAST({credit} AS DOUBLE) AS estimated_credit,CAST({pts} AS DOUBLE) AS score_impact FROM s WHERE opp_{family}_{key}_encontrado""")
    return " UNION ALL ".join(out)


_OPPS = f"opps AS ({_opp_rows()})"
OPP_SQL = f"WITH {_ALL}, {_OPPS} SELECT * REPLACE (round(estimated_credit,4) AS estimated_credit) FROM opps"


def viability_query(spark, sf):
    """Estimated recovery (opportunity rows summed per key) and the viability index."""
    scored = stored(_scored(spark, sf)[0], "scored")
    return money(viability(scored.select(*K, "final_score"), opportunity_rows(scored)).select(*K, "estimated_recovery", "commercial_viability_index"), "estimated_recovery", "commercial_viability_index", digits=8)


_VIA = """rec AS (SELECT "CNPJ","DT_INI",sum(estimated_credit) AS er FROM opps GROUP BY ALL),
via AS (SELECT s.*, coalesce(er,0.0) AS er, greatest(0.0,least(100.0,final_score*0.6+least(coalesce(er,0.0)/100000.0*40.0,40.0)*0.4)) AS cvi FROM s LEFT JOIN rec USING ("CNPJ","DT_INI"))"""
VIA_SQL = f"""WITH {_ALL}, {_OPPS}, {_VIA} SELECT "CNPJ","DT_INI",round(CAST(er AS DOUBLE),8) AS estimated_recovery,round(CAST(cvi AS DOUBLE),8) AS commercial_viability_index FROM via"""


_STORED = {"summary": ("cvi", "go_no_go"), "scores": ("raw_score", "classification"), "go_no_go": ("NULL", "commercial_priority"), "financials": ("resultado_fiscal", "NULL"),
           "master": ("score_l300_total+score_m310_total", '"FORMA_TRIB_PER"'), "master_historical": ("final_score", "cnpj_base")}
STORED_SQL = f"WITH {_ALL}, {_OPPS}, {_VIA} " + " UNION ALL ".join(
    f"""SELECT '{n}' AS name,"CNPJ","DT_INI",round(CAST({v} AS DOUBLE),4) AS v,CAST({t} AS VARCHAR) AS t FROM via""" for n, (v, t) in _STORED.items()) + """
 UNION ALL SELECT 'opportunities',"CNPJ","DT_INI",round(estimated_credit,4),opportunity_id FROM opps"""


def tax_ratio_query(spark, sf):
    """Effective tax rate and payments over accounting result (positive denominators only)."""
    return money(_scored(spark, sf)[0].select(*K, "effective_tax_rate", "darf_contabil_ratio"), "effective_tax_rate", "darf_contabil_ratio", digits=6)


RATIO_SQL = f"""WITH {_ALL} SELECT "CNPJ","DT_INI",round(CASE WHEN lucro_fiscal>0 THEN (irpj_lr_pago+csll_lr_pago)/lucro_fiscal END,6) AS effective_tax_rate,
 round(CASE WHEN resultado_contabil>0 THEN total_darf_pago/resultado_contabil END,6) AS darf_contabil_ratio FROM s"""


def diagnosis_absent_sources(spark, sf):
    """Only the regime report is there: NULL metrics, no opportunities, a score all the same."""
    out, _ = diagnose({"0010": annual_sources(spark, sf)["0010"]})
    return out.select(*K, "resultado_contabil", "total_retencoes", "raw_score", "go_no_go", "estimated_recovery")


ABSENT_SQL = f"""WITH {_SRC}, {_REG} SELECT "CNPJ","DT_INI",0.0::DOUBLE AS resultado_contabil,0.0::DOUBLE AS total_retencoes,
 CASE WHEN is_lucro_real THEN 30.0 ELSE 0.0 END::DOUBLE AS raw_score, CASE WHEN anos_consecutivos_lp>=5 THEN 'NO_GO' ELSE 'ANALISAR' END AS go_no_go,0.0::DOUBLE AS estimated_recovery FROM r"""


def summary_projection(spark, sf):
    """The 20 labelled columns (here under plain names), masks and labels applied."""
    s = tributary_summary(_scored(spark, sf)[0], last_years=5, this_year=2001)
    plain = s.toDF(*[f"c{i:02d}" for i in range(len(s.columns))])
    return money(plain, "c06", "c07", "c08", *[f"c{i}" for i in range(13, 20)], digits=2)


SUMMARY_SQL = f"""WITH {_ALL} SELECT "NOME" AS c00, substr("CNPJ",1,2)||'.'||substr("CNPJ",3,3)||'.'||substr("CNPJ",6,3)||'/'||substr("CNPJ",9,4)||'-'||substr("CNPJ",13,2) AS c01,
 CAST(y AS VARCHAR) AS c02, CASE "FORMA_TRIB_PER" WHEN 'RRRR' THEN 'Lucro Real' WHEN 'P' THEN 'Lucro Presumido' ELSE "FORMA_TRIB_PER" END AS c03, patrimonio_liquido AS c04,
 resultado_contabil AS c05, resultado_fiscal AS c06, round(ir,2) AS c07, round(csll,2) AS c08, {", ".join(f"CAST(NULL AS DOUBLE) AS c{i:02d}" for i in range(9, 13))},
 {", ".join(f"opp_{f}_{k}_valor AS c{i}" for i, (f, k) in enumerate([("l300", x[0]) for x in _L3] + [("m310", x[0]) for x in _M3], 13))} FROM s WHERE y >= 1996"""


def diagnosis_stored(spark, sf):
    """The diagnosis of all companies stored in its seven tables, those of the first half once more; what each table holds."""
    base = scratch_dir(spark, "diagnosis")
    sources = annual_sources(spark, sf)
    final, found = (stored(df, "diagnosed") for df in diagnose(sources))
    early = lambda df: df.filter(F.substring("DT_INI", 5, 4).cast("int") < 1997)
    store(spark, base, final, found)
    store(spark, base, early(final), early(found))
    shown = {"summary": ("commercial_viability_index", "go_no_go"), "scores": ("raw_score", "classification"), "go_no_go": (None, "commercial_priority"), "financials": ("resultado_fiscal", None),
             "opportunities": ("estimated_credit", "opportunity_id"), "master": ("total_opportunity_score", "FORMA_TRIB_PER"), "master_historical": ("final_score", "cnpj_base")}
    parts = [read_table(spark, f"{base}/{DIAGNOSTIC_TABLES[name]}").select(
        F.lit(name).alias("name"), "CNPJ", "DT_INI", (F.col(v).cast("double") if v else F.lit(None).cast("double")).alias("v"), (F.col(t) if t else F.lit(None).cast("string")).alias("t"))
        for name, (v, t) in shown.items()]
    return money(reduce(DataFrame.unionByName, parts), "v", digits=4)




def history_merge(spark, sf):
    """Current rows plus the history they do not replace, six calendar years per company."""
    o = yearly_orders(spark, sf)
    grain = lambda d, tag: d.groupBy(*K).agg(F.count(F.lit(1)).alias("n")).withColumn("src", F.lit(tag))
    return merge_history(grain(o.filter("o_orderstatus = 'F'"), "now"), grain(o.filter("o_orderstatus <> 'F'"), "old"))


HIST_SQL = f"""WITH {_SRC}, f AS (SELECT "CNPJ","DT_INI",count(*) AS n FROM o WHERE s='F' GROUP BY ALL),
h AS (SELECT "CNPJ","DT_INI",substr("CNPJ",1,8) AS b,y,count(*) AS n FROM o WHERE s<>'F' GROUP BY ALL), h2 AS (SELECT *, max(y) OVER (PARTITION BY b) AS top FROM h)
SELECT "CNPJ","DT_INI",n,'now' AS src,substr("CNPJ",1,8) AS cnpj_base FROM f UNION ALL
SELECT "CNPJ","DT_INI",n,'old',b FROM h2 WHERE y>=top-5 AND NOT EXISTS (SELECT 1 FROM f WHERE f."CNPJ"=h2."CNPJ" AND f."DT_INI"=h2."DT_INI")"""


def last_years(spark, sf):
    """Orders of the last two years, counted from the data's own latest year."""
    o = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))
    return within_last_years(o, "y", 1)


LAST_SQL = "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders WHERE year(o_orderdate) >= (SELECT max(year(o_orderdate)) - 1 FROM orders)"

QUERIES = {
    "regime_profile": (regime_profile, REGIME_SQL), "presumed_streak": (presumed_streak, STREAK_SQL),
    "accounting_result": (accounting_result, ACC_SQL), "fiscal_result": (fiscal_result, FIS_SQL),
    "equity_position": (equity_position, EQ_SQL), "withholdings": (withholdings, RET_SQL),
    "payments_by_regime": (payments_by_regime, PAY_SQL), "l300_opportunities": (l300_opportunities, L3_SQL),
    "m310_opportunities": (m310_opportunities, M3_SQL), "anchored_nulls": (anchored_metrics, ANCHOR_SQL),
    "consolidate_anchor": (consolidate_anchor, CONS_SQL), "scorecard": (scorecard_query, SCORE_SQL),
    "opportunity_rows": (opportunities, OPP_SQL), "viability": (viability_query, VIA_SQL), "tax_ratios": (tax_ratio_query, RATIO_SQL),
    "diagnosis_absent_sources": (diagnosis_absent_sources, ABSENT_SQL), "tributary_summary": (summary_projection, SUMMARY_SQL),
    "diagnosis_stored": (diagnosis_stored, STORED_SQL),
    "history_merge": (history_merge, HIST_SQL), "last_years": (last_years, LAST_SQL),
}

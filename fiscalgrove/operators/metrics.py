"""Per (company, period) metrics of the annual return.

Every metric is an aggregate per ``(CNPJ, DT_INI)`` first; windows then run over a company's
periods, which are as many as there are distinct start dates, ordered by the parsed date
(as text, ``01072020`` would sort after ``01012021``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fiscalgrove.catalog import ContractError
from fiscalgrove.functions.scalars import br_date, br_decimal, label, ratio_if_positive
from fiscalgrove.operators.columns import anchored_nulls, fill_roles, first_available, with_cnpj_base
from fiscalgrove.operators.lookup import outer_consolidate, safe_join
from fiscalgrove.operators.version import latest_version

KEYS = ["CNPJ", "DT_INI"]

# --- fixed values -----------------------------------------------------------
YEAR_END = "A00"
ACCOUNTING_RESULT = "3.01"
NET_EQUITY = "2.03"
JCP_RATE = 0.06
REGIME_RULES = {
    "real": {"code": "RRRR", "description": "Lucro Real", "points": 30},
    "presumed": {"code": "P", "description": "Lucro Presumido", "points": 10},
    "no_go_presumed_years": 5,
}
FISCAL_RESULT_COLUMNS = ("VL_REC_LIQ_LTIR", "VALOR", "VL_CTA")
L300_RULES = {
    "pat": {"code": "3.01.01.07.01.13", "description": "PAT", "credit": 0.15, "score": 20},
    "receita_jcp": {"code": "3.01.01.05.01.04", "description": "Receita JCP", "credit": 0.0, "score": 10},
    "despesa_jcp": {"code": "3.01.01.09.01.04", "description": "Despesa JCP", "credit": 0.0, "score": 15},
}
M310_RULES = {
    "subvencao": {"code": "106", "score": 20},
    "art30": {"code": "106.05", "score": 20},
    "credito_irpj": {"code": "106.10", "score": 20},
    "jcp_dedutivel": {"code": "166.03", "score": 20},
}
PAYMENT_CODES = {
    "irpj_lr": ("5993", "3373", "0220", "2456"),
    "csll_lr": ("2484", "6012"),
    "irpj_lp": ("2089",),
    "csll_lp": ("2372",),
}
# ----------------------------------------------------------------------------


def period_order(dt: str = "DT_INI") -> list[Column]:
    return [br_date(dt), F.col(dt)]


def by_company(order: Sequence[Column] | None = None):
    return Window.partitionBy("CNPJ").orderBy(*(order or period_order()))


def running(condition: Column) -> Column:
    """Periods so far, this one included, for which the condition holds."""
    w = by_company().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(condition.cast("int").cast("long")).over(w)


def streak(df: DataFrame, flag: str, out: str) -> DataFrame:
    """Length of the unbroken run of flagged periods that ends at each period."""
    w = by_company().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    breaks = F.sum((~F.coalesce(F.col(flag), F.lit(False))).cast("long")).over(w)
    inside = Window.partitionBy("CNPJ", "_run").orderBy(*period_order()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("_run", breaks).withColumn(
        out, F.sum(F.coalesce(F.col(flag), F.lit(False)).cast("long")).over(inside)).drop("_run")


def previous(value: str) -> Column:
    return F.lag(value, 1).over(by_company())


def pct_change(value: str) -> Column:
    prev = previous(value)
    return F.when(prev.isNotNull() & (prev != 0),
                  F.try_divide(F.col(value) - prev, F.abs(prev)) * F.lit(100.0))


def absent(anchor: DataFrame | None, metrics: Mapping[str, str], what: str) -> DataFrame:
    if anchor is None:
        raise ContractError(f"{what}: source absent and no anchor frame to take the keys from")
    return anchored_nulls(anchor, KEYS, metrics)


# ---------------------------------------------------------------- tax regime
def regime_profile(df: DataFrame, rules: Mapping = REGIME_RULES) -> DataFrame:
    """Regime label and points, change against the previous period, presumed-regime count.

    The windows run over periods, not over declaration rows, and are joined back, so any
    number of rows may share a period.
    """
    presumed = rules["presumed"]
    code = F.col("FORMA_TRIB_PER")
    periods = df.groupBy(*KEYS).agg(
        F.max("FORMA_TRIB_PER").alias("_code"),
        F.sum((code == presumed["code"]).cast("long")).alias("_n"))
    w = by_company().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    windows = periods.select(
        *KEYS, F.lag("_code", 1).over(by_company()).alias("_before"),
        F.sum("_n").over(w).alias("anos_consecutivos_lp"))
    return with_regime_labels(df.join(windows, KEYS, "left"), rules)


def with_regime_labels(df: DataFrame, rules: Mapping = REGIME_RULES) -> DataFrame:
    """Label, points and flags from ``FORMA_TRIB_PER``, ``anos_consecutivos_lp`` and the regime of the period before (``_before``, which goes)."""
    real, presumed = rules["real"], rules["presumed"]
    code = F.col("FORMA_TRIB_PER")
    return df.withColumns({
        "regime_descricao": label(code, {r["code"]: r["description"] for r in (real, presumed)}),
        "regime_score_pts": F.when(code == real["code"], real["points"])
        .when(code == presumed["code"], presumed["points"]).otherwise(0),
        "regime_alternado": code != F.col("_before"),
        "is_lucro_presumido": code == presumed["code"],
        "regime_no_go_presumido": F.col("anos_consecutivos_lp") >= rules["no_go_presumed_years"],
        "is_lucro_real": code == real["code"],
    }).drop("_before")


# ---------------------------------------------------- accounting, fiscal, equity
_ACCOUNTING = {"resultado_contabil": "double", "lucro_contabil": "double", "prejuizo_contabil": "double",
               "tem_lucro_contabil": "boolean", "tem_prejuizo_contabil": "boolean",
               "recorrencia_lucro_anos": "long", "recorrencia_prejuizo_anos": "long"}
_FISCAL = {"resultado_fiscal": "double", "lucro_fiscal": "double", "prejuizo_fiscal": "double",
           "tem_lucro_fiscal": "boolean", "tem_prejuizo_fiscal": "boolean", "base_tributavel": "double",
           "recorrencia_lucro_fiscal_anos": "long", "recorrencia_prejuizo_fiscal_anos": "long"}
_EQUITY = {"patrimonio_liquido": "double", "pl_positivo": "boolean",
           "evolucao_patrimonial_pct": "double", "capacidade_jcp_estimada": "double"}
_WITHHOLDING = {"irpj_retido": "double", "csll_retido": "double", "total_retencoes": "double",
                "divergencia_retencao": "boolean", "potencial_compensacao": "double"}


def split_result(result: str, suffix: str) -> dict[str, Column]:
    """Profit and loss parts and flags of a signed result."""
    r = F.col(result)
    return {
        f"lucro_{suffix}": F.when(r > 0, r).otherwise(F.lit(0.0)),
        f"prejuizo_{suffix}": F.when(r < 0, F.abs(r)).otherwise(F.lit(0.0)),
        f"tem_lucro_{suffix}": r > 0,
        f"tem_prejuizo_{suffix}": r < 0,
    }


def accounting_result(df: DataFrame | None, anchor: DataFrame | None = None) -> DataFrame:
    """Year-end value of the result account, split, with running counts."""
    if df is None:
        return absent(anchor, _ACCOUNTING, "accounting result")
    value = br_decimal("VALOR") if "VALOR" in df.columns else F.lit(None).cast("double")
    picked = df.filter((F.col("CODIGO") == ACCOUNTING_RESULT) & (F.col("PER_APUR") == YEAR_END))
    out = picked.groupBy(*KEYS).agg(F.max(value).alias("resultado_contabil"))
    return out.withColumns(split_result("resultado_contabil", "contabil")).withColumns({
        "recorrencia_lucro_anos": running(F.col("tem_lucro_contabil")),
        "recorrencia_prejuizo_anos": running(F.col("tem_prejuizo_contabil"))})


def fiscal_result(df: DataFrame | None, anchor: DataFrame | None = None) -> DataFrame:
    """Sum of the first value column present, split, tax base, running counts."""
    if df is None:
        return absent(anchor, _FISCAL, "fiscal result")
    value = first_available(df, FISCAL_RESULT_COLUMNS, F.lit("0"))
    out = df.groupBy(*KEYS).agg(F.sum(br_decimal(value)).alias("resultado_fiscal"))
    return out.withColumns({
        **split_result("resultado_fiscal", "fiscal"),
        "base_tributavel": F.when(F.col("resultado_fiscal") > 0, F.col("resultado_fiscal")).otherwise(0.0),
    }).withColumns({
        "recorrencia_lucro_fiscal_anos": running(F.col("tem_lucro_fiscal")),
        "recorrencia_prejuizo_fiscal_anos": running(F.col("tem_prejuizo_fiscal"))})


def equity_position(df: DataFrame | None, anchor: DataFrame | None = None) -> DataFrame:
    """Net equity (first line of the account in line order), change and interest capacity."""
    if df is None:
        return absent(anchor, _EQUITY, "equity position")
    value = br_decimal("VAL_CTA_REF_INI") if "VAL_CTA_REF_INI" in df.columns else F.lit(0.0)
    order = [c for c in ("FILE_ID", "_file_id", "_row_id") if c in df.columns]
    first = F.min(F.struct(*order, value.alias("_v")))["_v"]
    picked = df.filter((F.col("CODIGO") == NET_EQUITY) & (F.col("PER_APUR") == YEAR_END))
    out = picked.groupBy(*KEYS).agg(first.alias("patrimonio_liquido"))
    pl = F.col("patrimonio_liquido")
    return out.withColumns({
        "pl_positivo": pl > 0,
        "evolucao_patrimonial_pct": pct_change("patrimonio_liquido"),
        "capacidade_jcp_estimada": F.when(pl > 0, pl * JCP_RATE).otherwise(0.0)})


def withholdings(df: DataFrame | None, anchor: DataFrame | None = None) -> DataFrame:
    """Withheld tax totals; a total of zero or less counts as a divergence."""
    if df is None:
        return absent(anchor, _WITHHOLDING, "withholdings")
    latest = latest_version(df)
    zero = F.lit(0.0)
    ir, csll = F.coalesce(br_decimal("IR_RET"), zero), F.coalesce(br_decimal("CSLL_RET"), zero)
    return latest.groupBy(*KEYS).agg(
        F.sum(ir).alias("irpj_retido"), F.sum(csll).alias("csll_retido"),
        F.sum(ir + csll).alias("total_retencoes"),
    ).withColumns({"divergencia_retencao": F.col("total_retencoes") <= 0,
                   "potencial_compensacao": F.col("total_retencoes")})


def payments_by_regime(df: DataFrame | None, codes: Mapping[str, Sequence[str]] = PAYMENT_CODES,
                       code: str = "codigo_receita", value: str = "valor_principal") -> DataFrame | None:
    """Tax paid per tax and regime, total, number of codes, running count of paying periods."""
    if df is None:
        return None
    v = F.col(value).cast("double")
    sums = [F.sum(F.when(F.col(code).isin(*c), v).otherwise(0.0)).alias(f"{n}_pago") for n, c in codes.items()]
    out = df.groupBy(*KEYS).agg(*sums, F.sum(v).alias("total_darf_pago"),
                                F.count_distinct(code).alias("qtd_codigos_receita"))
    return out.withColumns({"ausencia_darf": F.col("total_darf_pago") <= 0,
                            "anos_com_darf": running(F.col("total_darf_pago") > 0)})


# ---------------------------------------------------------------- opportunities
def _pivot(df: DataFrame, family: str, rules: Mapping[str, Mapping], value: Column, flag_needs_year_end: bool) -> DataFrame:
    aggs: list[Column] = []
    for key, rule in rules.items():
        code_hit = F.col("CODIGO") == rule["code"]
        year_end = code_hit & (F.col("PER_APUR") == YEAR_END)
        hit = F.coalesce(year_end if flag_needs_year_end else code_hit, F.lit(False))
        aggs += [F.max(hit).alias(f"opp_{family}_{key}_encontrado"),
                 F.sum(F.when(year_end, value).otherwise(0.0)).alias(f"opp_{family}_{key}_valor"),
                 F.max(F.when(hit, rule["score"]).otherwise(0)).alias(f"opp_{family}_{key}_score")]
    total = reduce(lambda a, b: a + b, [
        F.when(F.col(f"opp_{family}_{k}_encontrado"), F.col(f"opp_{family}_{k}_score")).otherwise(0) for k in rules])
    return df.groupBy(*KEYS).agg(*aggs).withColumn(f"score_{family}_total", total)


def _opportunity_nulls(family: str, rules: Mapping[str, Mapping]) -> dict[str, str]:
    out: dict[str, str] = {}
    for key in rules:
        out.update({f"opp_{family}_{key}_encontrado": "boolean", f"opp_{family}_{key}_valor": "double",
                    f"opp_{family}_{key}_score": "int"})
    return {**out, f"score_{family}_total": "double"}


def l300_opportunities(df: DataFrame | None, anchor: DataFrame | None = None,
                       rules: Mapping[str, Mapping] = L300_RULES) -> DataFrame:
    """Income-statement rules: found (any period), year-end value, score."""
    if df is None:
        return absent(anchor, _opportunity_nulls("l300", rules), "L300 opportunities")
    return _pivot(latest_version(df), "l300", rules, br_decimal("VALOR"), flag_needs_year_end=False)


def m310_opportunities(df: DataFrame | None, anchor: DataFrame | None = None,
                       rules: Mapping[str, Mapping] = M310_RULES) -> DataFrame:
    """Tax-ledger rules: found and value both at year end, score."""
    if df is None:
        return absent(anchor, _opportunity_nulls("m310", rules), "M310 opportunities")
    return _pivot(latest_version(df), "m310", rules, br_decimal("VL_CTA"), flag_needs_year_end=True)


# ---------------------------------------------------------------- consolidation
_FISCAL_NUMBERS = ("resultado_contabil", "lucro_contabil", "prejuizo_contabil", "resultado_fiscal",
                   "lucro_fiscal", "prejuizo_fiscal", "base_tributavel", "patrimonio_liquido",
                   "capacidade_jcp_estimada", "evolucao_patrimonial_pct",
                   "recorrencia_lucro_anos", "recorrencia_prejuizo_anos",
                   "recorrencia_lucro_fiscal_anos", "recorrencia_prejuizo_fiscal_anos")
_FISCAL_FLAGS = ("tem_lucro_contabil", "tem_prejuizo_contabil", "tem_lucro_fiscal",
                 "tem_prejuizo_fiscal", "pl_positivo")
_MONEY_NUMBERS = ("irpj_lr_pago", "csll_lr_pago", "irpj_lp_pago", "csll_lp_pago", "total_darf_pago",
                  "irpj_retido", "csll_retido", "total_retencoes", "potencial_compensacao")
_MONEY_FLAGS = ("ausencia_darf", "divergencia_retencao")


def consolidate_fiscal(accounting: DataFrame, fiscal: DataFrame, equity: DataFrame) -> DataFrame:
    return fill_roles(outer_consolidate([accounting, fiscal, equity], KEYS), _FISCAL_NUMBERS, _FISCAL_FLAGS)


def consolidate_money(payments: DataFrame | None = None, withheld: DataFrame | None = None) -> DataFrame | None:
    joined = outer_consolidate([payments, withheld], KEYS)
    return None if joined is None else fill_roles(joined, _MONEY_NUMBERS, _MONEY_FLAGS)


def consolidate_opportunities(l300: DataFrame, m310: DataFrame) -> DataFrame:
    joined = fill_roles(outer_consolidate([l300, m310], KEYS), numeric_suffixes=("_score", "_valor"),
                        flag_suffixes=("_encontrado",))
    zero = F.lit(0.0)
    return joined.withColumn("total_opportunity_score",
                             F.coalesce(F.col("score_l300_total").cast("double"), zero)
                             + F.coalesce(F.col("score_m310_total").cast("double"), zero))


def consolidate_all(regime: DataFrame, fiscal: DataFrame | None, money: DataFrame | None,
                    opportunities: DataFrame | None, company: DataFrame | None) -> DataFrame:
    """Everything onto the regime rows, plus the company's name and end date."""
    missing = [k for k in KEYS if k not in regime.columns]
    if missing:
        raise ContractError(f"regime frame: missing columns {missing}")
    out = regime
    for frame in (fiscal, money, opportunities):
        out = safe_join(out, frame, KEYS)
    if company is not None:
        name = next((c for c in ("NOME", "razao_social") if c in company.columns), None)
        if name:
            aggs = [F.min(name).alias("NOME")]
            if "DT_FIN" in company.columns:
                aggs.append(F.min("DT_FIN").alias("DT_FIN"))
            out = safe_join(out, company.groupBy(*KEYS).agg(*aggs), KEYS)
    return with_cnpj_base(out).dropna(subset=KEYS)


def tax_ratios(df: DataFrame) -> DataFrame:
    """Effective tax rate and payments over accounting result, where their inputs exist."""
    have = set(df.columns)
    out = {}
    if {"irpj_lr_pago", "csll_lr_pago", "lucro_fiscal"} <= have:
        out["effective_tax_rate"] = ratio_if_positive(
            F.col("irpj_lr_pago") + F.col("csll_lr_pago"), F.col("lucro_fiscal"))
    if {"total_darf_pago", "resultado_contabil"} <= have:
        out["darf_contabil_ratio"] = ratio_if_positive(F.col("total_darf_pago"), F.col("resultado_contabil"))
    return df.withColumns(out) if out else df

"""ICMS subsidy: exemption and base-reduction valuation over document totals (C190).

The document side (C100 with its establishment and participant) is put together once, one
row per document, and the eligible totals join it once. Every right side has one row per
key, so no total is multiplied and nothing has to be deduplicated after the joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalgrove.functions.scalars import br_date, br_decimal, cfop_sign, label, pair_side, uf_pair
from fiscalgrove.operators.columns import file_column, require_columns, typed_null
from fiscalgrove.operators.lookup import code_lookup, one_per_key, own_shuffle, spread_null

# --- fixed values -----------------------------------------------------------
CST_EXEMPTION = [
    "040", "140", "240", "340", "440", "540", "640", "740", "840",
]
CST_REDUCTION = [
    "020", "120", "220", "320", "420", "520", "620", "720", "820", "070", "270", "370", "470", "570", "670",
    "770", "870",
]
CST_CONDITIONAL = [
    "051", "151", "251", "351", "451", "551", "651", "751", "851",
]
CFOP_ELIGIBLE = [
    1201, 1202, 1203, 1204, 2201, 2202, 2203, 2204, 3201, 3202, 3211, 5101, 5102, 5103, 5104, 5105, 5106,
    5107, 5108, 5109, 5110, 5111, 5112, 5113, 5114, 5115, 5116, 5117, 5118, 5119, 5120, 5121, 5122, 5123,
    6101, 6102, 6103, 6104, 6105, 6106, 6107, 6108, 6109, 6110, 6111, 6112, 6113, 6114, 6115, 6116, 6117,
    6118, 6119, 6120, 6121, 6122, 6123, 7101, 7102, 7105, 7106, 7127,
]
CONSUMER_MODEL = 65
SALE, SALE_RETURN = "Venda", "Devolução de venda"
OPERATION_KIND = {"0": "0 - Entrada", "1": "1 - Saida"}
ISSUER = {"0": "0 - Emissão própria", "1": "1 - Terceiros"}
PAYMENT = {"0": "0 - À vista", "1": "1 - A prazo", "2": "2 - Outros"}
FREIGHT = {
    "0": "0 - Contratação do frete por conta do remetente(CIF)",
    "1": "1 - Contratação do frete por conta do destinatário(FOB)",
    "2": "2 - Contratação do frete por conta de terceiros",
    "3": "3 - Transporte próprio por conta do remetente",
    "4": "4 - Transporte próprio por conta do destinatário",
    "9": "9 - Sem ocorrência de transporte",
}
DOCUMENT_FIELDS = [
    "COD_MOD", "COD_SIT", "SER", "NUM_DOC", "CHV_NFE", "DT_DOC", "DT_E_S", "VL_DOC", "IND_PGTO", "VL_DESC",
    "VL_ABAT_NT", "VL_MERC", "IND_FRT", "VL_FRT", "VL_SEG", "VL_OUT_DA", "VL_BC_ICMS", "VL_ICMS",
    "VL_BC_ICMS_ST", "VL_ICMS_ST", "VL_IPI", "VL_PIS", "VL_COFINS", "VL_PIS_ST", "VL_COFINS_ST", "IND_OPER",
    "IND_EMIT", "COD_PART",
]
PARTICIPANT_FIELDS = [
    "NOME_PARTICIPANTE", "CNPJ_PARTICIPANTE", "CPF_PARTICIPANTE", "IE_PARTICIPANTE", "COD_MUN_PARTICIPANTE",
]
REQUIRED_TOTALS = ("CST_ICMS", "CFOP", "VL_OPR", "VL_RED_BC", "ALIQ_ICMS")
# ----------------------------------------------------------------------------

CST_ALL = [*CST_EXEMPTION, *CST_REDUCTION, *CST_CONDITIONAL]
_ENRICHED = ["UF_ESTABELECIMENTO", "UF_ORIGEM_DESTINO", *PARTICIPANT_FIELDS]


def cst_hit(cst: str = "CST_ICMS", csts: Sequence[str] = CST_ALL) -> Column:
    return F.col(cst).isin(*csts)


def cfop_hit(cfop: str = "CFOP", cfops: Sequence[int] = CFOP_ELIGIBLE) -> Column:
    return F.col(cfop).try_cast("int").isin(*cfops)


def eligible_totals(c190: DataFrame, csts: Sequence[str] = CST_ALL,
                    cfops: Sequence[int] = CFOP_ELIGIBLE) -> DataFrame:
    return c190.filter(cst_hit(csts=csts) & cfop_hit(cfops=cfops))


def eligibility_funnel(c190: DataFrame, by: Sequence[str] = (), csts: Sequence[str] = CST_ALL,
                       cfops: Sequence[int] = CFOP_ELIGIBLE) -> DataFrame:
    """Rows in all, after the CST list, after the CFOP list too; one aggregate."""
    first = F.coalesce(cst_hit(csts=csts), F.lit(False))
    both = first & F.coalesce(cfop_hit(cfops=cfops), F.lit(False))
    counts = [F.count(F.lit(1)).alias("total"), F.count_if(first).alias("after_cst"),
              F.count_if(both).alias("after_cfop")]
    return c190.groupBy(*by).agg(*counts) if by else c190.agg(*counts)


def eligible_periods(c190: DataFrame, by: Sequence[str], csts: Sequence[str] = CST_ALL,
                     cfops: Sequence[int] = CFOP_ELIGIBLE) -> DataFrame:
    """0/1 per group: has it any eligible total? One scan for all groups."""
    hit = F.coalesce(cst_hit(csts=csts) & cfop_hit(cfops=cfops), F.lit(False))
    return c190.groupBy(*by).agg(F.max(hit.cast("int")).alias("has_candidates"))


def with_cfop_sign(df: DataFrame, cfop_table: DataFrame | None) -> DataFrame:
    """Sign from the code's nature (sale +1, sale return -1), else from its first digit."""
    code = F.col("CFOP").try_cast("int")
    by_digit = cfop_sign(code)
    if cfop_table is None:
        return df.withColumns({"_SINAL_CFOP": by_digit, "_DESCRICAO": typed_null(), "_NATUREZA": typed_null(),
                               "CFOP": code})
    table = cfop_table.select(F.col("cfop").alias("_cfop"), F.col("descricao").alias("_DESCRICAO"),
                              F.col("natureza").alias("_NATUREZA"))
    out = code_lookup(df.withColumn("_key", code), table, code="_key", source_code="_cfop",
                      fields=["_DESCRICAO", "_NATUREZA"])
    by_nature = F.when(F.col("_NATUREZA") == SALE, 1).when(F.col("_NATUREZA") == SALE_RETURN, -1)
    return out.drop("_key").withColumns({"_SINAL_CFOP": F.coalesce(by_nature, by_digit), "CFOP": code})


def unexpected_cfops(df: DataFrame, cfop_table: DataFrame) -> DataFrame:
    """Codes in use that the table lacks or gives another nature (their sign is a fallback)."""
    used = with_cfop_sign(df.select("CFOP").distinct(), cfop_table)
    odd = F.col("_NATUREZA").isNull() | ~F.col("_NATUREZA").isin(SALE, SALE_RETURN)
    return used.filter(odd).select("CFOP", "_NATUREZA")


def describe_documents(c100: DataFrame, header: DataFrame | None, participants: DataFrame | None,
                       municipalities: DataFrame | None) -> DataFrame:
    """One row per document: its fields (suffix ``_C100``), participant, both states. Lines meet by the file they are in."""
    file = file_column(c100)
    docs = c100.select(
        F.col(file).alias("_doc_file"), F.col("_row_id").alias("_doc_id"),
        *[(F.col(c) if c in c100.columns else typed_null()).alias(f"{c}_C100") for c in DOCUMENT_FIELDS])
    if header is not None:
        own = header.filter(F.col("UF").isNotNull()).groupBy(F.col(file).alias("_own_file")) \
            .agg(F.min("UF").alias("UF_ESTABELECIMENTO"))
        docs = docs.join(own_shuffle(own, ["_own_file"]), F.col("_doc_file") == F.col("_own_file"), "left").drop("_own_file")
    else:
        docs = docs.withColumn("UF_ESTABELECIMENTO", typed_null())
    if participants is None:
        docs = docs.withColumns({c: typed_null() for c in [*PARTICIPANT_FIELDS, "UF_PARTICIPANTE"]})
    else:
        order = [c for c in ("_row_id",) if c in participants.columns]
        known = one_per_key(
            participants.filter(F.col("COD_PARTICIPANTE").isNotNull()).select(
                F.col(file).alias("_p_file"), F.col("COD_PARTICIPANTE").alias("_p_code"), *order,
                *PARTICIPANT_FIELDS), ["_p_file", "_p_code"], prefer=order).drop(*order)
        if municipalities is not None:
            states = one_per_key(municipalities.select(
                F.col("cod_mun").cast("string").alias("_m_code"), F.col("uf").alias("UF_PARTICIPANTE"),
            ).filter(F.col("_m_code").isNotNull()), ["_m_code"])
            known = known.join(own_shuffle(states, ["_m_code"]), F.col("COD_MUN_PARTICIPANTE") == F.col("_m_code"), "left").drop("_m_code")
        else:
            known = known.withColumn("UF_PARTICIPANTE", typed_null())
        hit = (F.col("_doc_file") == F.col("_p_file")) & (F.col("COD_PART_C100") == F.col("_p_code"))
        docs = docs.join(own_shuffle(known, ["_p_file", "_p_code"]), hit, "left").drop("_p_file", "_p_code")
    pair = uf_pair("IND_OPER_C100", "UF_ESTABELECIMENTO", "UF_PARTICIPANTE")
    return docs.withColumn("UF_ORIGEM_DESTINO", pair)


def own_state_fallback(df: DataFrame) -> DataFrame:
    """Consumer invoices and documents without a state pair use the own-state pair."""
    own = F.concat(F.col("UF_ESTABELECIMENTO"), F.lit("/"), F.col("UF_ESTABELECIMENTO"))
    needs = (F.col("COD_MOD_C100").try_cast("int") == CONSUMER_MODEL) | F.col("UF_ORIGEM_DESTINO").isNull()
    return df.withColumn("UF_ORIGEM_DESTINO", F.when(needs, own).otherwise(F.col("UF_ORIGEM_DESTINO")))


def with_table_rate(df: DataFrame, rates: DataFrame | None) -> DataFrame:
    """Rate of the state pair as ``ALIQUOTA_TABELA``."""
    if rates is None:
        return df.withColumn("ALIQUOTA_TABELA", typed_null("double"))
    table = rates.select(
        F.concat(F.col("Origem").cast("string"), F.lit("/"), F.col("Destino").cast("string")).alias("_pair"),
        F.col("Aliquota").cast("double").alias("_rate"),
    ).filter(F.col("_pair").isNotNull()).groupBy("_pair").agg(F.min("_rate").alias("ALIQUOTA_TABELA"))
    key = spread_null(F.col("UF_ORIGEM_DESTINO"), df.columns)
    return df.join(own_shuffle(table, ["_pair"]), key == F.col("_pair"), "left").drop("_pair")


def value_operations(registers: Mapping[str, DataFrame | None], references: Mapping[str, DataFrame | None], *,
                     dedupe: bool = True, keep: Sequence[str] = ()) -> dict[str, DataFrame | None]:
    """``{"exemption": …, "reduction": …}`` in the 61-column report layout.

    ``registers`` holds C190 and, optionally, C100, 0000 and 0150; ``references`` holds cfop,
    municipios and aliquotas. Without C100, 0000 or 0150 there is no exemption (its rate
    depends on the states) while the reduction goes on with empty columns. Columns of C190 named in ``keep`` follow the layout.
    """
    totals = registers.get("C190")
    if totals is None:
        return {"exemption": None, "reduction": None}
    require_columns(totals, REQUIRED_TOTALS, "C190")
    picked = eligible_totals(totals)
    clash = [c for c in [*_ENRICHED, "UF_PARTICIPANTE", "ALIQUOTA_TABELA"] if c in picked.columns]
    picked = picked.drop(*clash)
    file = file_column(totals)
    if dedupe and file and "_row_id" in picked.columns:
        picked = one_per_key(picked, [file, "_row_id"])
    signed = with_cfop_sign(picked, references.get("cfop")).withColumns(
        {c: br_decimal(c) for c in ("VL_OPR", "VL_RED_BC", "ALIQ_ICMS")})

    c100, head, people = (registers.get(r) for r in ("C100", "0000", "0150"))
    complete = None not in (c100, head, people)
    if c100 is None:
        full = signed.withColumns({f"{c}_C100": typed_null() for c in DOCUMENT_FIELDS}) \
            .withColumns({c: typed_null() for c in [*_ENRICHED, "UF_PARTICIPANTE"]})
    else:
        docs = describe_documents(c100, head, people, references.get("municipios"))
        hit = (F.col(file) == F.col("_doc_file")) & (F.col("_parent_uid_final") == F.col("_doc_id"))
        full = signed.join(docs, hit, "left").drop("_doc_file", "_doc_id")
    if complete:
        full = with_table_rate(own_state_fallback(full), references.get("aliquotas"))
    else:
        full = full.withColumns({"UF_ORIGEM_DESTINO": typed_null(), "ALIQUOTA_TABELA": typed_null("double")})

    conditional = F.col("CST_ICMS").isin(*CST_CONDITIONAL)
    reduces = F.coalesce(F.col("VL_RED_BC") != 0.0, F.lit(False))
    exempt = full.filter(F.col("CST_ICMS").isin(*CST_EXEMPTION) | (conditional & ~reduces))
    reduced = full.filter(F.col("CST_ICMS").isin(*CST_REDUCTION) | (conditional & reduces))
    sign = F.col("_SINAL_CFOP")
    exemption = operations_report(
        exempt, F.col("VL_OPR") * (F.col("ALIQUOTA_TABELA") / F.lit(100.0)) * sign, "CALCULO_DA_ISENCAO", keep)
    reduction = operations_report(
        reduced, F.col("VL_RED_BC") * (F.col("ALIQ_ICMS") / F.lit(100.0)) * sign, "CALCULO_DA_REDUCAO", keep)
    return {"exemption": exemption if complete else None, "reduction": reduction}


def operations_report(df: DataFrame, value: Column, value_name: str, keep: Sequence[str] = ()) -> DataFrame:
    """The business layout of 61 columns."""
    have = set(df.columns)

    def col(name: str) -> Column:
        return F.col(name) if name in have else typed_null()

    billing = F.when(F.col("_NATUREZA") == SALE, "Faturamento") \
        .when(F.col("_NATUREZA") == SALE_RETURN, "Devolução Faturamento")
    pair = F.col("UF_ORIGEM_DESTINO")
    layout: dict[str, Column] = {
        "CNPJ": col("CNPJ"), "INSCRICAO_ESTADUAL": col("IE"),
        "PERIODO": br_date(col("DT_INI")),
        "TIPO_OPERACAO": label("IND_OPER_C100", OPERATION_KIND),
        "INDICADOR_EMITENTE": label("IND_EMIT_C100", ISSUER),
        "CODIGO_PARTICIPANTE": col("COD_PART_C100"),
        "CNPJ_PARTICIPANTE": col("CNPJ_PARTICIPANTE"), "CPF_PARTICIPANTE": col("CPF_PARTICIPANTE"),
        "NOME_PARTICIPANTE": col("NOME_PARTICIPANTE"), "IE_PARTICIPANTE": col("IE_PARTICIPANTE"),
        "OPCAO_SIMPLES": typed_null(), "DATA_OPCAO_SIMPLES": typed_null("date"),
        "DATA_EXCLUSAO_SIMPLES": typed_null("date"),
        "UF_ORIGEM_DESTINO": pair, "CODIGO_MUNICIPIO": col("COD_MUN_PARTICIPANTE"),
        "MUNICIPIO": typed_null(),
        "MODELO": col("COD_MOD_C100"), "SITUACAO": col("COD_SIT_C100"), "SERIE": col("SER_C100"),
        "NUMERO_DOCUMENTO": col("NUM_DOC_C100"), "CHAVE_NFE": col("CHV_NFE_C100"),
        "DATA_DOCUMENTO": br_date("DT_DOC_C100"), "DATA_ENTRADA_SAIDA": br_date("DT_E_S_C100"),
        "VALOR_DOCUMENTO": col("VL_DOC_C100"), "INDICADOR_PAGAMENTO": label("IND_PGTO_C100", PAYMENT),
        "VLR_DESCONTO_NF": col("VL_DESC_C100"), "VLR_ABATIMENTO_NT": col("VL_ABAT_NT_C100"),
        "VLR_MERCADORIA": col("VL_MERC_C100"), "INDICADOR_FRETE": label("IND_FRT_C100", FREIGHT),
        "VLR_FRETE": col("VL_FRT_C100"), "VLR_SEGURO": col("VL_SEG_C100"),
        "VLR_OUTRAS_DA": col("VL_OUT_DA_C100"),
        "VLR_BASE_CALCULO_ICMS_C100": col("VL_BC_ICMS_C100"), "VLR_ICMS_C100": col("VL_ICMS_C100"),
        "VLR_BASE_CALCULO_ICMS_ST_C100": col("VL_BC_ICMS_ST_C100"),
        "VLR_ICMS_ST_C100": col("VL_ICMS_ST_C100"), "VLR_IPI_C100": col("VL_IPI_C100"),
        "VLR_PIS_C100": col("VL_PIS_C100"), "VLR_COFINS_C100": col("VL_COFINS_C100"),
        "VLR_PIS_ST_C100": col("VL_PIS_ST_C100"), "VLR_COFINS_ST_C100": col("VL_COFINS_ST_C100"),
        "CST_ICMS": col("CST_ICMS"), "CFOP": col("CFOP"), "DESCRICAO_CFOP": col("_DESCRICAO"),
        "CFOP_FATURAMENTO": billing, "ALIQUOTA_ICMS": col("ALIQ_ICMS"), "VLR_OPERACAO": col("VL_OPR"),
        "VLR_BASE_CALCULO_ICMS": col("VL_BC_ICMS"), "VLR_ICMS": col("VL_ICMS"),
        "VLR_BASE_CALCULO_ICMS_ST": col("VL_BC_ICMS_ST"), "VLR_ICMS_ST": col("VL_ICMS_ST"),
        "VLR_REDUCAO_BASE_ICMS": col("VL_RED_BC"), "VLR_IPI": col("VL_IPI"),
        "CODIGO_OBSERVACAO": typed_null(), "DESCRICAO_OBSERVACAO_LANCAMENTO_FISCAL": typed_null(),
        "ANO": F.year(br_date("DT_DOC_C100")),
        "ORIGEM": pair_side(pair, 0), "DESTINO": pair_side(pair, 1),
        "ALIQUOTA": col("ALIQUOTA_TABELA"), "CHAVE_OPERACAO_INTERESTADUAL": pair,
        value_name: value,
    }
    return df.select(*[c.alias(n) for n, c in layout.items()], *keep)


def periods_until(df: DataFrame, period: str = "period", *, last_year: int) -> DataFrame:
    return df.filter(F.substring(period, 1, 4).try_cast("int") <= last_year)

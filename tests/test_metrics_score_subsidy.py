"""Annual-return metrics, score, decision, history and subsidy valuation."""

import pytest
from pyspark.sql import functions as F

from fiscalgrove.catalog import ContractError
from fiscalgrove.operators import metrics as m, score as s, subsidy as sub
from fiscalgrove.plans.diagnostic import diagnose, run, tributary_summary
from fiscalgrove.sources.tables import read_diagnostic
from tests.conftest import rows

PAT = "3.01.01.07.01.13"


@pytest.mark.parametrize("lines, expected", [
    ([("A12", "74344,52"), ("A00", "74344,52")], 74344.52), ([("A00", "10000,00")], 10000.0), ([("A12", "10000,00")], 0.0), ([("A06", "5000,00"), ("A00", "12000,00")], 12000.0)])
def test_l300_counts_the_year_end_only(spark, lines, expected):
    df = spark.createDataFrame([("1", "01012023", PAT, p, v) for p, v in lines], "CNPJ string, DT_INI string, CODIGO string, PER_APUR string, VALOR string")
    row = m.l300_opportunities(df).first()
    assert row["opp_l300_pat_valor"] == expected and row["opp_l300_pat_encontrado"] and row["score_l300_total"] == 20


def company(spark):
    keys = [("1" * 14, f"0101{y}") for y in (2019, 2020, 2021)] + [("1" * 14, "01072020")]
    forms = ["P", "P", "RRRR", "P"]
    return spark.createDataFrame([(c, d, f, "N", "F1") for (c, d), f in zip(keys, forms)], "CNPJ string, DT_INI string, FORMA_TRIB_PER string, NOME string, FILE_ID string")


def test_periods_are_ordered_by_date_not_text(spark):
    got = m.regime_profile(company(spark))
    assert rows(got, "DT_INI", "anos_consecutivos_lp", "regime_alternado", "is_lucro_real", "regime_score_pts") == sorted([
        ("01012019", 1, None, False, 10), ("01012020", 2, False, False, 10), ("01072020", 3, False, False, 10), ("01012021", 3, True, True, 30)])


def test_diagnosis_end_to_end_is_repeatable(spark, tmp_path):
    reg = company(spark)
    l300 = spark.createDataFrame([("1" * 14, "01012021", "3.01", "A00", "1.000,00"), ("1" * 14, "01012021", PAT, "A00", "200.000,00"), ("1" * 14, "01012020", "3.01", "A00", "-5,00")],
                                 "CNPJ string, DT_INI string, CODIGO string, PER_APUR string, VALOR string")
    l100 = spark.createDataFrame([("1" * 14, "01012021", "2.03", "A00", "100,00"), ("1" * 14, "01012020", "2.03", "A00", "-50,00")],
                                 "CNPJ string, DT_INI string, CODIGO string, PER_APUR string, VAL_CTA_REF_INI string")
    n500 = spark.createDataFrame([("1" * 14, "01012021", "10,00"), ("1" * 14, "01012021", "1,5")], "CNPJ string, DT_INI string, VALOR string")
    src = {"0010": reg, "L300": l300, "L100": l100, "N500": n500, "company": reg.withColumn("DT_FIN", F.lit("31122021"))}
    final, found = diagnose(src)
    row = final.filter("DT_INI='01012021'").first()
    assert row["raw_score"] == 30 + 10 + 20 + 20 and row["final_score"] == 80 and row["classification"] == "OPORTUNIDADE_ALTISSIMA"
    assert row["go_no_go"] == "GO" and row["commercial_priority"] == "ALTISSIMA" and row["NOME"] == "N"
    assert row["evolucao_patrimonial_pct"] == 300.0 and row["capacidade_jcp_estimada"] == 6.0
    assert row["resultado_fiscal"] == 11.5 and row["estimated_recovery"] == pytest.approx(30_000.0)
    assert row["commercial_viability_index"] == pytest.approx(48 + 12 * 0.4)
    assert rows(found, "DT_INI", "opportunity_id", "estimated_credit") == [("01012021", "L300_PAT", 30_000.0)]
    base = str(tmp_path / "gold")
    for _ in range(2):
        run(spark, src, base)
    for name in ("summary", "scores", "go_no_go", "financials", "master", "master_historical"):
        assert read_diagnostic(spark, base, name).count() == 4, name
    assert read_diagnostic(spark, base, "opportunities", dt_ini="01012021").count() == 1
    assert read_diagnostic(spark, base, "company_tax_profile") is None
    report = tributary_summary(read_diagnostic(spark, base, "master"), last_years=1, this_year=2021)
    assert len(report.columns) == 20 and report.count() == 3
    assert report.filter("`Período`='2021'").first()["CNPJ"] == "11.111.111/1111-11"


def test_credits_added_in_place_equal_the_summed_rows(spark):
    df = spark.createDataFrame([("a", "01012023", True, -100.0, False, 9.0, 50.0), ("b", "01012023", True, 1e7, True, 3.0, 90.0), ("c", "01012023", False, 1.0, None, None, 10.0)],
                               "CNPJ string, DT_INI string, opp_l300_pat_encontrado boolean, opp_l300_pat_valor double, opp_m310_art30_encontrado boolean, opp_m310_art30_valor double, final_score double")
    cols = ("CNPJ", "estimated_recovery", F.round("commercial_viability_index", 6))
    assert rows(s.viability(df), *cols) == rows(s.viability(df, s.opportunity_rows(df)), *cols) == [
        ("a", 15.0, 30.0024), ("b", 1_500_003.0, 70.0), ("c", 0.0, 6.0)]


def test_every_source_may_be_absent(spark):
    final, found = diagnose({"0010": company(spark)})
    assert final.count() == 4 and found.count() == 0
    with pytest.raises(ValueError):
        diagnose({"0010": None})
    with pytest.raises(ContractError):
        m.accounting_result(None)


def test_bands_and_priorities(spark):
    df = spark.createDataFrame([(90.0, True, 1.0, False), (70.0, True, 1.0, False), (50.0, True, 1.0, False), (30.0, True, 1.0, False), (10.0, False, 1.0, False), (95.0, True, 1.0, True), (70.0, True, 0.0, False)],
                               "final_score double, is_lucro_real boolean, patrimonio_liquido double, regime_no_go_presumido boolean")
    assert [(r["go_no_go"], r["commercial_priority"]) for r in s.go_no_go(df).collect()] == [
        ("GO", "ALTISSIMA"), ("GO", "ALTA"), ("GO", "MEDIA"), ("GO", "NO_GO"), ("ANALISAR", "BAIXA"), ("NO_GO", "NO_GO"), ("ANALISAR", "BAIXA")]
    card = s.scorecard(spark.createDataFrame([(True, True, True, 5.0, False, 55, 80, 1), (False, False, False, 0.0, True, 0, None, 2)],
                                             "is_lucro_real boolean, pl_positivo boolean, tem_lucro_fiscal boolean, total_retencoes double, ausencia_darf boolean, score_l300_total int, score_m310_total int, recorrencia_prejuizo_fiscal_anos long"))
    assert rows(card, "raw_score", "final_score", "classification") == [(-45.0, 0.0, "NO_GO"), (225.0, 100.0, "OPORTUNIDADE_ALTISSIMA")]


def test_streak_is_broken_by_another_regime(spark):
    df = spark.createDataFrame([("c", f"0101{y}", f) for y, f in zip(range(2015, 2021), [True, True, False, True, True, None])], "CNPJ string, DT_INI string, p boolean")
    assert [r["s"] for r in m.streak(df, "p", "s").orderBy("DT_INI").collect()] == [1, 2, 0, 1, 2, 0]


TOTALS = "_file_id string, _row_id long, _parent_uid_final long, CNPJ string, IE string, DT_INI string, CST_ICMS string, CFOP string, VL_OPR string, VL_RED_BC string, ALIQ_ICMS string"


def subsidy_inputs(spark):
    t = lambda i, cst, cfop, opr, red, up=1, f="f": (f, i, up, "1" * 14, "ie", "01012023", cst, cfop, opr, red, "18,00")
    c190 = spark.createDataFrame([t(10, "040", "5102", "1.000,00", None), t(11, "020", "1202", "10,00", "100,00"), t(12, "051", "5102", "10,00", "50,00"), t(13, "051", "5102", "20,00", "0"),
                                  t(14, "040", "5107", "10,00", None), t(15, "000", "5102", "1", None), t(16, "040", "9999", "1", None), t(17, "040", "5102", "100,00", None, 2), t(18, "040", "5102", "100,00", None, 3),
                                  t(10, "040", "5102", "1.000,00", None), t(10, "040", "5102", "7,00", None, 1, "other")], TOTALS)
    c100 = spark.createDataFrame([("f", 1, "1", "55", "P1", "05012023"), ("f", 2, "1", "65", "P1", "bad"), ("f", 3, "0", "55", "unknown", None), ("other", 1, "0", "55", "P1", None)],
                                 "_file_id string, _row_id long, IND_OPER string, COD_MOD string, COD_PART string, DT_DOC string")
    head = spark.createDataFrame([("f", "SP"), ("f", "SP"), ("other", "MG")], "_file_id string, UF string")
    people = spark.createDataFrame([("f", "P1", "x", "3304557", 5), ("f", "P1", "x", "3304557", 5), ("f", "P1", "later", "1", 9), ("other", "P1", "o", "3304557", 1)],
                                   "_file_id string, COD_PARTICIPANTE string, NOME_PARTICIPANTE string, COD_MUN_PARTICIPANTE string, _row_id long")
    people = people.withColumns({n: F.lit(None).cast("string") for n in ("CNPJ_PARTICIPANTE", "CPF_PARTICIPANTE", "IE_PARTICIPANTE", "UF")})
    refs = {"cfop": spark.createDataFrame([(5102, "v", "Venda"), (1202, "d", "Devolução de venda"), (5102, "v2", "Venda")], "cfop int, descricao string, natureza string"),
            "municipios": spark.createDataFrame([("3304557", "RJ"), ("3304557", "RJ"), (None, "ZZ")], "cod_mun string, uf string"),
            "aliquotas": spark.createDataFrame([("SP", "RJ", 12.0), ("SP", "SP", 18.0), ("RJ", "MG", 7.0)], "Origem string, Destino string, Aliquota double")}
    return {"C190": c190, "C100": c100, "0000": head, "0150": people}, refs


def test_subsidy_cases(spark):
    regs, refs = subsidy_inputs(spark)
    out = sub.value_operations(regs, refs)
    ex = rows(out["exemption"], "CST_ICMS", "CFOP", "UF_ORIGEM_DESTINO", "ALIQUOTA", F.round("CALCULO_DA_ISENCAO", 4))
    assert ex == sorted([
        ("040", 5102, "SP/RJ", 12.0, 120.0),     # plain sale
        ("051", 5102, "SP/RJ", 12.0, 2.4),       # conditional without a reduction
        ("040", 5107, "SP/RJ", 12.0, 1.2),       # code not in the table: digit sign
        ("040", 5102, "SP/SP", 18.0, 18.0),      # consumer invoice: own-state pair
        ("040", 5102, "SP/SP", 18.0, 18.0),      # unknown participant: own-state pair
        ("040", 5102, "RJ/MG", 7.0, 0.49),       # the other file's document 1 is another document
    ], key=repr)
    red = rows(out["reduction"], "CST_ICMS", "CFOP", "CFOP_FATURAMENTO", F.round("CALCULO_DA_REDUCAO", 4))
    assert red == [("020", 1202, "Devolução Faturamento", -18.0), ("051", 5102, "Faturamento", 9.0)]
    assert len(out["exemption"].columns) == 61 and len(set(out["exemption"].columns)) == 61
    assert {r[0] for r in rows(out["exemption"].filter("CNPJ is not null"), "NOME_PARTICIPANTE")} == {"x", "o", None}


@pytest.mark.parametrize("gone", ["C100", "0000", "0150"])
def test_missing_documents_block_the_exemption_only(spark, gone):
    regs, refs = subsidy_inputs(spark)
    out = sub.value_operations({**regs, gone: None}, refs)
    assert out["exemption"] is None and out["reduction"].count() == 2
    assert rows(out["reduction"], "UF_ORIGEM_DESTINO", "ALIQUOTA") == [(None, None)] * 2
    assert sub.value_operations({"C190": None}, refs) == {"exemption": None, "reduction": None}
    with pytest.raises(ContractError):
        sub.value_operations({"C190": regs["C190"].drop("VL_OPR")}, refs)


def test_funnel(spark):
    regs, refs = subsidy_inputs(spark)
    assert rows(sub.eligibility_funnel(regs["C190"])) == [(11, 10, 9)]
    assert rows(sub.eligible_periods(regs["C190"], ["_file_id"])) == [("f", 1), ("other", 1)]
    assert rows(sub.unexpected_cfops(regs["C190"], refs["cfop"]), "CFOP") == [(5107,), (9999,)]
    assert len(sub.CST_REDUCTION) == 17 and len(sub.CFOP_ELIGIBLE) == 62

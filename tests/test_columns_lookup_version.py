"""Scalars, file names, column contracts, lookups, versions."""

import pytest
from pyspark.sql import functions as F

from fiscalgrove import functions as fx
from fiscalgrove.catalog import ContractError
from fiscalgrove.operators import audit, columns as c, lookup as lk, version as v
from tests.conftest import rows


def values(spark, ddl, data, *exprs):
    return rows(spark.createDataFrame(data, ddl).select(*exprs))


def test_br_decimal(spark):
    got = values(spark, "x string", [("15.647,02",), ("74344,52",), ("1.5",), ("",), ("abc",), ("-3,10",), (None,)], "x", fx.br_decimal("x"))
    assert dict(got) == {"15.647,02": 15647.02, "74344,52": 74344.52, "1.5": 15.0, "": None, "abc": None, "-3,10": -3.1, None: None}


def test_identity_scalars(spark):
    got = values(spark, "x string", [("11.222.333/0001-44",), ("11222333",), ("123",), (None,)], fx.cnpj_root("x"), fx.cnpj_root_error("x"))
    assert got == sorted([("11222333", None), ("11222333", None), (None, "invalid CNPJ: 123"), (None, "invalid CNPJ: NULL")], key=repr)
    assert values(spark, "x string", [("01072023",), ("0107",), (None,)], fx.period_of_header("x")) == [("",), ("",), ("202307",)]
    assert values(spark, "r int", [(0,), (3,), (6,), (9,)], "r", fx.backoff_seconds("r")) == [(0, 1.0), (3, 8.0), (6, 60.0), (9, 60.0)]
    assert values(spark, "d string, o string, p string", [("1", "SP", "RJ"), ("0", "SP", "RJ"), ("1", "SP", None), ("9", "SP", "RJ")],
                  fx.uf_pair("d", "o", "p")) == sorted([("SP/RJ",), ("RJ/SP",), (None,), (None,)], key=repr)
    assert values(spark, "x int", [(1202,), (3211,), (5102,), (7101,)], "x", fx.cfop_sign("x")) == [(1202, -1), (3211, -1), (5102, 1), (7101, 1)]
    assert values(spark, "x string", [("11222333000144",), ("42",)], fx.mask_cnpj("x")) == [("00.000.000/0000-42",), ("11.222.333/0001-44",)]
    assert values(spark, "x string", [("01012023",), ("012022",), ("x",)], fx.year_of_period("x")) == [("2022",), ("2023",), ("x",)]


def test_file_classification(spark):
    cases = {
        "a/SPEDECF-1.txt": "ECF", "a/LECD_1.txt": "ECD", "x/PISCOFINS_1.txt": "EFD_CONTRIB", "x/pisconfins_1.txt": "EFD_CONTRIB",
        "b/EFD Contribuições/f.txt": "EFD_CONTRIB", "b/EFD Contribuições/f.txt": "EFD_CONTRIB", "b/efd_fiscal/f.txt": "EFD_FISCAL",
        "b/ECD/f.txt": "ECD", "b/ECF/f.txt": "ECF", "b/other/f.txt": None}
    got = dict(values(spark, "p string", [(p,) for p in cases], "p", fx.return_type_fast("p")))
    assert got == cases
    by_head = values(spark, "h string", [("|0000|LECF|",), ("|0000|LECD|",), ("|0000|" + "x|" * 13,), ("|0000|" + "x|" * 14,), ("|0000|x|",)],
                     fx.return_type(F.lit("n/f.txt"), "h"))
    assert by_head == sorted([("ECF",), ("ECD",), ("EFD_CONTRIB",), ("EFD_FISCAL",), (None,)], key=repr)
    assert values(spark, "p string", [("x/escrituração contábil/f",), ("x/ecf/f",), ("x/y/f",)], fx.is_known_path("p")) == [(False,), (True,), (True,)]


def test_amended_by_name_and_header(spark):
    names = ["T_01012023_31012023_11222333000144_Original_x.txt", "T_01012023_31012023_11222333000144_Retificadora_x.txt",
             "T_01022023_28022023_11222333000144_original_y.txt", "free name.txt", "other.txt"]
    df = spark.createDataFrame([(f"d/{n}",) for n in names], "file_path string")
    assert [r[0][2:] for r in rows(v.resolve_amended_names(df))] == sorted([*names[1:]])
    head = spark.createDataFrame(
        [("c", "1", "2", "S", "SPEDECF-c-1-2-20240101.txt"), ("c", "1", "2", "s ", "SPEDECF-c-1-2-20240201.txt"), ("c", "1", "2", "N", "SPEDECF-c-1-2-20250101.txt"),
         ("c", "7", "9", "N", "SPEDECF-c-7-9-1.txt"), (None, None, None, None, "empty.txt"), (None, None, None, None, "empty2.txt")],
        "cnpj string, dt_ini string, dt_fin string, retificadora string, file_path string")
    assert [r[0] for r in rows(v.resolve_amended_headers(head), "file_path")] == ["SPEDECF-c-1-2-20240201.txt", "SPEDECF-c-7-9-1.txt", "empty.txt", "empty2.txt"]


def test_latest_version(spark):
    mk = lambda ddl, *data: spark.createDataFrame(list(data), ddl)
    ddl = "CNPJ string, DT_INI string, IND_REC string, VALOR string"
    assert rows(v.latest_version(mk(ddl, ("1", "01012023", "0", "100.00"), ("1", "01012023", "1", "250.00"))), "VALOR") == [("250.00",)]
    assert v.latest_version(mk("CNPJ string, DT_INI string, FILE_ID long, VALOR int", ("1", "a", 1, 5), ("1", "a", 2, 6))).first()["FILE_ID"] == 2
    split = mk(ddl, ("1", "01012023", "0", "100"), ("1", "01012023", "1", "150.00"), ("1", "01072023", "0", "90"), ("1", "01072023", "1", "260.00"))
    assert rows(v.latest_version(split), "VALOR") == [("150.00",), ("260.00",)]
    plain = mk("COL_X string, COL_Y long", ("a", 1), ("a", 1), ("b", 2))
    assert v.latest_version(plain).count() == 3
    assert v.latest_version(mk("CNPJ string, DT_INI string, VALOR int", ("1", "a", 1), ("1", "a", 1), ("1", "a", 2))).count() == 2
    assert v.latest_version(None) is None
    nulls = mk(ddl, (None, "a", None, "x"), (None, "a", "0", "y"), ("1", None, None, "z"), ("1", None, None, "w"))
    assert rows(v.latest_version(nulls), "VALOR") == [("w",), ("y",), ("z",)]


def test_merge_history(spark):
    ddl = "CNPJ string, DT_INI string, cnpj_base string, n int"
    now = spark.createDataFrame([("A" * 14, "01012023", "A" * 8, 1), ("A" * 14, "01012023", "A" * 8, 1)], ddl)
    old = spark.createDataFrame([("A" * 14, "01012023", "A" * 8, 9), ("A" * 14, "01012022", "A" * 8, 2), ("A" * 14, "01012018", "A" * 8, 3), ("A" * 14, "01012017", "A" * 8, 4),
                                 ("B" * 14, "01012010", "B" * 8, 5), (None, "01012023", None, 6)], ddl)
    assert rows(v.merge_history(now, old), "DT_INI", "n") == [("01012010", 5), ("01012018", 3), ("01012022", 2), ("01012023", 1)]
    assert v.merge_history(now, None).count() == 1
    assert rows(v.history_of_current_companies(now, old, this_year=2024), "DT_INI", "n") == [("01012022", 2), ("01012023", 1)]


def test_column_contracts(spark):
    df = spark.createDataFrame([(1, None, "x")], "a int, b double, c string")
    assert c.order_columns(df, ["c", "z"]).columns == ["c", "a", "b"]
    assert c.order_columns(df, ["c", "z"], "only_listed").columns == ["c", "z"]
    assert c.order_columns(df, ["c", "z"], "listed_then_rest").columns == ["c", "z", "a", "b"]
    twice = df.select("a", F.col("b").alias("A"), "c")
    with pytest.raises(ContractError):
        c.reject_duplicate_columns(twice)
    assert c.keep_first_of_duplicates(twice).columns == ["a", "c"]
    assert c.plain_names(df.toDF("Período inicial", "b-c", "ok")).columns == ["PERIODO_INICIAL", "B_C", "OK"]
    assert c.prefix_columns(df, "p", ["a"]).columns == ["a", "p__b", "p__c"]
    assert dict(c.void_to_string(df.withColumn("v", F.lit(None))).dtypes)["v"] == "string"
    filled = c.fill_roles(spark.createDataFrame([(None, None, None)], "x_valor double, y_encontrado boolean, k string"), numeric_suffixes=("_valor",), flag_suffixes=("_encontrado",))
    assert rows(filled) == [(0.0, False, None)]
    assert c.empty_frame(spark, ["a", "b"]).count() == 0
    with pytest.raises(ContractError):
        c.require_columns(df, ["q"], "x")
    assert rows(c.add_constants(df.withColumn("REG", F.lit("C100")), {"k": "v"}, ["C170"]), "k") == [(None,)]
    assert rows(c.coalesce_double(df, "b"), "b") == [(0.0,)]


def test_lookup_semantics(spark):
    left = spark.createDataFrame([(1, " 10", "a"), (2, "20", None), (3, None, "b"), (4, None, None), (5, "99", "a")], "id int, cnpj string, cpf string")
    right = spark.createDataFrame([("10", None, "ten"), ("20", None, "twenty"), (None, "a", "A"), (None, "b", "B"), ("10", None, "ten again")], "k string, p string, NOME string")
    got = lk.lookup(left, right, [{"cnpj": "k"}, {"cpf": "p"}], ["NOME"], mode="coalesce")
    assert rows(got, "id", "NOME") == [(1, "ten"), (2, "twenty"), (3, "B"), (4, None), (5, "A")]
    both = lk.lookup(left, right.withColumn("p", F.lit("a")), [{"cnpj": "k"}, {"cpf": "p"}], ["NOME"])
    assert rows(both, "id", "NOME") == [(1, "ten"), (2, None), (3, None), (4, None), (5, None)]
    assert rows(lk.lookup(left, None, ["cnpj"], [{"x": "Y"}]), "id", "Y")[0] == (1, None)
    kept = lk.lookup(left.withColumn("NOME", F.lit("mine")), right, [{"cnpj": "k"}], ["NOME"])
    assert {r[0] for r in rows(kept, "NOME")} == {"mine"} and kept.count() == 5


def test_chunked_rollup(spark):
    many = [("f", 1, n, None if n % 5 == 0 else f"v{n % 7}") for n in range(1000, 0, -1)]
    child = spark.createDataFrame([*many, ("f", 2, 3, "a"), ("g", 1, 3, "b"), ("g", None, 4, "c"), ("g", 3, 5, None)], "_file_id string, up long, _row_id long, v string").repartition(7)
    chunks = lk.roll_up_chunks(child, ["_file_id", "up"], [{"v": "vs"}, {"absent": "x"}], lines=64)
    assert chunks.columns == ["_file_id", "up", "chunk", "vs"] and max(len(r["vs"]) for r in chunks.collect()) <= 64
    whole = {}
    for r in sorted(chunks.collect(), key=lambda r: r["chunk"]):
        whole.setdefault((r["_file_id"], r["up"]), []).extend(r["vs"])
    assert whole == {(r["_file_id"], r["up"]): r["vs"] for r in lk.roll_up_children(child, ["_file_id", "up"], [{"v": "vs"}], "collect_list").collect()}
    assert whole["g", 3] == [] and whole["g", None] == ["c"]
    placed = {}
    for r in lk.numbered_children(chunks, ["_file_id", "up"], "vs").collect():
        placed.setdefault((r["_file_id"], r["up"]), {})[r["place"]] = r["vs"]
    assert {k: [v[i] for i in range(len(v))] for k, v in placed.items()} == {k: v for k, v in whole.items() if v}


def test_chunked_rollup_tells_files_apart(spark):
    child = spark.createDataFrame([(1, f, n, n) for f in "ab" for n in range(10)], "company int, _file_id string, _row_id long, v long")
    chunks = lk.roll_up_chunks(child, "company", ["v"], within="_file_id", lines=4)
    assert max(len(r["v"]) for r in chunks.collect()) == 4
    got = sorted((r["place"], r["v"]) for r in lk.numbered_children(chunks, "company", "v", within="_file_id").collect())
    assert got == list(enumerate([*range(10), *range(10)]))
    assert lk.roll_up_chunks(child.limit(0), "company", ["v"]).count() == 0
    for wrong in (lambda: lk.roll_up_chunks(child, "company", ["v"], order_col="_file_id"), lambda: lk.roll_up_chunks(child, "company", [{"v": "chunk"}])):
        with pytest.raises(ContractError):
            wrong()


def test_rollup_inherit_enrich(spark):
    child = spark.createDataFrame([("f", 3, 1, None), ("f", 4, 1, "b"), ("f", 2, 1, "c"), ("g", 2, 1, "z")], "_file_id string, _row_id long, up long, v string")
    first = lk.roll_up_children(child, ["_file_id", "up"], ["v"])
    assert rows(first) == [("f", 1, "c"), ("g", 1, "z")]
    every = lk.roll_up_children(child, ["_file_id", "up"], [{"v": "vs"}], "collect_list")
    assert rows(every) == [("f", 1, ["c", "b"]), ("g", 1, ["z"])]
    parent = spark.createDataFrame([("f", 1, "P"), ("h", 1, "Q")], "_file_id string, _row_id long, p string")
    kid = child.withColumnRenamed("up", "_parent_uid_final")
    assert rows(lk.inherit_fields(kid, parent, ["p"]), "_file_id", "_row_id", "p") == [("f", 2, "P"), ("f", 3, "P"), ("f", 4, "P"), ("g", 2, None)]
    out = lk.enrich(parent, child, strategy="child_agg", key={"from": "_row_id", "to": "up"}, fields=["v"], within="_file_id")
    assert rows(out, "_file_id", "v") == [("f", "c"), ("h", None)]
    with pytest.raises(ContractError):
        lk.enrich(parent, child, strategy="odd", key={"from": "_row_id", "to": "up"}, fields=["v"])


def test_asof_regime(spark):
    reg = spark.createDataFrame([("1", 2020, "R"), ("1", 2022, "P"), ("2", 2023, "R")], "cnpj string, ano int, regime string")
    left = spark.createDataFrame([("1", 2019), ("1", 2020), ("1", 2021), ("1", 2025), ("2", 2022), ("3", 2022), ("1", None), (None, 2022)], "r string, y int")
    got = lk.asof_regime(left, reg, root=F.col("r"), year=F.col("y"))
    assert rows(got, "r", "y", "REGIME_TRIBUTARIO") == sorted(
        [("1", 2019, "NAO_LOCALIZADO"), ("1", 2020, "R"), ("1", 2021, "R"), ("1", 2025, "P"), ("2", 2022, "NAO_LOCALIZADO"),
         ("3", 2022, "NAO_LOCALIZADO"), ("1", None, "P"), (None, 2022, "NAO_LOCALIZADO")], key=repr)


def test_audits(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "f string, r int")
    assert rows(audit.fan_out_audit(df, ["f", "r"])) == [(3, 2, 1)]
    exp = spark.createDataFrame([("a",), ("z",)], "_file_id string")
    got = df.withColumnRenamed("f", "_file_id")
    assert rows(audit.missing_files(exp, got)) == [("z",)]
    y = spark.createDataFrame([("a", 2020), ("a", 2014), ("b", 2010)], "k string, y int")
    assert rows(audit.within_last_years(y, "y", 5)) == [("a", 2020)]
    assert rows(audit.within_last_years(y, "y", 5, by=["k"])) == [("a", 2020), ("b", 2010)]
    assert rows(audit.within_last_years(y, "y", 5, last_year=2019)) == [("a", 2014), ("a", 2020)]


def test_coalesce_lookup_adds_no_rows(spark):
    left = spark.createDataFrame([(1, "a", "x", "p"), (2, "z", "x", "p"), (3, "z", "z", "p"), (4, None, None, None)], "id int, k string, m string, n string")
    right = spark.createDataFrame([("a", "x", "p", "A"), ("a", "y", "q", "B"), ("c", "x", "p", "C")], "k string, m string, n string, v string")
    got = lk.lookup(left, right, ["k", "m", "n"], ["v"], mode="coalesce")
    assert rows(got, "id", "v") == [(1, "A"), (2, "A"), (3, "A"), (4, None)]

"""Reading, parsing, line ids, tree and header propagation."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from fiscalgrove.catalog import EFD_FISCAL, ContractError, Layout, catalogue_from_mapping, catalogues_from_rows, \
    check_layout, layout_from_positions
from fiscalgrove.operators.columns import project_record, project_superset, union_superset
from fiscalgrove.operators.lookup import inherit_by_map
from fiscalgrove.operators.tree import header_of_files, link_parents, misplaced_lines, propagate_header
from fiscalgrove.sources.records import number_lines, parse_records, read_lines, tag_records, with_cols, with_file_fields
from tests.conftest import rows

RULES = [{"parent": "0000", "children": ["C100"]}, {"parent": "C100", "children": ["C170", "C190"]}]


def brute_force(lines, rules, override=()):
    parent_of = {c: r["parent"] for r in rules for c in r.get("children", [])}
    out, last = {}, {}
    for file, rid, reg in sorted(lines):
        seen = last.setdefault(file, {})
        want = "0000" if reg in override else parent_of.get(reg)
        out[(file, rid)] = None if want is None else seen.get(want, seen.get("0000"))
        seen[reg] = rid
    return out


def test_small_fixture(spark, tmp_path):
    text = ("|0000|h|\n|C100|doc 1|\n|C170|item 1 of doc 1|\n|c170 |item 2 of doc 1|\n|C190|total of doc 1|\n"
            "|C100|doc 2|\n|C170|C100|\n|X999|no rule|\n")
    (tmp_path / "a.txt").write_text(text)
    (tmp_path / "b.txt").write_text("|C170|orphan|\n|0000|h|\n|C170|before any document|\n|C100|d|\n|C190|t|\n")
    lines = parse_records(read_lines(spark, str(tmp_path)))
    linked = link_parents(lines, RULES)
    parent = linked.select("_source_file", F.col("_row_id").alias("_parent_uid_final"), F.col("value").alias("up"))
    got = linked.join(parent, ["_source_file", "_parent_uid_final"], "left")
    found = {(r["_source_file"][-5:], r["value"]): (r["up"], r["_expected_parent"]) for r in got.collect()}
    assert found[("a.txt", "|0000|h|")] == (None, None)
    assert found[("a.txt", "|C100|doc 2|")] == ("|0000|h|", "0000")
    assert found[("a.txt", "|C170|item 1 of doc 1|")] == ("|C100|doc 1|", "C100")
    assert found[("a.txt", "|c170 |item 2 of doc 1|")] == ("|C100|doc 1|", "C100")
    assert found[("a.txt", "|C190|total of doc 1|")] == ("|C100|doc 1|", "C100")
    assert found[("a.txt", "|C170|C100|")] == ("|C100|doc 2|", "C100")
    assert found[("a.txt", "|X999|no rule|")] == (None, None)
    assert found[("b.txt", "|C170|orphan|")] == (None, "C100")
    assert found[("b.txt", "|C170|before any document|")] == ("|0000|h|", "C100")
    assert found[("b.txt", "|C190|t|")] == ("|C100|d|", "C100")
    bad = {r["value"] for r in misplaced_lines(linked).collect()}
    assert bad == {"|C170|orphan|", "|C170|before any document|"}


@pytest.mark.parametrize("chunk_bits", [1, 3, 18])
def test_tree_matches_brute_force_across_chunks(spark, chunk_bits):
    rnd = random.Random(7)
    rules = [{"parent": "0000", "children": ["A", "B"]}, {"parent": "A", "children": ["C", "D"]},
             {"parent": "C", "children": ["E", "C"]}, {"parent": "E", "children": ["F"], "children_override": ["G"]}]
    lines = []
    for f in range(4):
        regs = ["0000"] + rnd.choices(["A", "B", "C", "D", "E", "F", "G", "Z", "0000"], [3, 2, 4, 6, 4, 9, 1, 1, .3],
                                      k=[0, 5, 60, 900][f])
        if f == 2:
            regs = regs[1:]
        lines += [(f"f{f}", i * (3 if f == 3 else 1), r) for i, r in enumerate(regs)]
    df = spark.createDataFrame(lines, "_source_file string, _row_id long, REG string")
    got = {(r[0], r[1]): r[2] for r in link_parents(df, rules, chunk_bits=chunk_bits).select(
        "_source_file", "_row_id", "_parent_uid_final").collect()}
    assert got == brute_force(lines, rules, {"G"})


@pytest.mark.parametrize("chunk_bits", [1, 3, 18])
def test_ancestor_paths_across_chunks(spark, chunk_bits):
    rnd = random.Random(8)
    rules = [{"parent": "0000", "children": ["A", "B"]}, {"parent": "A", "children": ["C", "D"]},
             {"parent": "C", "children": ["E"]}, {"parent": "E", "children": ["F"], "children_override": ["G"]}]
    lines = []
    for f in range(4):
        regs = ["0000"] * (f != 2) + rnd.choices(["A", "B", "C", "D", "E", "F", "G", "Z", "0000"], [3, 2, 4, 6, 4, 9, 1, 1, .3], k=[0, 5, 60, 900][f])
        lines += [(f"f{f}", i * 2, r) for i, r in enumerate(regs)]
    parent, kind = brute_force(lines, rules, {"G"}), {(f, i): r for f, i, r in lines}

    def path(f, i):
        up = parent[f, i]
        return [] if up is None else [(kind[f, up], up), *path(f, up)]

    df = spark.createDataFrame(lines, "_source_file string, _row_id long, REG string")
    out = link_parents(df, rules, chunk_bits=chunk_bits, path_col="up").collect()
    assert {(r["_source_file"], r["_row_id"]): [tuple(a) for a in r["up"]] for r in out} == {(f, i): path(f, i) for f, i, _ in lines}
    assert {(r["_source_file"], r["_row_id"]): r["_parent_uid_final"] for r in out} == parent
    with pytest.raises(ContractError):
        link_parents(df, [*rules, {"parent": "E", "children": ["A"]}], path_col="up")


def test_inheritance_over_levels(spark):
    """Nearest ancestor of the named type, several rules for a type, none found, wrong maps."""
    catalogue = catalogue_from_mapping({"0000": "CO", "A": "A1 A2", "B": "B1", "C": "C1"})
    rules = [{"parent": "0000", "children": ["A"]}, {"parent": "A", "children": ["B"]}, {"parent": "B", "children": ["C"]}]
    text = ["|C|before|", "|0000|x|", "|C|far|", "|A|a|aa|", "|B|b|", "|C|c|", "|A|a2||", "|C|c2|", "|0000|y|", "|A|a3|a4|"]
    lines = with_cols(tag_records(spark.createDataFrame([("f", i, t) for i, t in enumerate(text)], "_source_file string, _row_id long, value string")))
    wide = project_superset(link_parents(lines, rules, path_col="up"), catalogue)
    out = inherit_by_map(wide, lines, {"C": [{"from": "A", "fields": ["A1", {"A2": "OF_A"}]}, {"from": "0000", "fields": ["CO"]}], "A": {"from": "0000", "fields": ["CO"]}}, catalogue, path_col="up")
    got = {r["_row_id"]: (r["A1"], r["OF_A"], r["CO"]) for r in out.collect()}
    # the third C stands after another A, but its parent is the B before it
    assert got == {0: (None, None, None), 1: (None, None, "x"), 2: (None, None, "x"), 3: ("a", None, "x"), 4: (None, None, None), 5: ("a", "aa", "x"), 6: ("a2", None, "x"), 7: ("a", "aa", "x"),
                   8: (None, None, "y"), 9: ("a3", None, "y")}
    for wrong in ({"C": {"from": "A", "fields": ["NO"]}}, {"C": {"from": "Z", "fields": []}}, {"A": {"from": "0000", "fields": [{"CO": "A1"}]}}):
        with pytest.raises(ContractError):
            inherit_by_map(wide, lines, wrong, catalogue, path_col="up")


def test_no_group_of_the_tree_plan_is_a_whole_file(spark):
    df = spark.range(0, 4096).select(F.lit("one").alias("_source_file"), F.col("id").alias("_row_id"),
                                     F.when(F.col("id") == 0, "0000").when(F.col("id") % 7 == 1, "C100")
                                     .otherwise("C170").alias("REG"))
    plan = link_parents(df, RULES, chunk_bits=6)._jdf.queryExecution().executedPlan().toString()
    wide = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln]
    assert any("_t_chunk" in ln and "_t_want" in ln and "_t_file" in ln for ln in wide)
    assert not any("hashpartitioning(_t_file" in ln and "_t_want" not in ln for ln in wide)


def test_line_ids_keep_order_over_many_splits(spark, tmp_path):
    body = "".join(f"|C170|{i}|{'x' * (i % 90)}|\n" for i in range(60_000))
    (tmp_path / "big.txt").write_text("|0000|h|\n" + body)
    with gzip.open(tmp_path / "packed.txt.gz", "wt") as out:
        out.write("|0000|h|\n" + body[:40_000].rsplit("\n", 1)[0] + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        lines = parse_records(read_lines(spark, str(tmp_path)))
        assert lines.rdd.getNumPartitions() > 2
        numbered = number_lines(lines, chunk_bits=10).filter("REG = 'C170'").select(
            F.col("line_no"), F.get("cols", F.lit(2)).cast("long").alias("i"))
        assert numbered.filter("line_no <> i + 2").count() == 0
        assert numbered.filter("line_no = i + 2").count() > 60_000
        dup = lines.groupBy("_source_file", "_row_id").count().filter("count > 1").count()
        assert dup == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_tiny_splits_are_refused(spark, tmp_path):
    (tmp_path / "a.txt").write_text("|0000|\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        with pytest.raises(ValueError):
            read_lines(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_parse_keeps_only_field_one_matches_and_short_lines(spark):
    df = spark.createDataFrame([("|C100|a|",), ("|C170|C100|x|",), ("| c-100 |b|",), ("noise",), ("",)], "value string")
    kept = parse_records(df, ["C100"])
    assert rows(kept, "value") == [("| c-100 |b|",), ("|C100|a|",)]
    cat = catalogue_from_mapping({"C100": "A B C"})
    assert rows(project_record(kept, cat["C100"]), "A", "B", "C") == [("a", "", None), ("b", "", None)]


def test_superset_equals_union_of_projections(spark):
    cat = {**catalogue_from_mapping({"C100": "A B X", "C170": "X A Q"}),
           "C190": Layout("C190", ("REG", "N", "D"), {"N": "double", "D": "date"})}
    df = parse_records(spark.createDataFrame(
        [("|C100|1|2|3|",), ("|C170|4|5|6|",), ("|C190|1.5|20240131|",), ("|C190|bad|99999999|",), ("|C170|7|",)],
        "value string")).withColumn("_row_id", F.monotonically_increasing_id())
    wide = project_superset(df, cat)
    parts = union_superset([project_record(df.filter(F.col("REG") == r), cat[r]) for r in cat])
    names = sorted(wide.columns)
    assert sorted(parts.columns) == names
    assert rows(wide.drop("_row_id"), *[n for n in names if n != "_row_id"]) == \
        rows(parts.drop("_row_id"), *[n for n in names if n != "_row_id"])


def test_headers_go_to_every_line_of_their_file(spark):
    df = spark.createDataFrame(
        [("f1", 0, "0000", "11"), ("f1", 1, "C100", None), ("f2", 0, "C100", None), ("f3", 2, "0000", "33"),
         ("f3", 5, "0000", "99")], "_file_id string, _row_id long, REG string, CNPJ string")
    head = header_of_files(df, {"H": F.col("CNPJ")})
    assert rows(head) == [("f1", "11"), ("f3", "33")]
    out = propagate_header(df, head)
    assert rows(out, "_file_id", "_row_id", "H") == [
        ("f1", 0, "11"), ("f1", 1, "11"), ("f2", 0, None), ("f3", 2, "33"), ("f3", 5, "33")]


def test_file_fields_of_encoded_paths(spark, tmp_path):
    folder = tmp_path / "TO_CONVERT" / "11222333" / "EFD Contribuições" / "202301"
    folder.mkdir(parents=True)
    (folder / "PISCOFINS a+b.txt").write_text("|0000|x|\n")
    got = with_file_fields(parse_records(read_lines(spark, str(tmp_path), whole_tree=True)))
    assert rows(got, "_file_id", "_cnpj_path", "_periodo_path") == [("PISCOFINS a+b.txt", "11222333", "202301")]


def test_layout_contracts():
    assert EFD_FISCAL["C190"].positions()["VL_OPR"] == 5
    with pytest.raises(ContractError):
        layout_from_positions("X", {"REG": 1, "A": 3})
    with pytest.raises(ContractError):
        Layout("X", ("REG", "UF", "uf"))
    check_layout(Layout("X", ("REG", "A")), ["REG", "A"])
    with pytest.raises(ContractError):
        check_layout(Layout("X", ("REG", "A", "B")), ["REG", "B", "A"])
    cats = catalogues_from_rows([
        {"return_type": "T", "register": "R1", "position": "2", "field": "A", "type": "double"},
        {"return_type": "T", "register": "R1", "position": "1", "field": "REG"}])
    assert cats["T"]["R1"].fields == ("REG", "A") and cats["T"]["R1"].type_of("A") == "double"
    assert cats["T"]["R1"].struct()["A"].dataType.simpleString() == "double"

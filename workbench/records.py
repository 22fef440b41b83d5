"""Parsing, tree, projection, scalars and file classification."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalgrove import functions as fx
from fiscalgrove.catalog import Layout, catalogue_from_mapping
from fiscalgrove.functions.scalars import DOCUMENT_STATUS, TAX_REGIMES
from fiscalgrove.operators.columns import order_columns, project_record, project_superset
from fiscalgrove.operators.lookup import handed_down, inherit_by_map
from fiscalgrove.operators.tree import chunk_carries, header_of_files, link_parents, misplaced_lines, propagate_header
from fiscalgrove.operators.version import latest_version, resolve_amended_headers, resolve_amended_names
from fiscalgrove.session import scratch_dir
from fiscalgrove.sources.records import discover_periods, number_lines, parse_records, read_lines, tag_records, with_cols
from workbench.derive import CATALOGUE, RULES, br_text, pipe, record_lines, stored, table


def parse_lines(spark, sf):
    """Text lines of all items, parsed and projected to named columns."""
    li = table(spark, sf, "lineitem")
    text = li.select(
        pipe(F.lit(" c-170 "), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"),
             br_text(F.col("l_extendedprice")), F.lit("C100")).alias("value"))
    layout = Layout("C170", ("REG", "DOC", "NUM", "ITEM", "VL", "NOTE"), {"DOC": "long", "NUM": "int", "ITEM": "long"})
    out = project_record(parse_records(text, ["C170"]), layout)
    return out.select("REG", "DOC", "NUM", "ITEM", fx.br_decimal("VL").alias("VL"), "NOTE")


PARSE_SQL = """SELECT 'C170' AS "REG", l_orderkey AS "DOC", l_linenumber AS "NUM", l_partkey AS "ITEM",
 l_extendedprice AS "VL", 'C100' AS "NOTE" FROM lineitem"""


def text_files(spark, sf):
    """The order lines written as text files and read back as one distributed read."""
    path = scratch_dir(spark, "lines")
    orders = table(spark, sf, "orders")
    orders.select(pipe(F.lit("C100"), F.col("o_orderkey"), F.col("o_orderstatus"), br_text(F.col("o_totalprice")),
                       F.date_format("o_orderdate", "ddMMyyyy")).alias("value")).write.text(path)
    wide = project_record(parse_records(read_lines(spark, path), ["C100"]), CATALOGUE["C100"])
    return wide.select(F.col("NUM_DOC").cast("long").alias("NUM_DOC"), "COD_SIT", fx.br_decimal("VL_DOC").alias("VL_DOC"),
                       fx.br_date("DT_DOC").cast("string").alias("DT_DOC"))


TEXT_SQL = """SELECT o_orderkey AS "NUM_DOC", o_orderstatus AS "COD_SIT", o_totalprice AS "VL_DOC",
 strftime(o_orderdate, '%Y-%m-%d') AS "DT_DOC" FROM orders"""


def line_numbers(spark, sf):
    """Gap-free line numbers per file, ranked chunk by chunk."""
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("_source_file"), (F.col("turn") * 3).alias("_row_id"),
                                                 "turn")
    return number_lines(c, chunk_bits=3).select(F.col("_source_file").alias("conv_id"), "turn", "line_no")


LINE_NO_SQL = "SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS line_no FROM conversations"


def _turns(spark, sf):
    return table(spark, sf, "conversations").select(
        F.col("conv_id").alias("_source_file"), F.col("turn").alias("_row_id"), F.col("role").alias("REG"),
        F.length("text").alias("n"))


def record_tree(spark, sf):
    """Parent of each turn: the nearest earlier user turn of its conversation."""
    rules = [{"parent": "user", "children": ["user", "assistant", "system"]}]
    out = link_parents(_turns(spark, sf), rules, root="user", chunk_bits=2)
    return out.select(F.col("_source_file").alias("conv_id"), F.col("_row_id").alias("turn"),
                      F.col("_parent_uid_final").alias("parent"))


TREE_SQL = """SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (
 PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS parent FROM conversations"""


def record_tree_fiscal(spark, sf):
    """Header, document and item lines of every customer's return, linked to their parents."""
    lines = stored(tag_records(record_lines(spark, sf)), "bronze")
    return link_parents(lines, RULES).select(
        F.col("_source_file").cast("long").alias("file"), F.col("_row_id").alias("line"), "REG",
        "_expected_parent", F.col("_parent_uid_final").alias("parent"))


TREE_FISCAL_SQL = """SELECT c_custkey AS file, CAST(0 AS BIGINT) AS line, '0000' AS "REG", CAST(NULL AS VARCHAR) AS _expected_parent,
 CAST(NULL AS BIGINT) AS parent FROM customer
UNION ALL SELECT o_custkey, (o_orderkey + 1) * 16, 'C100', '0000', 0 FROM orders
UNION ALL SELECT o_custkey, (l_orderkey + 1) * 16 + l_linenumber, 'C170', 'C100', (l_orderkey + 1) * 16
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def misplaced(spark, sf):
    """Turns whose parent is not of the role their rule names."""
    rules = [{"parent": "system", "children": ["user"]}, {"parent": "user", "children": ["assistant"]}]
    linked = stored(link_parents(_turns(spark, sf), rules, root="system", chunk_bits=4), "linked")
    return misplaced_lines(linked).select(F.col("_source_file").alias("conv_id"), F.col("_row_id").alias("turn"),
                                          "_expected_parent", "_parent_reg")


MISPLACED_SQL = """WITH t AS (SELECT conv_id, turn, role,
  last_value(CASE WHEN role='system' THEN turn END IGNORE NULLS) OVER w AS s,
  last_value(CASE WHEN role='user' THEN turn END IGNORE NULLS) OVER w AS u
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
p AS (SELECT conv_id, turn, CASE role WHEN 'user' THEN 'system' WHEN 'assistant' THEN 'user' END AS _expected_parent,
  CASE role WHEN 'user' THEN s WHEN 'assistant' THEN coalesce(u, s) END AS parent FROM t)
SELECT p.conv_id, p.turn, p._expected_parent, c.role AS _parent_reg FROM p
 LEFT JOIN conversations c ON c.conv_id = p.conv_id AND c.turn = p.parent
 WHERE p._expected_parent IS NOT NULL AND p._expected_parent IS DISTINCT FROM c.role"""


def header_propagation(spark, sf):
    """Length of the first user turn of a conversation on each of its turns."""
    turns = _turns(spark, sf)
    heads = header_of_files(turns, {"head_len": F.col("n")}, file_col="_source_file", root="user")
    out = propagate_header(turns, heads, file_col="_source_file")
    return out.select(F.col("_source_file").alias("conv_id"), F.col("_row_id").alias("turn"), "head_len")


HEADER_SQL = """SELECT c.conv_id, c.turn, h.head_len FROM conversations c LEFT JOIN (
 SELECT conv_id, CAST(arg_min(length(text), turn) AS INTEGER) AS head_len FROM conversations WHERE role='user' GROUP BY 1) h USING (conv_id)"""


def superset_union(spark, sf):
    """All record types in one wide table from one pass over the lines."""
    wide = project_superset(parse_records(record_lines(spark, sf)), CATALOGUE)
    return wide.select(F.col("_file_id").alias("file"), "REG", "CNPJ", "NOME", "UF", "NUM_DOC", "COD_SIT", "DT_DOC",
                       "NUM_ITEM", "COD_ITEM", "QTD", "CST", "CFOP")


SUPERSET_SQL = """SELECT CAST(c_custkey AS VARCHAR) AS file, '0000' AS "REG", lpad(CAST(c_custkey AS VARCHAR),14,'0') AS "CNPJ", c_name AS "NOME",
 CAST(c_nationkey AS VARCHAR) AS "UF", NULL::VARCHAR AS "NUM_DOC", NULL::VARCHAR AS "COD_SIT", NULL::VARCHAR AS "DT_DOC",
 NULL::VARCHAR AS "NUM_ITEM", NULL::VARCHAR AS "COD_ITEM", NULL::VARCHAR AS "QTD", NULL::VARCHAR AS "CST", NULL::VARCHAR AS "CFOP" FROM customer
UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'C100', NULL, NULL, NULL, CAST(o_orderkey AS VARCHAR), o_orderstatus,
 strftime(o_orderdate, '%d%m%Y'), NULL, NULL, NULL, NULL, NULL FROM orders
UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'C170', NULL, NULL, NULL, NULL, NULL, NULL, CAST(l_linenumber AS VARCHAR),
 CAST(l_partkey AS VARCHAR), CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), l_returnflag, l_linestatus
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def br_decimals(spark, sf):
    """Amounts formatted as Brazilian text and parsed back."""
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                               fx.br_decimal(br_text(F.col("l_extendedprice"))).alias("price"),
                                               fx.br_decimal(F.col("l_returnflag")).alias("not_a_number"))


BR_SQL = "SELECT l_orderkey, l_linenumber, l_extendedprice AS price, CAST(NULL AS DOUBLE) AS not_a_number FROM lineitem"


def identity_scalars(spark, sf):
    """Company root and its errors, header period, partition-key check, masks, split period."""
    o = table(spark, sf, "orders")
    raw = F.concat(F.lpad(F.col("o_custkey").cast("string"), 8, "0"),
                   F.when(F.col("o_orderstatus") == "F", "/0001-99").when(F.col("o_orderstatus") == "O", "").otherwise("77"))
    start = F.when(F.col("o_orderpriority") == "5-LOW", "0101").otherwise(F.date_format("o_orderdate", "ddMMyyyy"))
    d = o.select("o_orderkey", raw.alias("raw"), start.alias("start"), F.lpad(F.col("o_custkey").cast("string"), 14, "0").alias("full"))
    root, period = fx.cnpj_root("raw"), fx.period_of_header("start")
    split = fx.split_period(period)
    return d.select("o_orderkey", root.alias("root"), fx.cnpj_root_error("raw").alias("error"), period.alias("period"),
                    F.coalesce(fx.valid_partition_key(root, period), F.lit(False)).alias("ok"),
                    split["year"].alias("y"), split["month"].alias("m"), fx.mask_cnpj("full").alias("mask"),
                    fx.year_of_period("start").alias("yr"))


IDENTITY_SQL = """WITH d AS (SELECT o_orderkey, lpad(CAST(o_custkey AS VARCHAR),8,'0') AS c8, lpad(CAST(o_custkey AS VARCHAR),14,'0') AS f,
  CASE o_orderstatus WHEN 'F' THEN '/0001-99' WHEN 'O' THEN '' ELSE '77' END AS tail, o_orderstatus AS s,
  CASE WHEN o_orderpriority='5-LOW' THEN '0101' ELSE strftime(o_orderdate,'%d%m%Y') END AS st FROM orders)
SELECT o_orderkey, CASE WHEN s <> 'P' THEN c8 END AS root, CASE WHEN s = 'P' THEN 'invalid CNPJ: ' || c8 || tail END AS error,
 CASE WHEN length(st) >= 8 THEN substr(st,5,4) || substr(st,3,2) ELSE '' END AS period, (s <> 'P' AND length(st) >= 8) AS ok,
 CASE WHEN length(st) >= 8 THEN CAST(substr(st,5,4) AS INTEGER) END AS y, CASE WHEN length(st) >= 8 THEN CAST(substr(st,3,2) AS INTEGER) END AS m,
 substr(f,1,2)||'.'||substr(f,3,3)||'.'||substr(f,6,3)||'/'||substr(f,9,4)||'-'||substr(f,13,2) AS mask,
 CASE WHEN length(st)=8 THEN substr(st,5,4) ELSE st END AS yr FROM d"""


def code_labels(spark, sf):
    """Document status and regime labels; unknown codes give NULL."""
    code = F.when(F.col("o_orderstatus") == "F", "00").when(F.col("o_orderstatus") == "O", "02").otherwise("77")
    reg = F.when(F.col("o_orderpriority") == "1-URGENT", "RRRR").when(F.col("o_orderpriority") == "2-HIGH", "P").otherwise("X")
    return table(spark, sf, "orders").select("o_orderkey", fx.label(code, DOCUMENT_STATUS).alias("status"),
                                             fx.is_cancelled(code).alias("cancelled"), fx.label(reg, TAX_REGIMES).alias("regime"))


LABEL_SQL = """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '00 - DOCUMENTO REGULAR' WHEN 'O' THEN '02 - DOCUMENTO CANCELADO' END AS status,
 o_orderstatus = 'O' AS cancelled, CASE o_orderpriority WHEN '1-URGENT' THEN 'Lucro Real' WHEN '2-HIGH' THEN 'Lucro Presumido' END AS regime FROM orders"""

_FOLDERS = ["EFD Contribuições", "efd_fiscal", "ECD", "ecf", "outros"]
_NAMES = ["SPEDECF-", "LECD_", "PISCOFINS_", "doc_"]


def _file_paths(spark, sf):
    o = table(spark, sf, "orders")
    folder = F.get(F.array(*[F.lit(x) for x in _FOLDERS]), (F.col("o_orderkey") % 5).cast("int"))
    name = F.get(F.array(*[F.lit(x) for x in _NAMES]), (F.col("o_orderkey") % 4).cast("int"))
    header = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("|0000|LECF|"), F.col("o_custkey").cast("string"), F.lit("|"))) \
        .when(F.col("o_orderkey") % 3 == 1, F.lit("|0000|" + "x|" * 13)).otherwise(F.lit("|0000|" + "x|" * 14))
    path = F.concat(F.lit("s3a://b/TO_CONVERT/"), F.lpad(F.col("o_custkey").cast("string"), 8, "0"), F.lit("/"), folder, F.lit("/"),
                    F.date_format("o_orderdate", "yyyyMM"), F.lit("/"), name, F.col("o_orderkey").cast("string"), F.lit(".txt"))
    return o.select("o_orderkey", path.alias("path"), header.alias("header"))


def classify_files(spark, sf):
    """Return type by name, folders and header line; path fields; known-path test."""
    return _file_paths(spark, sf).select(
        "o_orderkey", fx.return_type_fast("path").alias("fast"), fx.return_type("path", "header").alias("full"),
        fx.is_known_path("path").alias("known"), fx.path_cnpj("path").alias("cnpj"), fx.path_period("path").alias("period"),
        fx.file_name("path").alias("name"), fx.path_from_marker("path").alias("rel"))


_CLASSIFY = """WITH d AS (SELECT o_orderkey AS k, o_orderkey % 5 AS f, o_orderkey % 4 AS n, o_orderkey % 3 AS h, o_custkey, o_orderdate,
  lpad(CAST(o_custkey AS VARCHAR),8,'0') AS cnpj, strftime(o_orderdate,'%Y%m') AS period,
  CASE o_orderkey % 4 WHEN 0 THEN 'SPEDECF-' WHEN 1 THEN 'LECD_' WHEN 2 THEN 'PISCOFINS_' ELSE 'doc_' END || CAST(o_orderkey AS VARCHAR) || '.txt' AS name,
  CASE o_orderkey % 5 WHEN 0 THEN 'EFD Contribuições' WHEN 1 THEN 'efd_fiscal' WHEN 2 THEN 'ECD' WHEN 3 THEN 'ecf' ELSE 'outros' END AS folder FROM orders)"""
CLASSIFY_SQL = _CLASSIFY + """ SELECT k AS o_orderkey,
 CASE n WHEN 0 THEN 'ECF' WHEN 1 THEN 'ECD' WHEN 2 THEN 'EFD_CONTRIB' ELSE CASE f WHEN 0 THEN 'EFD_CONTRIB' WHEN 1 THEN 'EFD_FISCAL' WHEN 2 THEN 'ECD' WHEN 3 THEN 'ECF' END END AS "fast",
 CASE WHEN n = 2 THEN 'EFD_CONTRIB' WHEN n = 1 THEN 'ECD' ELSE CASE f WHEN 0 THEN 'EFD_CONTRIB' WHEN 1 THEN 'EFD_FISCAL' WHEN 2 THEN 'ECD' WHEN 3 THEN 'ECF'
   ELSE CASE h WHEN 0 THEN 'ECF' WHEN 1 THEN 'EFD_CONTRIB' ELSE 'EFD_FISCAL' END END END AS "full",
 f <> 4 AS known, cnpj, period, name, 'TO_CONVERT/' || cnpj || '/' || folder || '/' || period || '/' || name AS rel FROM d"""


def discover(spark, sf):
    """Companies and periods found in stored paths, up to a year."""
    return discover_periods(_file_paths(spark, sf), "path", r"TO_CONVERT/(\d+)/[^/]+/(\d{6})/", upper_year=1999)


DISCOVER_SQL = """SELECT DISTINCT lpad(CAST(o_custkey AS VARCHAR),8,'0') AS cnpj, strftime(o_orderdate,'%Y%m') AS period FROM orders
 WHERE year(o_orderdate) <= 1999"""


def latest_versions(spark, sf):
    """Rows of the latest version per user and day: highest type, then highest file id; ties kept."""
    e = table(spark, sf, "events").select("event_id", F.col("user_id").alias("CNPJ"), F.to_date("ts").cast("string").alias("DT_INI"),
                                          F.nullif("event_type", F.lit("view")).alias("IND_REC"), (F.col("event_id") % 7).alias("FILE_ID"))
    return latest_version(e)


LATEST_SQL = """WITH e AS (SELECT event_id, user_id AS "CNPJ", strftime(ts,'%Y-%m-%d') AS "DT_INI", nullif(event_type,'view') AS "IND_REC", event_id % 7 AS "FILE_ID" FROM events)
SELECT event_id, "CNPJ", "DT_INI", "IND_REC", "FILE_ID" FROM (SELECT *, dense_rank() OVER (PARTITION BY "CNPJ","DT_INI" ORDER BY "IND_REC" DESC NULLS LAST, "FILE_ID" DESC) AS r FROM e) WHERE r = 1"""


def amended_names(spark, sf):
    """Amended files replace the originals of the same name key; other names stay."""
    o = table(spark, sf, "orders")
    kind = F.when(F.col("o_orderstatus") == "F", "Retificadora").when(F.col("o_orderstatus") == "O", "Original").otherwise("x")
    day = F.date_format(F.trunc("o_orderdate", "year"), "ddMMyyyy")
    name = F.concat(F.lit("a/EFD_"), day, F.lit("_"), day, F.lit("_"), F.lpad(F.col("o_custkey").cast("string"), 14, "0"), F.lit("_"),
                    kind, F.lit("_"), F.col("o_orderkey").cast("string"), F.lit(".txt"))
    return resolve_amended_names(o.select("o_orderkey", name.alias("file_path"))).select("o_orderkey")


AMENDED_SQL = """WITH a AS (SELECT o_orderkey, o_orderstatus AS s, max(CASE WHEN o_orderstatus='F' THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey, year(o_orderdate)) AS has FROM orders)
SELECT o_orderkey FROM a WHERE s = 'P' OR s = 'F' OR has = 0"""


def amended_headers(spark, sf):
    """One file per company and period by header content: amended first, then the newest name."""
    o = table(spark, sf, "orders")
    return resolve_amended_headers(o.select(
        "o_orderkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("cnpj"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.year("o_orderdate")).alias("dt_ini"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.lit("31")).alias("dt_fin"),
        F.when(F.col("o_orderstatus") == "F", " s ").otherwise("N").alias("retificadora"),
        F.concat(F.lit("x/SPEDECF-1-"), F.date_format("o_orderdate", "yyyyMMdd"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"),
                 F.lit(".txt")).alias("file_path"))).select("o_orderkey")


AMENDED_HEADER_SQL = """SELECT o_orderkey FROM orders WHERE o_orderpriority = '5-LOW' UNION ALL
SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey, year(o_orderdate)
  ORDER BY (o_orderstatus='F') DESC, strftime(o_orderdate,'%Y%m%d') DESC, o_orderkey DESC) AS r FROM orders WHERE o_orderpriority <> '5-LOW') WHERE r = 1"""


_DEEP = catalogue_from_mapping({"0000": "CNPJ NOME", "0150": "COD_PART PARTICIPANTE SEGMENTO", "C100": "NUM_DOC COD_SIT DT_DOC", "C170": "NUM_ITEM COD_ITEM"})
_DEEP_RULES = [{"parent": "0000", "children": ["0150"]}, {"parent": "0150", "children": ["C100"]}, {"parent": "C100", "children": ["C170"]}]
_INHERITED = {
    "0150": {"from": "0000", "fields": ["NOME"]},
    "C100": [{"from": "0150", "fields": ["COD_PART", "SEGMENTO"]}, {"from": "0000", "fields": [{"NOME": "EMITENTE"}]}],
    "C170": [{"from": "C100", "fields": ["NUM_DOC", {"DT_DOC": "DT_NOTA"}]}, {"from": "0150", "fields": ["PARTICIPANTE"]}, {"from": "0000", "fields": ["CNPJ"]}],
}


def _deep_lines(spark, sf):
    """A file per nation: header, its customers, each with its orders, each with its items. Files are few and large."""
    nations, customers, orders = (table(spark, sf, n) for n in ("nation", "customer", "orders"))
    at = lambda cust, order=None, item=0: (F.col(cust) + 1) * (1 << 40) + ((F.col(order) + 1) * 16 if order else 0) + item
    docs = orders.join(customers.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    items = table(spark, sf, "lineitem").join(docs, F.col("l_orderkey") == F.col("o_orderkey"))
    parts = [
        nations.select(F.col("n_nationkey").alias("f"), F.lit(0).cast("long").alias("_row_id"), pipe(F.lit("0000"), F.lpad(F.col("n_nationkey").cast("string"), 14, "0"), F.col("n_name")).alias("value")),
        customers.select("c_nationkey", at("c_custkey"), pipe(F.lit("0150"), F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment"))),
        docs.select("c_nationkey", at("c_custkey", "o_orderkey"), pipe(F.lit("C100"), F.col("o_orderkey"), F.col("o_orderstatus"), F.date_format("o_orderdate", "ddMMyyyy"))),
        items.select("c_nationkey", at("c_custkey", "o_orderkey", F.col("l_linenumber")), pipe(F.lit("C170"), F.col("l_linenumber"), F.col("l_partkey"))),
    ]
    return reduce(DataFrame.union, parts).select(F.col("f").cast("string").alias("_source_file"), "_row_id", "value")


def inherited_map(spark, sf):
    """Four levels of lines; each takes fields of its parent, grandparent and header, by a map."""
    bronze = stored(tag_records(_deep_lines(spark, sf)), "deep")
    brings = handed_down(_INHERITED, _DEEP, F.split("value", r"\|"))
    carried = stored(chunk_carries(bronze, _DEEP_RULES, brings=brings), "carried")
    linked = link_parents(bronze, _DEEP_RULES, path_col="_ancestors", brings=brings, carried=carried)
    wide = project_superset(with_cols(linked), _DEEP)
    out = inherit_by_map(wide, with_cols(bronze), _INHERITED, _DEEP, path_col="_ancestors")
    return out.select(F.col("_source_file").cast("long").alias("file"), F.col("_row_id").alias("line"), "REG", F.size("_ancestors").alias("levels"),
                      F.array_join(F.transform("_ancestors", lambda a: F.concat(a["reg"], F.lit(":"), a["id"])), " ").alias("path"),
                      "CNPJ", "NOME", "EMITENTE", "COD_PART", "PARTICIPANTE", "SEGMENTO", "NUM_DOC", "COD_SIT", "DT_NOTA", "COD_ITEM")


INHERITED_SQL = """WITH h AS (SELECT n_nationkey AS n, lpad(CAST(n_nationkey AS VARCHAR),14,'0') AS cnpj, n_name FROM nation),
c AS (SELECT c_nationkey AS n, (c_custkey + 1) * 1099511627776 AS line, c_custkey, c_name, c_mktsegment AS seg FROM customer),
o AS (SELECT n, line + (o_orderkey + 1) * 16 AS line, line AS up, CAST(c_custkey AS VARCHAR) AS part, c_name, seg, o_orderkey, CAST(o_orderkey AS VARCHAR) AS doc, o_orderstatus AS sit,
  strftime(o_orderdate, '%d%m%Y') AS dt FROM orders JOIN c ON c_custkey = o_custkey)
SELECT n AS file, 0::BIGINT AS line, '0000' AS "REG", 0 AS levels, '' AS path, cnpj AS "CNPJ", n_name AS "NOME", NULL::VARCHAR AS "EMITENTE", NULL::VARCHAR AS "COD_PART", NULL::VARCHAR AS "PARTICIPANTE",
  NULL::VARCHAR AS "SEGMENTO", NULL::VARCHAR AS "NUM_DOC", NULL::VARCHAR AS "COD_SIT", NULL::VARCHAR AS "DT_NOTA", NULL::VARCHAR AS "COD_ITEM" FROM h
UNION ALL SELECT n, line, '0150', 1, '0000:0', NULL, n_name, NULL, CAST(c_custkey AS VARCHAR), c_name, seg, NULL, NULL, NULL, NULL FROM c JOIN h USING (n)
UNION ALL SELECT n, line, 'C100', 2, '0150:' || up || ' 0000:0', NULL, NULL, n_name, part, NULL, seg, doc, sit, NULL, NULL FROM o JOIN h USING (n)
UNION ALL SELECT n, line + l_linenumber, 'C170', 3, 'C100:' || line || ' 0150:' || up || ' 0000:0', cnpj, NULL, NULL, NULL, c_name, NULL, doc, NULL, dt, CAST(l_partkey AS VARCHAR)
  FROM lineitem JOIN o ON l_orderkey = o_orderkey JOIN h USING (n)"""


def column_policies(spark, sf):
    """Listed columns first (missing ones as NULL), then the others."""
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return order_columns(s, ["s_name", "MISSING"], "listed_then_rest")


POLICY_SQL = 'SELECT s_name, CAST(NULL AS VARCHAR) AS "MISSING", s_suppkey, s_nationkey FROM supplier'

QUERIES = {
    "parse_records": (parse_lines, PARSE_SQL), "text_files": (text_files, TEXT_SQL), "line_numbers": (line_numbers, LINE_NO_SQL),
    "record_tree": (record_tree, TREE_SQL), "record_tree_fiscal": (record_tree_fiscal, TREE_FISCAL_SQL),
    "misplaced_lines": (misplaced, MISPLACED_SQL), "header_propagation": (header_propagation, HEADER_SQL),
    "superset_union": (superset_union, SUPERSET_SQL), "br_decimal": (br_decimals, BR_SQL),
    "identity_scalars": (identity_scalars, IDENTITY_SQL), "code_labels": (code_labels, LABEL_SQL),
    "classify_files": (classify_files, CLASSIFY_SQL), "discover_periods": (discover, DISCOVER_SQL),
    "latest_version": (latest_versions, LATEST_SQL), "amended_by_name": (amended_names, AMENDED_SQL),
    "amended_by_header": (amended_headers, AMENDED_HEADER_SQL), "column_policies": (column_policies, POLICY_SQL),
    "inherited_map": (inherited_map, INHERITED_SQL),
}

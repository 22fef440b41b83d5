"""Compile a report specification to one DataFrame plan.

Record types come as ``{register: DataFrame | None}``. Names are resolved while the plan is
made, so the result has no ambiguous column. Line ids are compared together with the file
id: an id alone is only unique inside a file.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalgrove.catalog import ContractError
from fiscalgrove.operators.columns import (
    empty_frame, field_pairs, file_column, order_columns, select_fields, typed_null, void_to_string)
from fiscalgrove.operators.lookup import enrich, lookup
from fiscalgrove.plans.spec import (
    Entity, HierarchySpec, KeyedEntity, KeyedSpec, check_document_union, check_output, report_kind)

Registers = Mapping[str, DataFrame | None]
METADATA = ("FILE_ID", "CNPJ", "NOME", "DT_INI", "OBRIG_ACESS")
PARTITION_KEYS = ("cnpj_8_digits", "month_year")


def carried(df: DataFrame, names) -> list[str]:
    """The partition keys that a source has and its fields do not name."""
    return [k for k in PARTITION_KEYS if k in df.columns and k not in names]


def ordered(df: DataFrame, listed, policy: str) -> DataFrame:
    """Ordered by the listed columns; partition keys stay whatever the policy."""
    return order_columns(df, [*listed, *carried(df, listed)], policy) if listed else df


def _id_type(sources) -> str:
    """Line ids are compared as longs; as text only where some source has other ids."""
    for df in sources:
        kinds = {} if df is None else {f.name: f.dataType for f in df.schema.fields}
        for name in ("_row_id", "_parent_uid_final"):
            if name in kinds and not isinstance(kinds[name], (T.LongType, T.IntegerType)):
                return "string"
    return "long"


def _entity_frame(spark: SparkSession, entity: Entity, source: DataFrame | None, id_type: str) -> DataFrame:
    """Business fields, metadata, and the link columns ``_file, _id, _parent``."""
    if source is None:
        fields = {a: "string" for _, a in entity.fields}
        return empty_frame(spark, {**fields, "_file": "string", "_id": id_type, "_parent": id_type})
    if "_row_id" not in source.columns:
        raise ContractError(f"{entity.name}: no _row_id column")
    names = [a for _, a in entity.fields]
    meta = [c for c in (*METADATA, *PARTITION_KEYS) if c in source.columns and c not in names]
    parent = F.col("_parent_uid_final") if "_parent_uid_final" in source.columns else typed_null()
    file_col = file_column(source)
    return select_fields(source, entity.fields, absent_null=False, keep=[
        (F.col(file_col) if file_col else F.lit("")).cast("string").alias("_file"),
        F.col("_row_id").cast(id_type).alias("_id"), parent.cast(id_type).alias("_parent"),
        *[F.col(c) for c in meta]])


def _business(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith("_")]


def compile_hierarchy(spark: SparkSession, config: Mapping, registers: Registers) -> DataFrame:
    """Leaf rows with the fields of their ancestors and of lateral children.

    Left joins from the leaf to unique ancestors are associative, so the ancestors are joined
    among themselves first, from the top down, and the leaf, by far the largest frame, is
    shuffled once instead of once per level. On equal names the lower level wins. Lateral
    children multiply rows; one whose ancestor is not in the report gives NULL columns. The leaf's
    record type and line id come last as ``REG`` and ``row_id``.
    """
    spec = HierarchySpec.parse(config)
    id_type = _id_type(registers.get(e.source) for e in spec.entities.values())
    frames = {n: _entity_frame(spark, e, registers.get(e.source), id_type) for n, e in spec.entities.items()}
    shown: dict[str, str] = {}   # output column -> the entity it comes from
    for n in [spec.grain, *spec.chain]:
        for c in _business(frames[n]):
            shown.setdefault(c, n)

    def own(n: str) -> DataFrame:
        df = frames[n]
        links = [F.col("_file").alias("_file"), F.col("_id").alias(f"_id_{n}"), F.col("_parent").alias(f"_up_{n}")]
        return df.select(*links, *[c for c in _business(df) if shown.get(c) == n])

    above: DataFrame | None = None
    upper: str | None = None
    for n in reversed([spec.grain, *spec.chain]):
        level = own(n)
        if above is not None:
            right = above.withColumnRenamed("_file", "_r_file")
            hit = (F.col("_file") == F.col("_r_file")) & (F.col(f"_up_{n}") == F.col(f"_id_{upper}"))
            above = level.join(right, hit, "left").drop("_r_file")
        else:
            above = level
        upper = n
    out = above

    reach = {spec.grain, *spec.chain}
    for n in spec.laterals:
        side, parent = frames[n], spec.entities[n].parent
        new = [c for c in _business(side) if c not in out.columns]
        if parent not in reach:
            out = out.withColumns({c: typed_null() for c in new}) if new else out
            continue
        right = side.select(F.col("_file").alias("_l_file"), F.col("_parent").alias("_l_up"),
                            F.col("_id").alias(f"_id_{n}"), *new)
        hit = (F.col("_file") == F.col("_l_file")) & (F.col(f"_id_{parent}") == F.col("_l_up"))
        out = out.join(right, hit, "left").drop("_l_file", "_l_up")
        reach.add(n)
    order = list(shown) + [c for c in _business(out) if c not in shown]
    line = [] if "row_id" in order else [F.col(f"_id_{spec.grain}").cast("string").alias("row_id")]
    kind = [] if "REG" in order else [F.lit(spec.entities[spec.grain].source).alias("REG")]
    final = out.select(*[c for c in order if c in out.columns], *kind, *line)
    listed = config.get("output_columns")
    return ordered(final, listed, config.get("column_policy", "keep_rest"))


def compile_keyed(spark: SparkSession, config: Mapping, registers: Registers) -> DataFrame | None:
    """Base entity joined with the others by declared keys; the root comes last."""
    names = [str(c.get("source")) for c in (config.get("entities") or {}).values()]
    spec = KeyedSpec.parse(config, {n: registers[n].columns for n in names if registers.get(n) is not None})
    if registers.get(spec.base.source) is None:
        return None

    def frame(e: KeyedEntity) -> DataFrame:
        df = registers[e.source]
        ids = [F.col(c).alias(f"{e.name}_{kind}") for c, kind in ((e.uid, "UID"), (e.parent_uid, "PARENT_UID")) if c]
        file = file_column(df)
        keys = carried(df, [a for _, a in e.fields]) if e is spec.base else []
        return select_fields(df, e.fields, keep=[*ids, *([F.col(file).cast("string").alias("_k_file")] if file else []), *keys])

    out = frame(spec.base)
    for e in (e for e in spec.others if registers.get(e.source) is not None):
        right = frame(e)
        odd = [(le, r) for le, r in e.keys if le not in out.columns or r not in right.columns]
        if odd:
            raise ContractError(f"{spec.name}: {e.name}: keys {odd} not available")
        # a line id counts inside its file only
        by_line = any(k.endswith("UID") for pair in e.keys for k in pair)
        pairs = [(F.col(le).cast("string"), r) for le, r in e.keys]
        if by_line and "_k_file" in out.columns and "_k_file" in right.columns:
            pairs.append((F.col("_k_file"), "_k_file"))
        met = {r for _, r in pairs}
        fresh = [c for c in right.columns if c not in out.columns and c not in met]
        slots = [F.col(r).cast("string").alias(f"_k{i}") for i, (_, r) in enumerate(pairs)]
        hit = reduce(lambda a, b: a & b, [le == F.col(f"_k{i}") for i, (le, _) in enumerate(pairs)])
        out = out.join(right.select(*slots, *fresh), hit, e.how).drop(*[f"_k{i}" for i in range(len(pairs))])
    out = out.drop("_k_file")
    listed = (config.get(f"reorder_columns_{config.get('name')}") or {}).get("fields") or config.get("output_columns")
    if listed:
        out = out.select(*[c for c in [*listed, *carried(out, listed)] if c in out.columns])
    check_output(out.columns, ["FILE_ID"], config.get("name", "report"))
    return out


def compile_source_union(spark: SparkSession, config: Mapping, registers: Registers) -> DataFrame | None:
    """Each source enriched and mapped to the declared schema, then united."""
    schema, parts = list(config.get("output_schema") or []), []
    for cfg in (config.get("sources") or {}).values():
        df = registers.get(str(cfg["root"]))
        if df is None:
            continue
        for e in cfg.get("enrichments") or []:
            within = e.get("within")
            if within is None and e.get("strategy") in ("parent_ref", "child_agg"):
                file_col = file_column(df)
                right = registers.get(str(e["register"]))
                within = file_col if right is not None and file_col in right.columns else None
            df = enrich(df, registers.get(str(e["register"])), strategy=e["strategy"], key=e.get("key") or {},
                        fields=e.get("fields") or [], join_type=e.get("join_type", cfg.get("join_type", "left")),
                        agg=e.get("agg", "first"), within=within)
        mapping = cfg.get("field_mapping") or {}
        mapped = select_fields(df, [mapping], keep=[F.lit(cfg.get("doc_type")).cast("string").alias("DOC_TYPE"),
                                                    *carried(df, [a for _, a in field_pairs([mapping])])])
        target = schema if "DOC_TYPE" in schema else ["DOC_TYPE", *schema]
        parts.append(ordered(mapped, target, "only_listed"))
    if not parts:
        return None
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    check_output(out.columns, ["FILE_ID", "DOC_TYPE"], config.get("name", "report"))
    return out


def compile_document_union(spark: SparkSession, config: Mapping, registers: Registers) -> DataFrame:
    """Documents flattened with their children, united, enriched by lookups, ordered."""
    check_document_union(config)
    parts = [_document_block(spark, n, doc, registers) for n, doc in config["document_sources"].items()]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    out = void_to_string(out)
    for cfg in (config.get("enrichments") or {}).values():
        out = lookup(out, registers.get(str(cfg["source"])), cfg.get("join_keys") or [], cfg.get("fields") or [],
                     join_type=cfg.get("join_type", "left"), mode=cfg.get("join_mode", "simple"))
    listed = config.get("output_columns")
    out = ordered(out, listed, "listed_then_rest")
    check_output(out.columns, ["REG_TIPO", "FILE_ID"], config.get("name", "report"))
    return out


def _document_block(spark: SparkSession, name: str, doc: Mapping, registers: Registers) -> DataFrame:
    df = registers.get(str(doc.get("base") or doc.get("source")))
    pairs = field_pairs(doc.get("fields"))
    if "FILE_ID" not in [s for s, _ in pairs]:
        pairs = [("FILE_ID", "FILE_ID"), *pairs]
    if df is None:
        return empty_frame(spark, ["REG_TIPO", *[a for _, a in pairs]])
    for child in doc.get("children") or []:
        right = registers.get(str(child["source"]))
        if right is not None:
            df = _flatten(df, right, child["join_to"], child["join_on"])
    return select_fields(df, [{s: a} for s, a in pairs],
                         keep=[F.lit(doc.get("reg_type", name)).alias("REG_TIPO"), *carried(df, [a for _, a in pairs])])


def _flatten(base: DataFrame, child: DataFrame, join_to: str, join_on: str) -> DataFrame:
    """Base rows with their children's fields; the base wins on equal names."""
    file_col = file_column(base)
    within = file_col if file_col and file_col in child.columns and join_to.startswith("_") else None
    fresh = [c for c in child.columns if c not in base.columns and c not in (join_on, join_to)]
    right = child.select(F.col(join_on).alias("_c_key"), *([F.col(within).alias("_c_file")] if within else []), *fresh)
    hit = F.col(join_to) == F.col("_c_key")
    if within:
        hit = hit & (F.col(within) == F.col("_c_file"))
    return base.join(right, hit, "left").drop("_c_key", "_c_file")


COMPILERS = {
    "hierarchy": compile_hierarchy,
    "keyed": compile_keyed,
    "source_union": compile_source_union,
    "document_union": compile_document_union,
}


def compile_report(spark: SparkSession, config: Mapping, registers: Registers) -> DataFrame | None:
    """The DataFrame of a report of any kind."""
    return COMPILERS[report_kind(config)](spark, config, registers)

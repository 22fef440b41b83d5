"""Joins that add columns without adding rows, unless fan-out is what is asked for.

No side is force-broadcast: lookup tables are reduced to one row per key, and adaptive
execution broadcasts them if their measured size is small, or splits skewed partitions of
a sort-merge join if not. Left rows without a key are spread over the cluster, instead of
all meeting in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fiscalgrove.catalog import Catalogue, ContractError
from fiscalgrove.functions.scalars import code_map
from fiscalgrove.operators.columns import add_constants, field_pairs, require_columns, typed_null

#: line numbers that one chunk of rolled-up children spans
CHUNK_LINES = 100_000


def safe_join(left: DataFrame, right: DataFrame | None, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join on named keys; columns the left side has already are dropped from the right.

    An absent (None) right side leaves the left side as it is.
    """
    if right is None:
        return left
    clash = [c for c in right.columns if c in left.columns and c not in on]
    return left.join(right.drop(*clash), list(on), how)


def outer_consolidate(frames: Sequence[DataFrame | None], on: Sequence[str]) -> DataFrame | None:
    """Full outer join of metric frames on their keys; absent frames are skipped."""
    present = [f for f in frames if f is not None]
    if not present:
        return None
    return reduce(lambda a, b: safe_join(a, b, on, "outer"), present)


def one_per_key(df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``prefer`` columns, then by all others.

    A fixed choice, so that reruns agree; the reduction combines before it shuffles.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    ranked = [c for c in prefer if c in rest] + [c for c in rest if c not in prefer]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


IDENTITY = ("_source_file", "_file_id", "FILE_ID", "_row_id")


def spread_null(key: Column, columns: Sequence[str]) -> Column:
    """NULL keys replaced by values that match nothing, so that they do not pile up.

    The filler is hashed from the row's identity columns only, which keeps the scan narrow
    and the shuffle repeatable; a frame without them is left to adaptive skew handling.
    """
    by = [c for c in IDENTITY if c in columns]
    if not by:
        return key
    return F.coalesce(key, F.concat(F.lit("\u0000no key "), F.xxhash64(*by).cast("string")))


def own_shuffle(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows, keyed by expressions that hide how they are partitioned.

    Adaptive execution splits a hot key of a join only where both sides come straight from a
    shuffle. A side that was just aggregated on the join key would be joined as it lies there,
    and all rows of the hot key would stay in one task; veiling the key gives the (reduced)
    side a small shuffle of its own.
    """
    kinds = dict(df.dtypes)

    def veiled(k: str) -> Column:
        if kinds[k] == "string":
            return F.concat(F.col(k), F.lit(""))
        if kinds[k] in ("int", "bigint"):
            return F.col(k).bitwiseXOR(F.lit(0).cast(kinds[k]))
        return F.try_element_at(F.array(k), F.lit(1))   # any other type: the optimizer does not look through it

    return df.withColumns({k: veiled(k) for k in keys})


def ancestor(path: Column | str, reg: Column) -> Column:
    """The nearest ancestor of a record type in an ancestor path; NULL if there is none."""
    return F.try_element_at(F.filter(path, lambda a: a["reg"] == reg), F.lit(1))


def ancestor_id(path: Column | str, reg: Column) -> Column:
    """Row id of the nearest ancestor of a record type in an ancestor path; NULL if there is none."""
    return ancestor(path, reg)["id"]


def text_key(c: str) -> Column:
    return F.trim(F.col(c).cast("string"))


def inherit_fields(child: DataFrame, parent: DataFrame, fields: Sequence[str], *,
                   file_col: str = "_file_id", parent_link: str = "_parent_uid_final",
                   id_col: str = "_row_id") -> DataFrame:
    """Copy fields of the parent line to its child lines (within one file)."""
    require_columns(parent, [*fields, file_col, id_col], "parent record")
    source = parent.select(F.col(file_col).alias("_in_file"), F.col(id_col).alias("_in_id"),
                           *[f for f in fields if f not in child.columns])
    hit = (F.col(file_col) == F.col("_in_file")) & (F.col(parent_link) == F.col("_in_id"))
    return child.join(source, hit, "left").drop("_in_file", "_in_id")


def inheritance_rules(spec: Mapping[str, Mapping | Sequence[Mapping]], catalogue: Catalogue) -> dict[str, list[tuple[str, dict[str, str]]]]:
    """``{record type: {from, fields} or a list of these}`` -> record type -> [(ancestor type, {field of it: column})].

    Fields are names or ``{field: column}``. A field that the ancestor's layout does not have, and a column that the record
    type has itself or gets twice, are errors.
    """
    out: dict[str, list[tuple[str, dict[str, str]]]] = {}
    for reg, given in spec.items():
        own, taken = set(catalogue[reg].fields) if reg in catalogue else set(), set()
        for rule in [given] if isinstance(given, Mapping) else given:
            source, pairs = rule["from"], dict(field_pairs(rule["fields"]))
            if source not in catalogue:
                raise ContractError(f"{reg}: no layout of {source} to inherit from")
            unknown = sorted(set(pairs) - set(catalogue[source].fields))
            clash = sorted(c for c in pairs.values() if c in own or c in taken or list(pairs.values()).count(c) > 1)
            if unknown or clash:
                raise ContractError(f"{reg} from {source}: unknown fields {unknown}, columns it has already {clash}")
            taken.update(pairs.values())
            out.setdefault(reg, []).append((source, pairs))
    return out


def _value_of(name: str, registers: Sequence[str], catalogue: Catalogue, reg: Column, cols: Column) -> Column:
    return reduce(lambda at, r: at.when(reg == r, F.get(cols, F.lit(catalogue[r].positions()[name]))), registers, F)


def handed_down(spec: Mapping[str, Mapping | Sequence[Mapping]], catalogue: Catalogue, cols: Column | str = "cols", reg_col: str = "REG") -> Column:
    """What a line hands down by a map: record type and the fields that some type inherits from it, NULL for all other types.

    For ``tree.link_parents(brings=...)``; ``inherit_by_map`` then takes the fields from the paths.
    """
    sources: dict[str, set[str]] = {}
    for found in inheritance_rules(spec, catalogue).values():
        for source, pairs in found:
            sources.setdefault(source, set()).update(pairs)
    reg, cols = F.col(reg_col), F.col(cols) if isinstance(cols, str) else cols
    names = sorted({n for fields in sources.values() for n in fields})
    values = [_value_of(n, sorted(r for r in sources if n in sources[r]), catalogue, reg, cols).alias(n) for n in names]
    return F.when(reg.isin(sorted(sources)), F.struct(reg.alias("_reg"), *values))


def inherit_by_map(wide: DataFrame, lines: DataFrame, spec: Mapping[str, Mapping | Sequence[Mapping]], catalogue: Catalogue, *,
                   path_col: str, file_col: str = "_source_file", id_col: str = "_row_id") -> DataFrame:
    """Fill columns of descendants with fields of their nearest ancestor of the named type, over any number of levels.

    wide: named columns and the ancestor paths of ``tree.link_parents``. lines: the same lines with ``cols``; only the ancestors' rows
    and fields are read of them. Where the paths bring the fields along (``handed_down`` of the same map), nothing is joined or moved. Else
    record types that inherit from one type each need one join in all, types that inherit from
    k types k joins. A line without such an ancestor keeps NULL; one with several lines of the ancestor's id gets a row for each.
    """
    rules = inheritance_rules(spec, catalogue)
    if "rows" in wide.schema[path_col].dataType.elementType.names:
        return _inherit_brought(wide, rules, path_col)
    out = wide
    for now, needed, wanted in _turns(rules):
        names = sorted({n for fields in needed.values() for n in fields})
        values = [_value_of(n, sorted(r for r in needed if n in needed[r]), catalogue, F.col("REG"), F.col("cols")).alias(n) for n in names]
        ancestors = lines.filter(F.col("REG").isin(sorted(needed))).select(
            F.col(file_col).alias("_in_file"), F.col(id_col).cast("long").alias("_in_id"), F.struct(*values).alias("_in_row"))
        # a line that asks for nothing gets a key of its own that matches nothing, so such lines do not pile up
        key = F.coalesce(ancestor_id(path_col, wanted), -1 - F.col(id_col).cast("long"))
        joined = out.withColumn("_in_key", key).join(ancestors, (F.col(file_col) == F.col("_in_file")) & (F.col("_in_key") == F.col("_in_id")), "left")
        out = joined.withColumns(_inherited(now, out.columns, F.col("_in_row"))).drop("_in_key", "_in_file", "_in_id", "_in_row")
    return out


def _turns(rules: Mapping[str, list[tuple[str, dict[str, str]]]]) -> Iterator[tuple[dict, dict[str, set[str]], Column]]:
    """The n-th rule of each record type, the ancestor types and fields these need, and the type a line wants."""
    for turn in range(max(map(len, rules.values()), default=0)):
        now = {reg: found[turn] for reg, found in rules.items() if len(found) > turn}
        needed: dict[str, set[str]] = {}
        for source, pairs in now.values():
            needed.setdefault(source, set()).update(pairs)
        yield now, needed, F.try_element_at(code_map({reg: source for reg, (source, _) in now.items()}), F.col("REG"))


def _inherited(now: Mapping[str, tuple[str, dict[str, str]]], present: Iterable[str], row: Column) -> dict[str, Column]:
    columns: dict[str, Column] = {}
    for reg, (_, pairs) in sorted(now.items()):
        for field, column in pairs.items():
            before = columns.get(column, F.col(column) if column in present else typed_null())
            columns[column] = F.when(F.col("REG") == reg, row[field]).otherwise(before)
    return columns


def _inherit_brought(wide: DataFrame, rules: Mapping[str, list[tuple[str, dict[str, str]]]], path_col: str) -> DataFrame:
    """Fields out of the paths. Lines of one id that hand down are rows each, as in a join: one number per combination of them, which is one almost always."""
    turns, path = list(_turns(rules)), F.col(path_col)
    found, sizes = {}, []
    for i, (_, needed, wanted) in enumerate(turns):
        rows = F.get(path, (F.array_position(path["reg"], wanted) - 1).cast("int"))["rows"]
        # a single row is the ancestor's own
        found[f"_in_{i}"] = F.when(F.size(rows) > 1, F.filter(rows, lambda r: r["_reg"].isin(sorted(needed)))).otherwise(rows)
        sizes.append(F.greatest(F.coalesce(F.size(f"_in_{i}"), F.lit(1)), F.lit(1)))
    combinations = reduce(lambda a, b: a * b, sizes, F.lit(1))
    out = wide.withColumns(found).select("*", F.explode(F.sequence(F.lit(0), combinations - 1)).alias("_in_at"))
    for i, (now, _, _) in enumerate(turns):
        at = F.floor(F.col("_in_at") / reduce(lambda a, b: a * b, sizes[:i], F.lit(1))) % sizes[i]
        out = out.withColumns(_inherited(now, out.columns, F.get(f"_in_{i}", at.cast("int"))))
    return out.drop("_in_at", *found)


def roll_up_children(child: DataFrame, keys: str | Sequence[str], fields, how: str = "first",
                     order_by: Sequence[str] = ("_row_id",)) -> DataFrame:
    """One row per parent: first non-NULL value in line order, or all values as an array."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [c for c in order_by if c in child.columns]
    out = []
    for source, alias in field_pairs(fields):
        if source not in child.columns:
            continue
        value = F.col(source)
        if how == "collect_list":
            rows = F.sort_array(F.collect_list(F.when(value.isNotNull(), F.struct(*order, value.alias("_v")))))
            out.append(F.transform(rows, lambda r: r["_v"]).alias(alias))
        elif how == "first":
            rank = F.struct(*order, value.alias("_v"))
            out.append(F.min(F.when(value.isNotNull(), rank))["_v"].alias(alias))
        else:
            raise ContractError(f"unknown child aggregate {how!r}")
    return child.groupBy(*keys).agg(*out) if out else child.select(*keys).distinct()


def roll_up_chunks(child: DataFrame, keys: str | Sequence[str], fields, *, order_col: str = "_row_id", within: str | None = None,
                   lines: int = CHUNK_LINES) -> DataFrame:
    """All children as arrays, one row per parent and ``chunk``, so that no parent's array has to fit one task.

    A chunk is an interval of ``lines`` line numbers. Numbers are unique inside a file, so an array holds at most that many
    values whatever a parent has (equal numbers are ordered by value); ``within`` adds the file to the groups where the keys do not tell files apart. Arrays keep
    line order and leave out NULL values; put together in order of ``within`` and ``chunk`` they are the array of ``roll_up_children``.
    Chunk numbers ascend but skip intervals without children. Rows without a number are in a chunk of their own, NULL.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    place = [*keys, *([within] if within and within not in keys else [])]
    require_columns(child, [*place, order_col], "child record")
    if dict(child.dtypes)[order_col] not in ("bigint", "int", "smallint", "tinyint"):
        raise ContractError(f"{order_col} must be a whole number to cut chunks by")
    kept = [(source, alias) for source, alias in field_pairs(fields) if source in child.columns]
    if "chunk" in [*place, *(alias for _, alias in kept)]:
        raise ContractError("the name chunk is taken by a key or a field")
    rows = child.select(*place, F.floor(F.col(order_col) / F.lit(lines)).alias("chunk"),
                        *[F.when(F.col(source).isNotNull(), F.struct(F.col(order_col).alias("at"), F.col(source).alias("value"))).alias(f"_v{i}")
                          for i, (source, _) in enumerate(kept)])
    out = [F.transform(F.sort_array(F.collect_list(f"_v{i}")), lambda r: r["value"]).alias(alias) for i, (_, alias) in enumerate(kept)]
    return rows.groupBy(*place, "chunk").agg(*out) if out else rows.distinct()


def numbered_children(chunks: DataFrame, keys: str | Sequence[str], field: str, *, within: str | None = None) -> DataFrame:
    """One row per value of a rolled-up field, with its ``place`` (from 0) among all values of the parent.

    Only the sizes of chunks are summed up along a parent, one narrow row per chunk; the arrays stay where they are.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    files = [within] if within and within not in keys else []
    at = [*keys, *files, "chunk"]
    before = Window.partitionBy(*keys).orderBy(*files, "chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = chunks.select(*at, F.size(field).cast("long").alias("n")).select(
        *[F.col(c).alias(f"_s_{c}") for c in at], F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in at])
    return chunks.join(starts, same).select(*keys, "_start", F.posexplode(field).alias("_pos", field)).select(
        *keys, (F.col("_start") + F.col("_pos")).alias("place"), field)


def enrich(df: DataFrame, right: DataFrame | None, *, strategy: str, key: Mapping[str, str], fields,
           join_type: str = "left", agg: str = "first", within: str | None = None) -> DataFrame:
    """Join strategies ``file_ref``, ``parent_ref``, ``lookup_ref`` and ``child_agg``.

    ``within`` adds a second key (the file id) that must agree as well; line ids are only
    unique inside a file.
    """
    if right is None:
        return df
    left_key, right_key = key.get("from"), key.get("to")
    if not left_key or not right_key:
        raise ContractError(f"enrichment key needs from/to, got {dict(key)}")
    require_columns(df, [left_key, *([within] if within else [])], "left side")
    require_columns(right, [right_key, *([within] if within else [])], "right side")
    keys = [right_key] + ([within] if within and within != right_key else [])
    if strategy == "child_agg":
        source = roll_up_children(right, keys, fields, agg)
    elif strategy in ("file_ref", "parent_ref", "lookup_ref"):
        pairs = [(s, a) for s, a in field_pairs(fields) if a not in keys]
        source = right.select(*keys, *[F.col(s).alias(a) for s, a in pairs])
    else:
        raise ContractError(f"unknown enrichment strategy {strategy!r}")
    clash = [c for c in source.columns if c in df.columns and c not in keys]
    source = source.drop(*clash)
    source = own_shuffle(source.select(*[F.col(k).cast("string").alias(f"_en_{i}") for i, k in enumerate(keys)],
                                       *[c for c in source.columns if c not in keys]),
                         [f"_en_{i}" for i in range(len(keys))])
    hit = F.col(left_key).cast("string") == F.col("_en_0")
    if len(keys) > 1:
        hit = hit & (F.col(within).cast("string") == F.col("_en_1"))
    return df.join(source, hit, join_type).drop(*[f"_en_{i}" for i in range(len(keys))])


def key_pairs(join_keys: Sequence[str | Mapping[str, str]]) -> list[tuple[str, str]]:
    return field_pairs(join_keys)


def lookup(df: DataFrame, source: DataFrame | None, join_keys, fields, *, join_type: str = "left",
           mode: str = "simple") -> DataFrame:
    """Add a lookup's fields by trimmed text keys.

    ``simple``: all keys must agree. ``coalesce``: rows that a key leaves without a first
    field try the next one. The source is first reduced to one row per key that is compared (in
    mode ``coalesce`` per single key), so no row is added; an absent source gives NULL columns. Columns the left side has already are kept.
    """
    outputs = [a for _, a in field_pairs(fields)]
    fresh = [a for a in outputs if a not in df.columns]
    if source is None:
        return df.withColumns({a: typed_null() for a in fresh}) if fresh else df
    pairs = [(left, right) for left, right in key_pairs(join_keys) if left in df.columns]
    if not pairs or not fresh:
        return df
    right_keys = [right for _, right in key_pairs(join_keys)]
    cols = [text_key(k).alias(f"_lk_{i}") for i, k in enumerate(right_keys)]
    values = [(F.col(s) if s in source.columns else typed_null()).alias(a)
              for s, a in field_pairs(fields) if a in fresh]
    if mode == "coalesce" and len(pairs) > 1:
        return _first_match(df, source.select(*cols, *values), [(left, f"_lk_{right_keys.index(right)}") for left, right in pairs], fresh, join_type)
    slots_all = [f"_lk_{i}" for i in range(len(cols))]
    table = own_shuffle(one_per_key(source.select(*cols, *values), slots_all), slots_all)
    slot = {right: f"_lk_{i}" for i, right in enumerate(right_keys)}
    left_key = [spread_null(text_key(left), df.columns) for left, _ in pairs]
    slots = [slot[right] for _, right in pairs]

    hit = reduce(lambda a, b: a & b, [k == F.col(s) for k, s in zip(left_key, slots)])
    return df.join(table, hit, join_type).drop(*slot.values())


def _first_match(df: DataFrame, source: DataFrame, pairs: Sequence[tuple[str, str]], fields: Sequence[str], join_type: str) -> DataFrame:
    """Each key in turn, for rows that have no first field yet; one source row per single key."""
    out = df
    for i, (left, slot) in enumerate(pairs):
        rows = one_per_key(source.filter(F.col(slot).isNotNull()).select(slot, *[F.col(a).alias(f"_fb_{a}") for a in fields]), [slot])
        key = text_key(left) if i == 0 else F.when(F.col(fields[0]).isNull(), text_key(left))
        out = out.join(own_shuffle(rows, [slot]), spread_null(key, df.columns) == F.col(slot), join_type if i == 0 else "left")
        found = [F.col(f"_fb_{a}") if i == 0 else F.coalesce(F.col(a), F.col(f"_fb_{a}")) for a in fields]
        out = out.select(*df.columns, *[c.alias(a) for c, a in zip(found, fields)])
    return out


def code_lookup(df: DataFrame, codes: DataFrame, *, code: str, width: int = 4,
                fields: Sequence[str] = (), source_code: str | None = None) -> DataFrame:
    """Attributes of a numeric code, compared as zero-padded text; unknown codes give NULL."""
    padded = F.lpad(F.col(source_code or code).cast("string"), width, "0")
    table = own_shuffle(one_per_key(codes.select(padded.alias("_code"), *fields), ["_code"]), ["_code"])
    left = df.withColumn(code, F.lpad(F.col(code).cast("string"), width, "0"))
    key = spread_null(F.col(code), left.columns)
    return left.join(table, key == F.col("_code"), "left").drop("_code")


def asof_regime(df: DataFrame, regimes: DataFrame, *, root: Column, year: Column | None,
                out: str = "REGIME_TRIBUTARIO", missing: str = "NAO_LOCALIZADO") -> DataFrame:
    """Latest regime with ``ano <= year`` of a company root.

    The reference table becomes one short, year-ordered history per company, so the join is
    a plain N:1 equi join and no row is multiplied. Without a year the latest regime counts.
    """
    yearly = regimes.groupBy(F.col("cnpj").cast("string").alias("_root"), F.col("ano").cast("int").alias("_ano")) \
        .agg(F.max("regime").alias("_regime")).filter(F.col("_ano").isNotNull())
    history = own_shuffle(yearly.groupBy("_root").agg(
        F.sort_array(F.collect_list(F.struct("_ano", "_regime"))).alias("_history")), ["_root"])
    left = df.withColumns({"_lookup_root": root, "_year": (year if year is not None else F.lit(None)).cast("int")})
    key = spread_null(F.col("_lookup_root"), df.columns)
    joined = left.join(history, key == F.col("_root"), "left")
    usable = F.filter("_history", lambda h: F.col("_year").isNull() | (h["_ano"] <= F.col("_year")))
    found = F.try_element_at(usable, F.lit(-1))["_regime"]
    return joined.withColumn(out, F.coalesce(found, F.lit(missing))) \
        .drop("_lookup_root", "_year", "_root", "_history")


def stamp_regime(wide: DataFrame, regimes: DataFrame, *, source: str, company: str = "CNPJ", start: str = "DT_INI",
                 registers: Sequence[str] | None = None) -> DataFrame:
    """Regime of each line's company as of the year of its period, and where it was found (``REGIME_FONTE``).

    With ``registers`` only lines of these record types are stamped; the others have NULL in both columns.
    """
    root = F.substring(F.regexp_replace(company, r"\D", ""), 1, 8)
    stamped = asof_regime(wide, regimes, root=root, year=F.substring(start, 5, 4).try_cast("int"))
    stamped = add_constants(stamped, {"REGIME_FONTE": source}, registers)
    if registers is None:
        return stamped
    return stamped.withColumn("REGIME_TRIBUTARIO", F.when(F.col("REG").isin(sorted(registers)), F.col("REGIME_TRIBUTARIO")))

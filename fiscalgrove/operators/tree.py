"""Rebuild the parent/child tree of the lines of a file.

The parent of a line is the nearest earlier line of the parent record type its rule
names, else the nearest earlier root line. Written as one window per file this sorts
each file in a single task, which a very large file does not survive. Here a file is
cut into chunks of neighbouring lines:

* every line asks for its parent under the key ``(file, chunk, wanted type)``;
* every possible parent leaves a narrow *mark* under its own key, and a root line one
  under each key, as the fallback;
* a narrow pre-aggregation finds the last mark of each chunk, and a running maximum over
  the chunks of a file becomes one *carry* mark at the start of the next chunks;
* one running maximum over lines and marks gives the parent id.

The wide rows are shuffled once, and no group is larger than a chunk.

With ancestor paths, lines of parent types are their own marks: a group is a chunk, and one window per level of the
rules runs over it, from the root down, so that a line finds the whole path of its parent. What earlier chunks leave is put
together beforehand from the lines of parent types alone (``chunk_carries``) and is one row per chunk that needs it. Paths may bring fields of the ancestors
along, so wide rows are shuffled once for tree and inheritance together.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fiscalgrove.catalog import ContractError, parent_rules
from fiscalgrove.functions.scalars import code_map
from fiscalgrove.operators.lookup import own_shuffle
from fiscalgrove.sources.records import CHUNK_BITS


#: an ancestor path: record type and row id of the parent, its parent, and so on up to a root
PATH = "array<struct<reg:string,id:bigint>>"


def link_parents(df: DataFrame, rules: Iterable[Mapping], *, file_col: str = "_source_file",
                 id_col: str = "_row_id", reg_col: str = "REG", root: str = "0000",
                 chunk_bits: int = CHUNK_BITS, path_col: str | None = None, brings: Column | None = None,
                 carried: DataFrame | None = None) -> DataFrame:
    """Add ``_expected_parent`` (record type) and ``_parent_uid_final`` (row id), and with ``path_col``
    the line's ancestors from the parent up to a root (empty for a line without any).

    ``id_col`` is a non-negative long that follows line order inside a file; parents'
    ids are unique there. The input is scanned three times (twice on three columns
    only; with paths on the lines of parent types the second time), so pass a stored table or a checkpoint rather than a long plan.

    ``brings``, with paths: a struct of what a line hands down (``lookup.handed_down``), NULL for nothing. Each ancestor then has ``rows``,
    the structs of all lines with its id. ``carried``: the stored result of ``chunk_carries`` with the same arguments, which frees
    the shuffle files it took; left out, it is part of the plan.
    """
    rules = list(rules)
    parent_of, to_root = parent_rules(rules)
    wants = {**parent_of, **{reg: root for reg in to_root}}
    expected = F.try_element_at(code_map(parent_of), F.col(reg_col)) if parent_of \
        else F.lit(None).cast("string")
    if not wants:
        none = {path_col: F.array().cast(_path_kind(df, brings))} if path_col else {}
        return df.withColumns({"_expected_parent": F.lit(None).cast("string"),
                               "_parent_uid_final": F.lit(None).cast("long"), **none})
    if path_col:
        if carried is None:
            carried = chunk_carries(df, rules, file_col=file_col, id_col=id_col, reg_col=reg_col, root=root, chunk_bits=chunk_bits, brings=brings)
        linked = _link_with_paths(df, carried, wants, file_col, id_col, reg_col, root, chunk_bits, path_col, brings)
        return linked.withColumn("_expected_parent", expected)
    keys = sorted(set(wants.values()))
    key = ["_t_file", "_t_chunk", "_t_want"]

    reg, rid = F.col(reg_col), F.col(id_col).cast("long")
    want = F.try_element_at(code_map(wants), reg)
    chunk = F.shiftright(rid, chunk_bits)
    narrow = df.select(F.col(file_col).alias("_t_file"), rid.alias("_t_id"), reg.alias("_t_reg"))
    parents = narrow.filter(F.col("_t_reg").isin(sorted({*keys, root})))
    marks = (parents.select("_t_file", F.shiftright("_t_id", chunk_bits).alias("_t_chunk"), "_t_id",
                            F.inline(_marks(F.col("_t_reg"), F.col("_t_id"), "long", keys, root))))
    lines = df.select(F.col(file_col).alias("_t_file"), chunk.alias("_t_chunk"),
                      rid.alias("_t_id"), want.alias("_t_want"),
                      F.lit(None).cast("long").alias("_t_def"),
                      F.lit(None).cast("long").alias("_t_root"),
                      F.struct(*df.columns).alias("_t_line"))
    asked = narrow.select("_t_file", F.shiftright("_t_id", chunk_bits).alias("_t_chunk"), F.try_element_at(code_map(wants), "_t_reg").alias("_t_want"),
                          F.lit(None).cast("long").alias("_t_def"), F.lit(None).cast("long").alias("_t_root"))
    carried = _carry(asked.unionByName(marks.drop("_t_id")), chunk_bits)
    narrow_marks = marks.unionByName(carried).withColumn(
        "_t_line", F.lit(None).cast(lines.schema["_t_line"].dataType))

    # a line sorts before the mark it leaves itself: "strictly before" holds
    before = (Window.partitionBy(*key)
              .orderBy("_t_id", F.col("_t_line").isNull())
              .rowsBetween(Window.unboundedPreceding, -1))
    found = F.coalesce(F.max("_t_def").over(before), F.max("_t_root").over(before))
    linked = lines.unionByName(narrow_marks).withColumn("_t_found", found)
    out = linked.filter(F.col("_t_line").isNotNull()).select("_t_line.*", F.col("_t_found").alias("_parent_uid_final"))
    return out.withColumn("_expected_parent", expected)


def _marks(reg: Column, value: Column, kind: str, keys: list[str], root: str) -> Column:
    """Marks one line leaves: itself as a parent, and a root as everybody's fallback."""
    none = F.lit(None).cast(kind)

    def mark(k: Column, definite: Column, fallback: Column) -> Column:
        return F.struct(k.alias("_t_want"), definite.alias("_t_def"), fallback.alias("_t_root"))

    as_parent = F.array(mark(reg, value, none))
    as_root = F.array(*[mark(F.lit(k), value if k == root else none, value) for k in keys])
    return F.when(reg == root, as_root).otherwise(as_parent)


def _carry(left: DataFrame, chunk_bits: int) -> DataFrame:
    """One mark per (file, chunk, key) with the last parent and root of earlier chunks. ``left``: what lines of a chunk ask for and leave."""
    per_chunk = (
        left.filter(F.col("_t_want").isNotNull())
        .groupBy("_t_file", "_t_want", "_t_chunk")
        .agg(F.max("_t_def").alias("_t_def"), F.max("_t_root").alias("_t_root"))
    )
    earlier = Window.partitionBy("_t_file", "_t_want").orderBy("_t_chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    return (
        per_chunk.select(
            "_t_file", "_t_chunk", (F.shiftleft("_t_chunk", chunk_bits) - 1).alias("_t_id"),
            "_t_want", F.max("_t_def").over(earlier).alias("_t_def"),
            F.max("_t_root").over(earlier).alias("_t_root"))
        .filter(F.col("_t_def").isNotNull() | F.col("_t_root").isNotNull())
    )


def levels_above(rules: Iterable[Mapping], root: str = "0000") -> int:
    """Most ancestors that a line of a parent type can have. Types that are their own ancestors are an error: paths would have no end."""
    parent_of, to_root = parent_rules(rules)
    wants = {**parent_of, **{reg: root for reg in to_root}}
    deepest = 0
    for reg in set(wants.values()):
        seen = [reg]
        while (reg := wants.get(reg, root if reg != root else None)) is not None:
            if reg in seen:
                raise ContractError(f"parent rules go in a circle: {' < '.join([*seen, reg])}")
            seen.append(reg)
        deepest = max(deepest, len(seen) - 1)
    return deepest


def _levels(wants: Mapping[str, str], root: str) -> list[list[str]]:
    """Parent types, the ones without a parent type first, each behind the type it wants."""
    def depth(reg: str) -> int:
        return 1 + depth(wants[reg]) if reg in wants else 0

    kinds = {*wants.values(), root}
    return [sorted(k for k in kinds if depth(k) == d) for d in range(1 + max(map(depth, kinds)))]


def _path_kind(df: DataFrame, brings: Column | None) -> str:
    if brings is None:
        return PATH
    return f"array<struct<reg:string,id:bigint,rows:array<{df.select(brings.alias('r')).schema['r'].dataType.simpleString()}>>>"


def _carry_kind(slots: Mapping[str, str], kind: str) -> str:
    return f"struct<{','.join(f'{c}:struct<id:bigint,path:{kind}>' for c in slots.values())}>"


_NEAR = ("_t_file", "_t_chunk")


def _before() -> Window:
    """Lines of smaller ids in the chunk: lines that share an id are not before each other."""
    return Window.partitionBy(*_NEAR).orderBy("_t_id").rangeBetween(Window.unboundedPreceding, -1)


def _itself(brings: bool) -> Column:
    """A line as an ancestor in a path. Nothing is handed down where files or ids cannot be compared."""
    rows = [F.col("_t_rows").alias("rows")] if brings else []
    return F.array(F.struct(F.col("_t_reg").alias("reg"), F.col("_t_id").alias("id"), *rows))


def _numbered(found: Column) -> Column:
    """A parent without a row id ends a path: it is shown as the parent of lines, but has no place among the ancestors of parents."""
    return F.when(found["id"].isNotNull(), found)


def _same_id(own: Column) -> Column:
    """What all lines with the id of a line hand down."""
    comparable = F.col("_t_file").isNotNull() & F.col("_t_id").isNotNull()
    return F.collect_list(F.when(comparable, own)).over(Window.partitionBy(*_NEAR).orderBy("_t_id").rangeBetween(0, 0))


def chunk_carries(df: DataFrame, rules: Iterable[Mapping], *, file_col: str = "_source_file", id_col: str = "_row_id", reg_col: str = "REG",
                  root: str = "0000", chunk_bits: int = CHUNK_BITS, brings: Column | None = None) -> DataFrame:
    """What ``link_parents`` needs of earlier chunks for paths: for each chunk the last parents before it, with their own paths.

    Chunks of lines of parent types are summed up first; a path that leaves its chunk stays open there, and is closed as the sums of a
    file's chunks are run over in order. A chunk gets only those parents that one of its lines asks for before it has one of its own.
    """
    rules = list(rules)
    parent_of, to_root = parent_rules(rules)
    wants = {**parent_of, **{reg: root for reg in to_root}}
    levels_above(rules, root)
    levels, kind = _levels(wants, root), _path_kind(df, brings)
    kinds = [k for level in levels for k in level]
    slots = {k: f"c{i}" for i, k in enumerate(kinds)}
    reg, rid, want = F.col(reg_col), F.col(id_col).cast("long"), F.try_element_at(code_map(wants), F.col(reg_col))
    place = [F.col(file_col).alias("_t_file"), F.shiftright(rid, chunk_bits).alias("_t_chunk")]
    own = [] if brings is None else [F.when(reg.isNotNull(), brings).alias("_t_own")]
    by_lines = sorted({w for r, w in wants.items() if r not in slots})

    # lines of other types: the first line of a chunk that asks for each type
    asks = df.filter(want.isin(by_lines) & ~reg.isin(kinds) & rid.isNotNull()).groupBy(*place).agg(
        *[F.min(F.when(want == k, rid)).alias(f"_t_ask_{slots[k]}") for k in by_lines]) if by_lines else None
    each = df.filter(reg.isin(kinds)).select(*place, rid.alias("_t_id"), reg.alias("_t_reg"), *own)
    if asks is not None:
        each = each.unionByName(asks, allowMissingColumns=True)
    if own:
        each = each.withColumn("_t_rows", _same_id(F.col("_t_own"))).drop("_t_own")

    # inside a chunk: path so far, the type it is open for, the root it falls back to if there is none
    mark_kind = f"struct<id:bigint,path:{kind},open:string,fall:{kind}>"
    each = each.withColumns({"_t_up": F.lit(None).cast(mark_kind), "_t_fall": F.lit(None).cast(kind)})
    chained = F.col("_t_file").isNotNull() & F.col("_t_id").isNotNull()
    up, wanted = F.col("_t_up"), F.try_element_at(code_map(wants), F.col("_t_reg"))
    itself = _itself(brings is not None)
    mark = F.when(F.col("_t_reg").isNotNull(), F.struct(
        F.col("_t_id").alias("id"),
        F.when(chained & up.isNotNull(), F.concat(itself, up["path"])).otherwise(itself).cast(kind).alias("path"),
        F.when(chained, F.when(up.isNotNull(), up["open"]).otherwise(wanted)).alias("open"),
        F.when(up.isNotNull(), up["fall"]).otherwise(F.col("_t_fall")).alias("fall")))
    asked = {wants[k] for k in kinds if k in wants} | {root}
    for level in levels:
        now = [k for k in level if k in asked]
        if not now:
            continue
        each = each.withColumns({f"_t_{slots[k]}": F.last(F.when(F.col("_t_reg") == k, mark), ignorenulls=True).over(_before()) for k in now})
        updated = {"_t_up": reduce(lambda at, k: at.when(wanted == k, F.col(f"_t_{slots[k]}")), now, F).otherwise(up)}
        if root in now:
            updated["_t_fall"] = F.col(f"_t_{slots[root]}")["path"]
        each = each.withColumns(updated).drop(*[f"_t_{slots[k]}" for k in now])

    def first_ask(k: str) -> Column:
        by_parents = F.when(wanted == k, F.col("_t_id"))
        return F.min(F.coalesce(by_parents, F.col(f"_t_ask_{slots[k]}")) if k in by_lines else by_parents)

    sums = each.groupBy(*_NEAR).agg(
        *[F.max(F.when(F.col("_t_reg") == k, mark)).alias(f"_s_{slots[k]}") for k in kinds],
        *[F.struct(first_ask(k).alias("ask"), F.min(F.when(F.col("_t_reg") == k, F.col("_t_id"))).alias("has")).alias(f"_n_{slots[k]}") for k in kinds])
    need = {k: F.col(f"_n_{slots[k]}") for k in kinds}
    sums = sums.withColumns({f"_n_{slots[k]}": F.coalesce(F.col("_t_chunk").isNotNull() & n["ask"].isNotNull() & (n["has"].isNull() | (n["ask"] <= n["has"])), F.lit(False))
                             for k, n in need.items()})

    # over the chunks of a file
    earlier = Window.partitionBy("_t_file").orderBy("_t_chunk").rowsBetween(Window.unboundedPreceding, -1)
    for level in levels:
        columns = {}
        for k in level:
            s, above = F.col(f"_s_{slots[k]}"), []
            at = k
            while at in wants:
                at = wants[at]
                above.append(at)
            paths = [F.when(s["open"] == u, _numbered(F.col(f"_c_{slots[u]}"))["path"]) for u in above]
            fallback = [s["fall"], _numbered(F.col(f"_c_{slots[root]}"))["path"]] if above else []
            path = F.when(s["open"].isNull(), s["path"]).otherwise(F.concat(s["path"], F.coalesce(*paths, *fallback, F.array().cast(kind)))) if above else s["path"]
            closed = F.when(s.isNotNull(), F.struct(s["id"].alias("id"), path.alias("path")))
            columns[f"_c_{slots[k]}"] = F.last(closed, ignorenulls=True).over(earlier)
        sums = sums.withColumns(columns).drop(*[f"_s_{slots[k]}" for k in level])
    last, needs = {k: F.col(f"_c_{c}") for k, c in slots.items()}, {k: F.col(f"_n_{c}") for k, c in slots.items()}
    falls = reduce(lambda a, b: a | b, [needs[k] & (_numbered(last[k]).isNull() if k != root else F.lit(True)) for k in kinds])
    carry = F.struct(*[F.when(falls if k == root else needs[k], last[k]).alias(slots[k]) for k in kinds]).cast(_carry_kind(slots, kind))
    out = sums.select(*_NEAR, (F.shiftleft("_t_chunk", chunk_bits) - 1).alias("_t_id"), carry.alias("_t_carry"))
    return out.filter(reduce(lambda a, b: a | b, [F.col("_t_carry")[c].isNotNull() for c in slots.values()]))


def _link_with_paths(df: DataFrame, carried: DataFrame, wants: Mapping[str, str], file_col: str, id_col: str, reg_col: str, root: str,
                     chunk_bits: int, path_col: str, brings: Column | None) -> DataFrame:
    levels, kind = _levels(wants, root), _path_kind(df, brings)
    kinds = [k for level in levels for k in level]
    slots = {k: f"c{i}" for i, k in enumerate(kinds)}
    rid = F.col(id_col).cast("long")
    # columns that the keys hold already are not moved twice
    back = {file_col: F.col("_t_file")}
    if dict(df.dtypes)[id_col] in ("bigint", "int", "smallint", "tinyint"):
        back[id_col] = F.col("_t_id").cast(dict(df.dtypes)[id_col])
    rest = [c for c in df.columns if c not in back]
    lines = df.select(F.col(file_col).alias("_t_file"), F.shiftright(rid, chunk_bits).alias("_t_chunk"), rid.alias("_t_id"),
                      F.struct(*rest).alias("_t_line"), F.lit(None).cast(_carry_kind(slots, kind)).alias("_t_carry"))
    # an exchange of its own: what is worked out of the lines must not move below it
    dealt = lines.unionByName(carried, allowMissingColumns=True).repartition(*_NEAR)
    every = dealt.select(*_NEAR, "_t_id", "_t_carry", *[back[c].alias(c) if c in back else F.col("_t_line")[c].alias(c) for c in df.columns])
    nothing = F.lit(None).cast(f"struct<id:bigint,path:{kind}>")
    every = every.withColumns({"_t_reg": F.col(reg_col), "_t_found": nothing, "_t_up": nothing,
                               **({"_t_rows": _same_id(F.when(F.col(reg_col).isNotNull(), brings))} if brings is not None else {})})
    found, up, wanted = F.col("_t_found"), F.col("_t_up"), F.try_element_at(code_map(wants), F.col("_t_reg"))
    itself = _itself(brings is not None)
    mark = F.struct(F.col("_t_id").alias("id"), F.when(F.col("_t_file").isNotNull() & up.isNotNull(), F.concat(itself, up["path"])).otherwise(itself).cast(kind).alias("path"))
    for level in levels:
        every = every.withColumns({f"_t_{slots[k]}": F.last(F.coalesce(F.when(F.col("_t_id").isNotNull() & (F.col("_t_reg") == k), mark), F.col("_t_carry")[slots[k]]),
                                                            ignorenulls=True).over(_before()) for k in level})
        here = reduce(lambda at, k: at.when(wanted == k, F.col(f"_t_{slots[k]}")), level, F).otherwise(F.lit(None))
        # a root is found first, and stays unless the wanted type is found
        fallback, fallback_up = (F.when(wanted.isNotNull(), F.col(f"_t_{slots[root]}")),) * 2 if root in level else (found, up)
        comparable, parent = F.col("_t_id").isNotNull(), F.col("_t_reg").isin(kinds)
        every = every.withColumns({"_t_found": F.when(comparable, F.coalesce(here, fallback)),
                                   "_t_up": F.when(comparable & parent, F.coalesce(_numbered(here), _numbered(fallback_up)))}).drop(*[f"_t_{slots[k]}" for k in level])
    return every.filter(F.col("_t_carry").isNull()).select(*df.columns, found["id"].alias("_parent_uid_final"),
                                                           F.coalesce(found["path"], F.array().cast(kind)).alias(path_col))


def misplaced_lines(linked: DataFrame, *, file_col: str = "_source_file", id_col: str = "_row_id",
                    reg_col: str = "REG") -> DataFrame:
    """Lines whose parent is not of the record type their rule names (quality report)."""
    parents = linked.select(F.col(file_col).alias("_p_file"), F.col(id_col).alias("_p_id"),
                            F.col(reg_col).alias("_parent_reg"))
    hit = (F.col(file_col) == F.col("_p_file")) & (F.col("_parent_uid_final") == F.col("_p_id"))
    asked = linked.filter(F.col("_expected_parent").isNotNull())
    return (asked.join(parents, hit, "left").drop("_p_file", "_p_id")
            .filter(~F.col("_expected_parent").eqNullSafe(F.col("_parent_reg"))))


def header_of_files(df: DataFrame, fields: Mapping[str, Column], *, file_col: str = "_file_id",
                    id_col: str = "_row_id", reg_col: str = "REG", root: str = "0000") -> DataFrame:
    """One row per file with values of its first root line."""
    heads = df.filter(F.col(reg_col) == root)
    first = F.min_by(F.struct(*[c.alias(n) for n, c in fields.items()]), F.col(id_col))
    return heads.groupBy(file_col).agg(first.alias("_h")).select(file_col, "_h.*")


def propagate_header(df: DataFrame, headers: DataFrame, *, file_col: str = "_file_id",
                     how: str = "left") -> DataFrame:
    """Stamp a file's header values on each of its lines; header values win on a clash."""
    clash = [c for c in headers.columns if c in df.columns and c != file_col]
    return df.drop(*clash).join(own_shuffle(headers, [file_col]), [file_col], how)

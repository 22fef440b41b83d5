"""Shards along a Hilbert curve over several columns.

Each column is quantised to equal shares of the rows, the cells of a row give its place on the curve, and the rows in this
order are cut into shards of nearly equal size. Neighbours on the curve are near each other in every column, so each shard
holds a small range of all of them, and a filter on any column needs few shards.

Everything is DataFrame operations. Orders over all rows are made in two levels: rows are dealt by range, sums of the
ranges (one row each) are added up, and inside a range a window goes on from there. Ranges are cut over the whole sort
key down to the row's number, so one cell of the curve may hold any share of the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fiscalgrove.llm.shared import let, stored

#: cells of a column are 2^BITS
BITS = 8
SHARDS = 16


def curve_steps(dims: int) -> tuple[int, list[int]]:
    """The curve as a machine: number of states, and for state * 2^dims + digit the number next state * 2^dims + place.

    A digit has one bit of each cell number, the place says which of the 2^dims parts of the cube this is along the curve. A state is
    the corner where the curve enters a part and the direction in which it leaves it (the usual Gray code construction).
    """
    full = (1 << dims) - 1
    turned = lambda x, by: (x << by % dims | x >> dims - by % dims) & full
    gray = lambda x: x ^ x >> 1
    place_of = {gray(w): w for w in range(1 << dims)}
    zeros = lambda x: (x ^ x + 1).bit_length() - 1  # noqa: E731  trailing ones of x
    entry = lambda w: 0 if w == 0 else gray(2 * ((w - 1) // 2))
    leaves = lambda w: 0 if w == 0 else zeros(w - 1 if w % 2 == 0 else w) % dims
    steps = []
    for corner in range(1 << dims):
        for axis in range(dims):
            for digit in range(1 << dims):
                w = place_of[turned(digit ^ corner, dims - (axis + 1) % dims)]
                to_corner, to_axis = corner ^ turned(entry(w), axis + 1), (axis + leaves(w) + 1) % dims
                steps.append((to_corner * dims + to_axis) << dims | w)
    return dims << dims, steps


def curve_index(cells: list[Column], bits: int = BITS) -> Column:
    """The place on the curve of cells from 0 to 2^bits - 1, with len(cells) * bits bits."""
    dims = len(cells)
    states, steps = curve_steps(dims)
    table = F.array(*[F.lit(s) for s in steps])
    digits = F.array(*[reduce(lambda x, y: x + y, [F.shiftright(c, level).bitwiseAND(1) * F.lit(1 << i) for i, c in enumerate(cells)]).cast("int")
                       for level in range(bits - 1, -1, -1)])

    def step(acc: Column, digit: Column) -> Column:
        got = F.element_at(table, (acc % states * (1 << dims)).cast("int") + digit + 1)
        return let(got, lambda g: (F.floor(acc / states) * (1 << dims) + g % (1 << dims)) * states + F.shiftright(g, dims))

    return F.floor(F.aggregate(digits, F.lit(0).cast("long"), step) / states)


def running(rows: DataFrame, order: list[str], sums: dict[str, str], purpose: str) -> DataFrame:
    """rows and, for each ``new: column`` of sums, the sum of the column over all rows before in this order. No task holds more than a
    range of the rows; the totals of the ranges are one row each. Rows that are equal in the order should be equal in all."""
    dealt = stored(rows.repartitionByRange(*order).withColumn("range_", F.spark_partition_id()), purpose)
    totals = dealt.groupBy("range_").agg(*[F.sum(c).alias(f"{new}_own") for new, c in sums.items()])
    earlier = Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("range_").alias("range_of"), *[F.coalesce(F.sum(f"{new}_own").over(earlier), F.lit(0)).alias(f"{new}_offset") for new in sums])
    inside = Window.partitionBy("range_").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    numbered = dealt.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"{new}_inside") for new, c in sums.items()])
    return numbered.join(offsets, F.col("range_") == F.col("range_of")).select(
        *rows.columns, *[(F.col(f"{new}_inside") + F.col(f"{new}_offset")).alias(new) for new in sums])


def cuts(rows: DataFrame, column: str, bits: int = BITS) -> list[tuple]:
    """(least value, cell) of each cell that has rows, ascending, at most 2^bits of them: a value's cell is the share of the rows below it,
    in 2^bits parts. Null is below all values, in cell 0."""
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = F.lit(rows.count())
    nulls = F.lit(rows.where(F.col(column).isNull()).count())
    below = running(counts.where(F.col(column).isNotNull()), [column], {"below": "n"}, "hilbert-counts")
    cells = below.select(F.col(column).alias("value"), F.floor((F.col("below") + nulls) * F.lit(1 << bits) / total).alias("cell"))
    found = cells.groupBy("cell").agg(F.min("value").alias("value")).collect()  # 2^bits rows at most
    return sorted(((r["value"], r["cell"]) for r in found), key=lambda x: x[1])


def cell_of(value: Column, found: list[tuple], kind: str) -> Column:
    """The cell by binary search in the cuts."""
    if not found:
        return F.lit(0)
    least = F.array(*[F.lit(v).cast(kind) for v, _ in found])
    numbers = F.array(*[F.lit(int(c)) for _, c in found])
    halves = F.array(*[F.lit(1 << i) for i in range(len(found).bit_length() - 1, -1, -1)])
    at = F.aggregate(halves, F.lit(0), lambda at, half: F.when((at + half <= len(found)) & (F.try_element_at(least, at + half) <= value), at + half).otherwise(at))
    return F.coalesce(F.when(value.isNull() | (at == 0), F.lit(0)).otherwise(F.element_at(numbers, F.greatest(at, F.lit(1)))), F.lit(0))


def numbered(docs: DataFrame, columns: list[str], id_col: str, text_col: str, whole: bool = False) -> DataFrame:
    """A stored narrow table: ``n`` (a number for the row), ``id``, ``size``, ``crc`` and the columns as ``d0``, ``d1``, ...; size is
    offered as a column too, by the name ``size``. whole: ``row`` has all columns of the row as well."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    size = F.octet_length(text).cast("long") + 1
    cells = [(size if c == "size" and c not in docs.columns else F.col(f"`{c}`")).alias(f"d{i}") for i, c in enumerate(columns)]
    rest = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if whole else []
    return stored(docs.select(F.monotonically_increasing_id().alias("n"), F.col(id_col).alias("id"), size.alias("size"), F.crc32(text.cast("binary")).alias("crc"), *cells, *rest),
                  "hilbert-rows")


def placed(rows: DataFrame, dims: int, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """rows of ``numbered``: with ``curve`` (place on the curve), ``shard`` (int) and ``slot`` (long, from 0 in each shard).

    The order is by curve, then checksum of the text, so equal texts with equal columns lie side by side, then id (null first) and row.
    A row goes to the shard in whose share of the bytes its middle lies, so a shard's size is off its share by half of one document at
    each end at most.
    """
    found = [cuts(rows, f"d{i}", bits) for i in range(dims)]
    cells = [cell_of(F.col(f"d{i}"), f, rows.schema[f"d{i}"].dataType.simpleString()) for i, f in enumerate(found)]
    at = rows.select("n", "id", "size", "crc", F.lit(1).cast("long").alias("one"), *cells_as(cells))
    at = at.select("n", "id", "size", "crc", "one", curve_index([F.col(f"c{i}") for i in range(dims)], bits).alias("curve"))
    order = running(at, ["curve", "crc", "id", "n"], {"before": "size", "number": "one"}, "hilbert-order")
    total = F.lit(max(1, rows.agg(F.sum("size")).first()[0] or 0)).cast("decimal(20,0)")
    middle = F.floor((2 * F.col("before") + F.col("size")).cast("decimal(20,0)") * shards / (2 * total))
    cut = stored(order.select("n", "id", "size", "crc", "curve", "number", F.least(middle, F.lit(shards - 1)).cast("int").alias("shard")), "hilbert-shards")
    first = cut.groupBy("shard").agg(F.min("number").alias("first")).withColumnRenamed("shard", "of")
    return cut.join(first, F.col("shard") == F.col("of")).select("n", "id", "size", "crc", "curve", "shard", (F.col("number") - F.col("first")).alias("slot"))


def cells_as(cells: list[Column]) -> list[Column]:
    return [c.alias(f"c{i}") for i, c in enumerate(cells)]


def assign(docs: DataFrame, columns: tuple[str, ...] = ("lang", "source", "size"), shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
           bits: int = BITS) -> DataFrame:
    """One row per row of ``docs``: its id, ``size`` (bytes of the text in UTF-8 plus 1), ``text_crc32``, ``curve``, ``shard`` and ``slot``.

    ``columns`` are the metadata of the curve, of any type with an order; ``size`` is the size unless docs have such a column. Null is the
    least value. Null and empty texts have size 1 and checksum 0. Null and repeated ids stay rows of their own; rows that are equal
    in all take neighbouring slots. Other columns are not looked at. An empty table gives no rows.
    """
    rows = placed(numbered(docs, list(columns), id_col, text_col), len(columns), shards, bits)
    return rows.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "curve", "shard", "slot")


def write_shards(docs: DataFrame, path: str, columns: tuple[str, ...] = ("lang", "source", "size"), shards: int = SHARDS, id_col: str = "doc_id",
                 text_col: str = "text", bits: int = BITS, slots: int = 1_000_000) -> DataFrame:
    """Write the rows to ``path/shard=<k>``, in slot order, and give the manifest: per shard its rows, bytes, and least and greatest value of each
    column (``<column>_least``, ``<column>_most``, ``<column>_nulls``). A shard of more than ``slots`` rows has several files, each of a run of
    slots. ``docs`` must have no column ``shard``."""
    rows = numbered(docs, list(columns), id_col, text_col, whole=True)
    place = stored(placed(rows, len(columns), shards, bits).select(F.col("n").alias("m"), "shard", "slot"), "hilbert-places")
    both = rows.join(place, F.col("n") == F.col("m"))
    run = F.floor(F.col("slot") / slots)
    parts = place.select("shard", run.alias("run")).distinct().count()
    both.repartition(max(1, parts), "shard", run).sortWithinPartitions("shard", "slot").select("row.*", "shard").write.partitionBy("shard").parquet(path)
    ends = [e for i, c in enumerate(columns) for e in (F.min(f"d{i}").alias(f"{c}_least"), F.max(f"d{i}").alias(f"{c}_most"), F.count_if(F.col(f"d{i}").isNull()).alias(f"{c}_nulls"))]
    return both.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), *ends)


def read_shards(spark: SparkSession, path: str, manifest: DataFrame, **ranges: tuple) -> DataFrame:
    """The shards that can hold rows with all the columns in their ranges (least, most; None is open): by the manifest, which has one row a
    shard, the others are not read. The filter itself is left to the caller."""
    can = [c for name, (lo, hi) in ranges.items() for c in ([F.col(f"{name}_most") >= lo] if lo is not None else []) + ([F.col(f"{name}_least") <= hi] if hi is not None else [])]
    wanted = manifest.where(reduce(lambda x, y: x & y, can, F.lit(True))).select("shard")
    return spark.read.parquet(path).withColumn("shard", F.col("shard").cast("int")).where(F.col("shard").isin([r["shard"] for r in wanted.collect()]))

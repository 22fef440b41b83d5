"""Mixing sources to target weights with a splitting tree of multivariate hypergeometric draws.

Each source is dealt into blocks of documents by a hash. A source's target in words says how many
of its blocks the mix takes: whole rounds over all blocks, then blocks in a permuted order until the target is
reached (the last document is cut at a word border, so the mix meets the target to the word). The taken blocks
of all sources are then split among the output shards: at each node of a binary tree over the
shards, the number of blocks of each source that go left is drawn from the multivariate hypergeometric
distribution, so every shard is a fair draw without replacement and the counts add up exactly. A
shard draws its blocks from the source's permuted order, where its part starts behind those of the shards before it, and
orders its documents by a hash. Everything is a function of the seed and the data: reruns agree.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalgrove.llm.shared import WORD, stored

#: sources that the driver holds one row each of
MAX_SOURCES = 1_000_000
#: cells of the (source, shard) table that the driver draws
MAX_CELLS = 10_000_000
BLOCK_DOCS = 256
MAX_REPEATS = 3


def targets(sizes: dict[str | None, int], weights: dict[str | None, float], repeats: int = MAX_REPEATS) -> dict[str | None, float]:
    """Each source's share of all words by weight, none above ``repeats`` times its size; what is cut off is
    shared again by weight among the others, until none is above."""
    left, open_, out = float(sum(sizes.values())), set(sizes), {}
    while open_:
        unit = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if weights[s] * unit >= repeats * sizes[s]}
        if not full:
            return out | {s: weights[s] * unit for s in open_}
        for s in full:
            out[s] = float(repeats * sizes[s])
            left -= out[s]
        open_ -= full
    return out


def cycled_weights(sources, cycle=(1.0, 2.0, 3.0)) -> dict[str | None, float]:
    """Sources by code point, null last, weigh the cycle's values in turn."""
    ordered = sorted((s for s in sources if s is not None)) + [None] * (None in sources)
    return {s: cycle[i % len(cycle)] for i, s in enumerate(ordered)}


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """quotas: blocks of each source. Returns shards x sources; columns add up to the quotas, rows are as
    even as can be. Each node of the tree draws with a generator of its own, seeded by its place."""
    out = np.zeros((shards, len(quotas)), dtype=np.int64)
    todo = [(0, shards, np.asarray(quotas, dtype=np.int64))]
    while todo:
        lo, hi, blocks = todo.pop()
        if hi - lo == 1:
            out[lo] = blocks
            continue
        mid = (lo + hi) // 2
        take = int(blocks.sum()) * (mid - lo) // (hi - lo)
        rng = np.random.default_rng([seed, lo, hi])
        # the marginals method draws source by source, so large counts cost nothing
        left = rng.multivariate_hypergeometric(blocks, take, method="marginals") if blocks.sum() else blocks
        todo += [(lo, mid, left), (mid, hi, blocks - left)]
    return out


def sized(docs: DataFrame, id_col: str, source_col: str, text_col: str, row_col: str | None = None) -> DataFrame:
    """id, source and size (words; a null text has none) of each row, stored once; with ``row_col`` also ``row``."""
    row = [F.col(row_col).alias("row")] if row_col else []
    words = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
    return stored(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), words.alias("size"), *row), "mix-sizes")


def mix(docs: DataFrame, seed: int = 7, shards: int = 16, weights: dict | None = None, id_col: str = "doc_id",
        source_col: str = "source", text_col: str = "text", block_docs: int = BLOCK_DOCS, row_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Plans a mix as long as ``docs``. Returns

    * draws: one row per document and round that takes it: ``id``, ``source``, ``size``, ``block``, ``round``,
      ``words`` (how many of its words, all but for the document at which a source meets its target), ``shard``, ``place``
      (orders the documents of a shard); with ``row_col``, a number of each row, also ``row``;
    * totals: one row per document: ``id``, ``size``, ``source``, ``source_size``, ``target``, ``taken``.

    A null text counts no words and is never drawn, nor is a document without words. Null is a source of its own,
    last in order. Rows with equal or null ids stay rows of their own. An empty table gives an empty mix.
    """
    spark = docs.sparkSession
    rows = sized(docs, id_col, source_col, text_col, row_col)
    row = ["row"] if row_col else []
    per_source = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(per_source) > MAX_SOURCES or len(per_source) * shards > MAX_CELLS:
        raise ValueError(f"more than {MAX_SOURCES} sources, or {MAX_CELLS} cells of sources and shards")
    sizes = {r["source"]: r["size"] for r in per_source}
    weights = cycled_weights(sizes) if weights is None else weights
    target = targets(sizes, weights)
    # whole words: the mix takes them one by one
    facts = [(s, sizes[s], target[s], int(round(target[s])), max(1, -(-r["n"] // block_docs))) for r in per_source for s in [r["source"]]]
    source_ddl = "s string, source_size long, target double, quota long, blocks long"
    by_source = spark.createDataFrame(facts, source_ddl)
    salt = F.lit(seed)
    placed = rows.join(F.broadcast(by_source) if len(facts) <= 10_000 else by_source, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn(
        "block", F.pmod(F.xxhash64(salt, "id"), "blocks")).withColumn("key", F.xxhash64(salt, F.lit("doc"), "id", "size"))

    # rounds: 0, 1, .. are whole but for the last, of which the permuted blocks are taken up to the quota
    blocks = placed.groupBy("source", "block", "source_size", "quota").agg(F.sum("size").alias("block_size")).withColumn(
        "turn", F.xxhash64(salt, F.lit("block"), "source", "block"))
    order = Window.partitionBy("source").orderBy("turn", "block")
    blocks = blocks.withColumn("start", F.coalesce(F.sum("block_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn(
        "turn_no", F.row_number().over(order) - 1).withColumn(
        "whole", F.when(F.col("source_size") > 0, F.expr("quota div source_size")).otherwise(0)).withColumn(
        "rest", F.col("quota") - F.col("whole") * F.col("source_size"))
    blocks = blocks.withColumn("partly", F.least(F.greatest(F.col("rest") - F.col("start"), F.lit(0)), F.col("block_size")))
    blocks = stored(blocks.where("block_size > 0"), "mix-blocks")

    # slots of a source: all its blocks in permuted order for each whole round, then the taken ones
    counted = blocks.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.max("whole").alias("whole"), F.sum((F.col("partly") > 0).cast("long")).alias("more")).collect()
    counted.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    quotas = np.array([r["n"] * r["whole"] + r["more"] for r in counted], dtype=np.int64)
    shares = split_quotas(quotas, shards, _seed(seed)).cumsum(axis=0)
    bounds = spark.createDataFrame([(r["source"], r["n"], [int(x) for x in shares[:, i]]) for i, r in enumerate(counted)],
                                   T.StructType([T.StructField("s", T.StringType()), T.StructField("n_blocks", T.LongType()), T.StructField("bounds", T.ArrayType(T.LongType()))]))

    drawn = blocks.withColumn("round", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole")))).where("round < whole or partly > 0")
    drawn = drawn.withColumn("most", F.when(F.col("round") < F.col("whole"), F.col("block_size")).otherwise(F.col("partly")))
    # bounded by MAX_CELLS; one row per source
    drawn = drawn.join(bounds, F.col("source").eqNullSafe(F.col("s"))).withColumn("slot", F.col("round") * F.col("n_blocks") + F.col("turn_no"))
    # the shard whose part of the source's slots holds this one: bounds at or below the slot
    drawn = drawn.withColumn("shard", F.expr("size(filter(bounds, b -> b <= slot))"))
    drawn = drawn.select(F.col("source").alias("s"), F.col("block").alias("b"), "round", "most", (F.col("most") < F.col("block_size")).alias("cut"), "shard")

    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))
    picked = placed.where("size > 0").join(drawn, same).drop("s", "b")
    inside = Window.partitionBy("source", "block", "round").orderBy("key", "id", "size", *row)
    cut = picked.where("cut").withColumn("before", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).withColumn(
        "words", F.least(F.greatest(F.col("most") - F.col("before"), F.lit(0)), F.col("size"))).drop("before")
    draws = picked.where("not cut").withColumn("words", F.col("size")).unionByName(cut).where("words > 0").withColumn(
        "place", F.xxhash64(salt, F.lit("place"), "round", "id"))
    draws = draws.select("id", "source", "size", "block", "round", "words", "shard", "place", "key", *row)

    keys = ["id", "source", "size", "source_size", "target"]
    # every row of the table, also those never drawn; equal rows are told apart by their number
    taken = placed.select(*keys, F.lit(0).cast("long").alias("words"), F.lit(1).cast("long").alias("n")).unionByName(
        draws.join(F.broadcast(by_source) if len(facts) <= 10_000 else by_source, F.col("source").eqNullSafe(F.col("s"))).select(*keys, "words", F.lit(0).cast("long").alias("n")))
    totals = taken.groupBy(*keys).agg(F.sum("words").alias("all_words"), F.sum("n").alias("copies"))
    # equal rows share what they were given as evenly as can be
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    totals = totals.where("copies > 0").select("*", each).withColumn(
        "taken", F.expr("all_words div copies") + (F.col("copy") <= F.col("all_words") % F.col("copies")).cast("long"))
    return draws, totals.select("id", "size", "source", "source_size", "target", "taken")


def _seed(seed: int) -> int:
    return int.from_bytes(hashlib.sha256(str(seed).encode()).digest()[:8], "big")


def mixed_documents(docs: DataFrame, seed: int = 7, shards: int = 16, id_col: str = "doc_id", source_col: str = "source",
                    text_col: str = "text") -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is drawn, with ``mix_round``, ``mix_shard`` and ``mix_place``
    (sort by shard and place to read a shard in its local order). Where a document is cut, its text ends with the last
    word taken. Documents without words are in no mix. Rows are stored once with a number that draws are joined on, so
    rows with null or repeated ids stay rows of their own. Where ``docs`` has a column of such a name, the added one
    gets underscores behind it."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = stored(docs.select(whole, F.monotonically_increasing_id().alias("n")), "mix-rows")
    cell = lambda c: F.col("row").getField(c)
    plain = rows.select("n", cell(id_col).alias("id"), cell(source_col).alias("source"), cell(text_col).alias("text"))
    draws, _ = mix(plain, seed, shards, None, "id", "source", "text", row_col="n")
    picks = draws.select(F.col("row").alias("of"), "size", "words", "round", "shard", "place")
    joined = rows.join(picks, F.col("n") == F.col("of"))
    # words with what stands before them: the first so many, joined, are the text up to the end of the last word taken
    pieces = F.regexp_extract_all(cell(text_col), F.lit(r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++"), F.lit(0))
    head = F.array_join(F.slice(pieces, F.lit(1), F.col("words").cast("int")), "")
    text = F.when(F.col("words") < F.col("size"), head).otherwise(cell(text_col))
    taken = {c.lower() for c in docs.columns}
    added = []
    for c in ("round", "shard", "place"):
        name = f"mix_{c}"
        while name in taken:
            name += "_"
        added.append(F.col(c).alias(name))
    return joined.select(*[(text if c == text_col else cell(c)).alias(c) for c in docs.columns], *added)

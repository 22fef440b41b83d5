"""Near duplicates by SimHash.

Fingerprints of 64 bits are split into blocks. Two that differ in at most d bits agree in all but
d of the blocks, so they share at least one of the keys made of the other blocks (pigeonhole). Distinct fingerprints
meet under these keys and are verified by their Hamming distance. From each key only as many links as span its
members' components go on, never all pairs. Under a key with too many members for one task, two fingerprints within d
bits are found by a point halfway: each is sent to all points within d/2 bits of it, and all that meet at a
point are within d bits of each other, so a minimum, combined before the shuffle, links them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalgrove.llm.graph import components
from fiscalgrove.llm.shared import stored

SHINGLE = 4
SEED = 42
DISTANCE = 4
#: members of a key that one task compares with each other; beyond, points halfway are used
TOGETHER = 4096


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The majority of the bits of the XXH64 of all shingles of the folded text. bytes.lower() and bytes.split() know
    ASCII letters and white space only."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, width = (ends - sizes).tolist(), min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 15):
        part = hashes[i : i + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """All columns of ``docs`` and the fingerprint as a signed long."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py()) for t in batch.column(text_col)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints)], names=[*batch.schema.names, out_col])

    fields = docs.schema.fields
    return docs.mapInArrow(add, type(docs.schema)([*fields]).add(out_col, "long"))


def key_masks(n: int, distance: int = DISTANCE) -> list[int]:
    """Masks of the keys: all choices of all but ``distance`` blocks. More fingerprints take more blocks, so keys
    have about as many bits as there are fingerprints; any number gives the same links."""
    blocks = next((b for b in range(distance + 1, 12) if n <= 2 ** (64 * (b - distance) / b)), 12)
    edges = [64 * i // blocks for i in range(blocks + 1)]
    of_block = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(of_block, blocks - distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def spanning(prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that span the components of fingerprints within ``distance`` of each other; every reached
    one is compared with all that are not reached yet."""
    links, left = [], prints.astype(np.int64).view(np.uint64)
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            near = np.bitwise_count(left ^ queue[0]) <= distance
            if near.any():
                links += [(int(queue[0]), int(x)) for x in left[near]]
                queue += list(left[near])
                left = left[~near]
            queue.pop(0)
    return [(_signed(a), _signed(b)) for a, b in links]


def _flips(mask: int, most: int) -> list[int]:
    """All masks of at most ``most`` bits outside ``mask``."""
    free = [1 << i for i in range(64) if not mask >> i & 1]
    return [sum(c) for k in range(most + 1) for c in combinations(free, k)]


def links(prints: DataFrame, distance: int = DISTANCE, together: int = TOGETHER) -> DataFrame:
    """prints: distinct ``fp`` (long). Links (u, v) that span the components of fingerprints within ``distance`` bits."""
    if distance % 2:
        raise ValueError("points halfway exist for even distances only")
    masks = key_masks(prints.count(), distance)
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)])).alias("at")
    keyed = prints.select("fp", keys).select("at.k", "at.key", "fp")
    sizes = keyed.groupBy("k", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    keyed = stored(keyed.join(sizes, ["k", "key"]), "simhash-keys")
    few = keyed.where(F.col("n") <= together).groupBy("k", "key").agg(F.collect_list("fp").alias("fps")).select("fps")  # bounded lists

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [link for fps in batch.column(0) for link in spanning(fps.values.to_numpy(), distance)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["u", "v"])

    out = few.mapInArrow(compare, "u long, v long")
    crowded = keyed.where(F.col("n") > together)
    for k in [r["k"] for r in crowded.select("k").distinct().collect()]:  # one row per mask at most
        near = [F.lit(_signed(m)) for m in _flips(masks[k], distance // 2)]
        at = crowded.where(F.col("k") == k).select("fp", F.explode(F.transform(F.array(*near), lambda m: F.col("fp").bitwiseXOR(m))).alias("point"))
        least = at.groupBy("point").agg(F.min("fp").alias("least"), F.max("fp").alias("most")).where("least != most")
        out = out.unionByName(at.join(least, "point").where("fp != least").select(F.col("fp").alias("u"), F.col("least").alias("v")).distinct())
    return out


def grouped(prints: DataFrame, distance: int = DISTANCE, together: int = TOGETHER) -> DataFrame:
    """prints: fp (may repeat). One row per distinct fp that is linked to others: ``node``, ``root``."""
    distinct = stored(prints.select("fp").distinct(), "simhash-prints")
    return components(links(distinct, distance, together))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE) -> DataFrame:
    """One row per row of ``docs``: id, ``fingerprint`` (16 hex digits), ``component_id`` (the smallest id that is
    reachable over links, null if there is none).

    Null and empty texts have fingerprint zero and are linked like any other. Rows with null or repeated ids stay rows of their own.
    An empty table gives no rows. Other columns are not looked at.
    """
    rows = stored(with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), "text", "fp").drop("text"), "simhash")
    least = rows.groupBy("fp").agg(F.min("id").alias("least"))
    roots = stored(least.join(grouped(rows, distance), F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    ids = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = roots.select("fp", "root").join(ids, "root").select(F.col("fp").alias("of"), "component_id")
    return rows.join(of_print, F.col("fp") == F.col("of")).select(F.col("id").alias(id_col), hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def hex_digits(c: Column) -> Column:
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs``, one of each group: that of the smallest id (null ids last; of repeated ids any one row), with all columns."""
    cells = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).cast("string").alias("text")]
    marked = with_fingerprint(docs.select(*cells), "text", "fp").select("row", "fp", F.monotonically_increasing_id().alias("n"))
    rows = stored(marked, "simhash-rows")
    return firsts(rows, grouped(rows, distance), id_col)


def firsts(rows: DataFrame, linked: DataFrame, id_col: str) -> DataFrame:
    """rows: stored ``row``, ``n``, ``fp``; linked: ``node`` and ``root`` of linked prints. Of each group the row of the smallest id."""
    narrow = rows.select("fp", "n", F.col("row")[id_col].alias("id"))
    roots = stored(narrow.select("fp").distinct().join(linked, F.col("fp") == F.col("node"), "left").select(
        F.col("fp").alias("of"), F.coalesce("root", "fp").alias("root")), "simhash-roots")
    placed = narrow.join(roots, F.col("fp") == F.col("of")).select("root", "n", "id")
    first = placed.groupBy("root").agg(F.min("id").alias("first"))
    # of the rows with the first id, or without any where no row has one, the first
    same = placed.join(first.withColumnRenamed("root", "r"), (F.col("root") == F.col("r")) & F.col("id").eqNullSafe(F.col("first")))
    chosen = same.groupBy("root").agg(F.min("n").alias("chosen")).select("chosen")
    return rows.join(chosen, F.col("n") == F.col("chosen"), "left_semi").select("row.*")

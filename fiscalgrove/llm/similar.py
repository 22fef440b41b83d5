"""Near copies by SimHash, verified by the Jaccard similarity of their five-word shingles.

The SimHash of a text is the majority of the bits of its shingles' hashes. Texts whose shingle sets are s alike disagree in a
bit with probability arccos(2s / (1 + s)) / pi: 0.15 at 0.8. So 128 bits tell near copies from other texts by their
Hamming distance, but no fixed number of wrong bits that blocks could be chosen around holds them all. Therefore the
fingerprint is as wide as it takes: its blocks are the keys, and there are so many of them that two texts 0.8 alike agree
in none with probability MISS, less above. Under each key fingerprints are checked by their distance. Texts that are near by it, directly
or over others, make up a class, in which all whole shingle sets are compared: every link is exact, and a pair
that the classes bring together needs no key of its own.

Equal shingle sets are one. From each key only as many links as span its members' components go on, never all pairs. The members
of a key, or of a class, that is too large for one task are dealt into chunks, and each two chunks meet in a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalgrove.llm.graph import components
from fiscalgrove.llm.shared import settled, stored
from fiscalgrove.llm.simhash import SEED, firsts

SHINGLE = 5
#: similarity from which texts are near copies, as a fraction of whole numbers
LEAST = (4, 5)
#: how probably a pair that is just so similar shares no key
MISS = 0.0007
#: a bit of two such texts is equal with this probability
AGREE = 1 - math.acos(2 * LEAST[0] / (LEAST[0] + LEAST[1])) / math.pi
#: words of 64 bits that are checked by their distance, and the largest one: of 1,000 pairs just so similar, 0.6 differ in more bits
CHECKED, NEAR = 2, 33
#: members, and shingles of all members, that one task compares with each other
TOGETHER, SHINGLES = 4096, 4_000_000
#: keys of so many crowded blocks (some 30 bytes each) are sent to all tasks; more are joined with a shuffle
MAX_SENT = 100_000


def shingles(text: str | None) -> np.ndarray:
    """The XXH64 of the shingles of the folded text, sorted, each once; fewer words are one shingle, no words none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, width = (ends - sizes).tolist(), min(SHINGLE, len(words))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())], dtype=np.uint64))


def block_bits(n: int) -> int:
    """Bits of a block, so that unrelated texts share it by the dozen; more texts take wider and more blocks."""
    return min(max(int(n).bit_length() - 6, 8), 32)


def blocks_for(bits: int) -> int:
    return math.ceil(math.log(MISS) / math.log1p(-(AGREE**bits)))


def words_for(bits: int) -> int:
    """64-bit words of a fingerprint with all blocks."""
    return max(CHECKED, -(-bits * blocks_for(bits) // 64))


def _mixers(words: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 1 << 63, words, dtype=np.uint64), rng.integers(0, 1 << 62, words, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def fingerprint(found: np.ndarray, words: int) -> np.ndarray:
    """The majority of the bits of the shingles' hashes, ``words`` times 64 bits; zero without shingles."""
    xors, times = _mixers(words)
    ones = np.zeros(64 * words, dtype=np.int64)
    for i in range(0, len(found), 1 << 11):
        mixed = (found[i : i + (1 << 11), None] ^ xors) * times
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(29)
        ones += np.unpackbits(mixed.astype("<u8").view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return np.packbits(2 * ones > len(found), bitorder="little").view("<u8")


def with_prints(docs: DataFrame, text_col: str, bits: int) -> DataFrame:
    """``text_col`` gives way to ``fp`` (a hash of the shingle set), ``size`` (of the set) and ``print`` (the fingerprint)."""
    words = words_for(bits)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, sizes, prints = [], [], []
            for text in batch.column(text_col):
                found = shingles(text.as_py())
                sets.append(xxhash.xxh64_intdigest(found.astype("<u8").tobytes(), SEED) - (1 << 63))
                sizes.append(len(found))
                prints.append(fingerprint(found, words).tobytes())
            rest = batch.drop_columns([text_col])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(sets, pa.int64()), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary())],
                                             names=[*rest.schema.names, "fp", "size", "print"])

    fields = [f for f in docs.schema.fields if f.name != text_col]
    return docs.mapInArrow(add, type(docs.schema)(fields).add("fp", "long").add("size", "long").add("print", T.BinaryType()))


def block_keys(prints: np.ndarray, bits: int) -> np.ndarray:
    """prints: a fingerprint a row. A key for each of its blocks: the block's number and bits."""
    blocks = blocks_for(bits)
    cells = np.unpackbits(np.ascontiguousarray(prints).view(np.uint8), axis=1, bitorder="little")[:, : blocks * bits].reshape(-1, blocks, bits)
    return cells.astype(np.int64) @ (np.int64(1) << np.arange(bits, dtype=np.int64)) + (np.arange(blocks, dtype=np.int64) << 32)


def keyed(prints: DataFrame, bits: int) -> DataFrame:
    """prints: ``fp``, ``size``, ``print``. One row per block of each text with shingles: ``key``, ``fp`` and the bits to check."""
    words, checked = words_for(bits), [f"s{i}" for i in range(CHECKED)]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1 << 11):
                batch = whole.slice(at, 1 << 11)
                own = np.frombuffer(b"".join(batch.column("print").to_pylist()), dtype="<u8").reshape(-1, words)
                keys = block_keys(own, bits)
                fields = [keys.reshape(-1), *(np.repeat(x, keys.shape[1]) for x in (batch.column("fp").to_numpy(), *own[:, :CHECKED].view("<i8").T))]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in fields], names=["key", "fp", *checked])

    return prints.where("size > 0").select("fp", "print").mapInArrow(spread, "key long, fp long, " + ", ".join(f"{c} long" for c in checked))


def met(chunks: Column, *salt: str) -> Column:
    """In which cells a member of ``chunks`` chunks meets others: pairs of chunks, its own with each other one."""
    own = F.pmod(F.xxhash64("fp", *salt), chunks)
    others = F.filter(F.sequence(F.lit(0).cast("long"), chunks - 1), lambda j: j != own)
    cells = F.transform(others, lambda j: F.struct(F.least(own, j).alias("a"), F.greatest(own, j).alias("b")))
    return F.when(chunks > 1, cells).otherwise(F.array(F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))))


def chunks_of(amount: Column, most: int) -> Column:
    """Chunks of which two together hold about ``most`` at most; one is enough for so much."""
    return F.when(amount > most, F.ceil(2 * amount / F.lit(most))).otherwise(F.lit(1)).cast("long")


def near_links(fps: np.ndarray, prints: np.ndarray) -> list[tuple[int, int]]:
    """Links that span the components of fingerprints within NEAR bits of each other."""
    distance = lambda a, b: sum(np.bitwise_count(x ^ y) for x, y in zip(a, b))
    met_any = np.zeros(len(fps), dtype=bool)
    for i in range(0, len(fps), 256):
        part = [p[i : i + 256, None] for p in prints]
        met_any[i : i + 256] = (distance(part, prints) <= NEAR).sum(axis=1) > 1   # itself is always near
    left, links = np.flatnonzero(met_any), []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = distance([p[at] for p in prints], [p[left] for p in prints]) <= NEAR
            if near.any():
                links += [(int(fps[at]), int(fps[x])) for x in left[near]]
                queue += left[near].tolist()
                left = left[~near]
    return links


def candidates(prints: DataFrame, bits: int, together: int = TOGETHER) -> DataFrame:
    """prints: stored ``fp``, ``size``, ``print``. Links (u, v) between texts whose fingerprints share a block and are near."""
    rows = keyed(prints, bits)
    crowded = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > together).select(
        F.col("key").alias("k"), chunks_of(F.col("members"), together).alias("chunks")), "similar-crowded")
    crowded = F.broadcast(crowded) if crowded.count() <= MAX_SENT else crowded
    cells = F.explode(met(F.coalesce("chunks", F.lit(1).cast("long")), "key")).alias("cell")
    dealt = rows.join(crowded, F.col("key") == F.col("k"), "left").select("key", "fp", *(f"s{i}" for i in range(CHECKED)), cells)
    at = ("key", "a", "b")
    meeting = dealt.select("key", "cell.a", "cell.b", "fp", *(f"s{i}" for i in range(CHECKED))).repartition(*at).sortWithinPartitions(*at)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None

        def out(columns: list[np.ndarray], edges: np.ndarray) -> pa.RecordBatch:
            pairs = [x for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()) if hi - lo > 1
                     for x in near_links(columns[3][lo:hi], [c[lo:hi].view(np.uint64) for c in columns[4:]])]
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in pairs], pa.int64()) for i in (0, 1)], names=["u", "v"])

        for batch in batches:
            now = [c.to_numpy() for c in batch.columns]
            columns = now if rest is None else [np.concatenate(x) for x in zip(rest, now)]
            if not len(columns[0]):
                continue
            new = np.zeros(len(columns[0]), dtype=bool)
            for c in columns[:3]:
                new[1:] |= c[1:] != c[:-1]
            edges = np.concatenate([[0], np.flatnonzero(new)])
            rest = [c[edges[-1] :] for c in columns]   # the last one may go on in the next batch
            yield out(columns, edges)
        if rest is not None:
            yield out(rest, np.array([0, len(rest[0])]))

    return meeting.mapInArrow(check, "u long, v long")


def spanning(prints: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that span the components of sets that are alike; every reached one is compared with all that are
    not reached yet."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    numbers = np.unique(np.concatenate(sets), return_inverse=True)[1]
    has = np.zeros(numbers.max() + 1, dtype=bool)
    links, left = [], np.arange(len(sets))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop(0)
            own = numbers[starts[at] : starts[at] + sizes[at]]
            has[own] = True
            common = np.add.reduceat(has[numbers], starts, dtype=np.int64)[left]
            has[own] = False
            near = LEAST[1] * common >= LEAST[0] * (sizes[at] + sizes[left] - common)
            links += [(prints[at], prints[x]) for x in left[near]]
            queue += list(left[near])
            left = left[~near]
    return links


def links(rows: DataFrame, bits: int, together: int = TOGETHER, most: int = SHINGLES) -> DataFrame:
    """rows: stored ``n``, ``fp``, ``size``, ``print``, ``text``. Links (u, v) between the prints of sets that are alike."""
    def classes() -> DataFrame:
        sets = stored(rows.groupBy("fp").agg(F.first("size").alias("size"), F.first("print").alias("print")), "similar-prints")
        return components(candidates(sets, bits, together)).join(sets.select("fp", "size"), F.col("node") == F.col("fp")).select("fp", "root", "size")

    of_class = settled(rows.sparkSession, classes, "similar-classes")
    first = rows.groupBy("fp").agg(F.min("n").alias("m")).join(of_class.select("fp"), "fp", "left_semi")
    texts = rows.select("n", "fp", "text").join(first.select("m"), F.col("n") == F.col("m"), "left_semi").select("fp", "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t.as_py()).astype("<u8").tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("fp"), pa.array(found, pa.binary())], names=["fp", "found"])

    found = stored(texts.mapInArrow(read, "fp long, found binary"), "similar-sets")
    sizes = of_class.groupBy("root").agg(F.count(F.lit(1)).alias("members"), F.sum("size").alias("all")).select(
        F.col("root").alias("r"), F.greatest(chunks_of(F.col("members"), together), chunks_of(F.col("all"), most)).alias("chunks"))
    dealt = of_class.join(sizes, F.col("root") == F.col("r")).select("fp", "root", F.explode(met(F.col("chunks"))).alias("cell")).select("fp", "root", "cell.a", "cell.b")
    at = ("root", "a", "b")
    near = dealt.join(found, "fp").repartition(*at).sortWithinPartitions(*at)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, prints, sets = None, [], []

        def out(pairs: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in pairs], pa.int64()) for i in (0, 1)], names=["u", "v"])

        for batch in batches:
            pairs = []
            for *cell, fp, found in zip(*(batch.column(c).to_pylist() for c in (*at, "fp", "found"))):
                if cell != now:
                    pairs += spanning(prints, sets) if len(sets) > 1 else []
                    now, prints, sets = cell, [], []
                prints.append(fp)
                sets.append(np.frombuffer(found, dtype="<u8"))
            yield out(pairs)
        yield out(spanning(prints, sets) if len(sets) > 1 else [])

    return near.select(*at, "fp", "found").mapInArrow(compare, "u long, v long")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", together: int = TOGETHER, most: int = SHINGLES) -> DataFrame:
    """The rows of ``docs``, one of each group of near copies: that of the smallest id (null ids last; of repeated ids any
    one row), with all columns. Groups are the components of pairs with a similarity of 0.8 or more.

    Null and empty texts have no shingles and are copies of each other only. An empty table gives no rows.
    """
    bits = block_bits(docs.count())
    cells = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).cast("string").alias("text")]
    rows = stored(with_prints(docs.select(*cells), "text", bits).select("*", F.monotonically_increasing_id().alias("n")), "similar-rows")
    texts = rows.withColumn("text", F.col("row")[text_col].cast("string"))
    linked = settled(docs.sparkSession, lambda: components(links(texts, bits, together, most)), "similar-groups")
    return firsts(rows, linked, id_col)

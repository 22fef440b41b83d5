"""Blocks of rows with dictionaries of their own, and exchanges of facts about keys between blocks.

Statistics over all tokens or substrings of a corpus have almost as many distinct keys as the corpus has
tokens. A row per key and document in the shuffle would cost several times the corpus. Here the rows of one Arrow batch
make up a block, stored once in the shared scratch folder. A block publishes each of its distinct keys once, hashed to 64
bits, in sorted and compressed bundles, one per part of the key space. A part combines the bundles of all blocks and sends each
block the combined values of its own keys back, in their order. So a key has at most one entry per block, however often it occurs:
hot keys are pre-aggregated, and no part holds more than its share of the distinct keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalgrove.llm.shared import stored

#: entries (distinct keys of blocks) that one part of the key space should hold
PART_ENTRIES = 500_000
#: bytes of text of a block; a longer text is a block of its own
BLOCK_BYTES = 4 << 20


def packed(values: np.ndarray, sort_of: str = "plain") -> bytes:
    """An integer array as bytes; ``sorted`` arrays as differences. Bytes of equal rank lie together, which compresses best."""
    values = np.ascontiguousarray(values)
    if sort_of == "sorted" and len(values):
        values = np.diff(values, prepend=values.dtype.type(0))
    planes = values.view(np.uint8).reshape(-1, values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(data: bytes, dtype: str, sort_of: str = "plain") -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    size = np.dtype(dtype).itemsize
    values = np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(dtype)
    return np.cumsum(values, dtype=dtype) if sort_of == "sorted" else values


def runs_by_part(keys: np.ndarray, parts: int) -> Iterator[tuple[int, int, int]]:
    """Part, begin and end of each run of sorted 64-bit keys that falls into one part of the key space."""
    if len(keys):
        part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        at = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(keys)]
        yield from zip(part[at[:-1]].tolist(), at[:-1], at[1:])


#: n: in what a part sends back, how many of its keys with a first value above zero are new with this block
BUNDLE = "part int, block long, n long, keys binary, values array<binary>"


def bundles(block: int, keys: np.ndarray, values: list[np.ndarray], parts: int) -> list[tuple]:
    """keys: sorted distinct uint64. One bundle for each part that has any of them."""
    return [(p, block, b - a, packed(keys[a:b], "sorted"), [packed(v[a:b]) for v in values]) for p, a, b in runs_by_part(keys, parts)]


def bundle_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.binary()))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["part", "block", "n", "keys", "values"])


def published(blocks: DataFrame, keys_of: Callable[[dict], tuple[int, np.ndarray, list[np.ndarray]]], parts: int) -> DataFrame:
    """blocks: one row each. ``keys_of(row)`` gives the block's id, its sorted distinct keys and arrays of values."""

    def publish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield bundle_batch(bundles(*keys_of(batch.slice(i, 1).to_pylist()[0]), parts))

    return blocks.mapInArrow(publish, BUNDLE)


def exchange(published: DataFrame, dtypes: list[str], combine: Callable[[np.ndarray, np.ndarray, list[np.ndarray]], list[np.ndarray]]) -> DataFrame:
    """published: bundles. For each part, ``combine(starts, run, values)`` gets the values sorted by key, where each
    key's run starts, and which run each entry is in; it returns arrays per entry. Returns bundles with these arrays as values
    and without keys: every block gets back the facts about its own keys, in their order.
    """

    def combined(bundle_rows: pa.Table) -> pa.Table:
        lists = bundle_rows.column("values").to_pylist()
        keys = [unpacked(k, "<u8", "sorted") for k in bundle_rows.column("keys").to_pylist()]
        sizes = np.cumsum([len(k) for k in keys])
        every = np.concatenate(keys)
        del keys
        order = np.argsort(every, kind="stable")
        ordered = every[order]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        del every, ordered
        values = [np.concatenate([unpacked(v[i], d) for v in lists])[order] for i, d in enumerate(dtypes)]
        results = combine(np.flatnonzero(new), np.cumsum(new) - 1, values)
        back = []
        for r in [*results, new & (results[0] > 0)]:
            own = np.empty_like(r)
            own[order] = r
            back.append(np.split(own, sizes[:-1]))
        part = bundle_rows.column("part")[0].as_py()
        rows = [(part, b, int(back[-1][i].sum()), None, [packed(v[i]) for v in back[:-1]]) for i, b in enumerate(bundle_rows.column("block").to_pylist())]
        return pa.Table.from_batches([bundle_batch(rows)])

    return published.groupBy("part").applyInArrow(combined, BUNDLE)


def gathered(bundle_rows: DataFrame, name: str) -> DataFrame:
    """All that came back to a block as one row: ``<name>_block`` and ``name``, the lists of values by part. A block's keys are bounded by its size."""
    by_part = F.array_sort(F.collect_list(F.struct("part", "values")))
    return bundle_rows.groupBy(F.col("block").alias(f"{name}_block")).agg(F.transform(by_part, lambda b: b["values"]).alias(name))


def facts(lists: list[list[bytes]] | None, dtypes: list[str]) -> list[np.ndarray]:
    """The values of a block's keys, in the order of the keys."""
    return [np.concatenate([unpacked(v[i], d) for v in lists or []] or [np.empty(0, d)]) for i, d in enumerate(dtypes)]


def parts_for(entries: int) -> int:
    return max(1, -(-entries // PART_ENTRIES))


def stored_blocks(df: DataFrame, make: Callable[[int, pa.RecordBatch], pa.RecordBatch], ddl: str, purpose: str, text_col: str = "text",
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One call of ``make(block id, rows)`` for about ``block_bytes`` of text, its result stored. Once stored, nothing is numbered or
    made again, so all later jobs see the same blocks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 24
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            group = np.cumsum(sizes) // block_bytes
            at = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
            for a, b in zip(at, at[1:]):
                if b > a:
                    yield make(block, batch.slice(a, b - a))
                    block += 1

    return stored(df.mapInArrow(cut, ddl), purpose)

"""Removal of repeated substrings, by a radix sort of suffixes to a limited depth.

Suffixes need ordering only through ``length`` bytes: windows of that length which are equal through all
digits are exactly the repeated ones. The sort goes digit by digit, the most significant one first; only groups that still
hold different members go on to the next pass.

Digits are not taken from left to right but from inside, so that not every suffix has to move. In each window, the
32-byte string of the least hash (the leftmost of equals) is its anchor: the first digit. Equal windows have equal anchors at
equal places, and neighbouring windows mostly share theirs, so a text falls into units: the windows around one anchor. What all
windows of a unit have in common is its core, at first the anchor; all that they cover is its span. A pass groups units by their
cores, over all blocks (see ``blocks``). Groups whose spans are equal, above all those of one member, are done: their least id is the
first occurrence of all their windows. The others are cut into units of at most 16, then 4 windows, then single windows: each time the
core grows by the bytes next to it on both sides, which is the next digit, until core and span are the whole window.

Within a block, units of equal cores are put together before they move, so a passage that stands in a third of all
rows has one entry per block and pass, also where it ends and the texts go on differently.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalgrove.llm.blocks import exchange, facts, gathered, packed, parts_for, published, stored_blocks, unpacked
from fiscalgrove.llm.shared import settled, stored

LENGTH = 100
#: bytes of an anchor's string
DIGIT = 32
#: bytes of text of a block: where all windows of a block differ in every pass, a task takes about 120 bytes of memory for each
BLOCK_BYTES = 2 << 20
#: windows looked at together; places fit in so many bits
PLACE_BITS = 18
#: stands in the order of ids for a null
NULL_ID = np.iinfo(np.int64).min

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
#: the base of the hash of a string, and its inverse modulo 2 ** 64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: a block of texts (compressed) with its units that go on (anchors, distance of their first and last window) and the runs of windows to remove
_BLOCK = "block long, n_bytes long, ids array<long>, sizes array<long>, text binary, n_units long, units array<binary>, late array<binary>"


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of the pair (a, b)."""
    x = a * _M1
    x ^= x >> np.uint64(32)
    x += b
    x *= _M2
    x ^= x >> np.uint64(29)
    x *= _M3
    x ^= x >> np.uint64(32)
    return x


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span, least = 1, x
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    return np.minimum(least[: len(x) - width + 1], least[width - span : width - span + len(x) - width + 1]) if span < width else least


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    return tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, x, np.uint64)])) for x in (_BASE, _INVERSE))


def _widths(length: int) -> list[int]:
    """How many windows a unit has at most, by pass after the first: powers of four down to one."""
    most, width = length - DIGIT + 1, 1
    widths = [1]
    while 16 * width <= most:
        width *= 4
        widths.insert(0, width)
    return widths


class Block:
    """A block's texts and its units: the place of the anchor ``at``, the first and the last window, in the block's bytes, by ``at``.

    ``width`` 0 stands for the first pass, where all windows of an anchor are a unit.
    """

    def __init__(self, block: dict, length: int, width: int) -> None:
        self.id, self.length, self.width, self.row_of = block["block"], length, width, block
        self.ids = np.array([NULL_ID if i is None else i for i in block["ids"]], dtype=np.int64)
        self.sizes = np.array(block["sizes"], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.text = np.frombuffer(zstandard.ZstdDecompressor().decompress(block["text"]), dtype=np.uint8)
        if width:
            self.at = unpacked(block["units"][0], "<i8", "sorted")
            self.first, self.last = (self.at - unpacked(u, "<u2") for u in block["units"][1:])
            core = self.at - (self.at - self.last) // width * width   # the last window that the unit may have
            self.key = self._strings(core, np.maximum(core - width + 1, self.at - (length - DIGIT)) + length)
            self.whole = np.maximum(self._strings(self.first, self.last + length), np.uint64(1))
        else:
            self._find_units()
        # distinct keys, sorted; each unit's place among them
        self.keys, self.place = np.unique(self.key, return_inverse=True)

    def _strings(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hashes of the strings from lo to hi, which are near the units' anchors: sums of bytes times powers, as differences of running sums."""
        step, out = 1 << PLACE_BITS, np.empty(len(lo), dtype=np.uint64)
        power, inverse = _powers(step + 2 * self.length + 1)
        a = 0
        while a < len(lo):
            base = max(int(self.at[a]) - self.length, 0)
            b = int(np.searchsorted(self.at, base + step))
            piece = self.text[base : base + step + self.length]
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * power[: len(piece)])])
            out[a:b] = (sums[hi[a:b] - base] - sums[lo[a:b] - base]) * inverse[lo[a:b] - base]
            a = b
        return _mix(out, (hi - lo).astype(np.uint64))

    def _find_units(self) -> None:
        step, n = (1 << PLACE_BITS) - self.length, len(self.text)
        found = [self._piece(c, min(c + step, n - self.length + 1)) for c in range(0, max(n - self.length + 1, 0), step)]
        row, first, last, at, anchor, head, tail = (np.concatenate(x) if found else np.empty(0, np.int64) for x in (zip(*found) if found else [()] * 7))
        # pieces cut units that go on in the next one
        if len(first):
            joint = np.flatnonzero((at[1:] == at[:-1]) & (row[1:] == row[:-1]))
            keep = np.ones(len(first), dtype=bool)
            keep[joint + 1] = False
            group = np.cumsum(keep) - 1
            ends = np.searchsorted(group, np.arange(group[-1] + 1), side="right") - 1
            first, at, anchor, head, last, tail = first[keep], at[keep], anchor[keep], head[keep], last[ends], tail[ends]
        # anchors are least hashes, so most lie in the lowest parts of the key space: mixed again, one to one, they spread over all
        self.at, self.first, self.last, self.key = at, first, last, _mix(anchor.astype(np.uint64), np.uint64(0))
        # its first and last window cover a span; zero is kept for "several"
        self.whole = np.maximum(_mix(_mix(head.astype(np.uint64), tail.astype(np.uint64)), (last - first).astype(np.uint64)), np.uint64(1))

    def _hashes(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the 32-byte strings that start in windows from lo to hi, and of these windows."""
        raw = np.ascontiguousarray(self.text[lo : hi + self.length - 1])
        eight = np.ndarray((len(raw) - 7,), dtype="<u8", buffer=raw.data, strides=(1,)).copy()
        sixteen = _mix(eight[:-8], eight[8:])
        digits = _mix(sixteen[:-16], sixteen[16:])
        n, whole = hi - lo, None
        for at in [*range(0, self.length - DIGIT, DIGIT), self.length - DIGIT]:
            part = digits[at : at + n]
            whole = part if whole is None else _mix(whole, part)
        return digits, whole

    def _piece(self, lo: int, hi: int) -> tuple[np.ndarray, ...]:
        digits, whole = self._hashes(lo, hi)
        low = np.uint64((1 << PLACE_BITS) - 1)
        least = _sliding_min((digits & ~low) | np.arange(len(digits), dtype=np.uint64), self.length - DIGIT + 1)
        place = (least & low).astype(np.int64)
        start = np.arange(lo, hi)
        row = self.rows(start)
        inside = start + self.length <= self.starts[row] + self.sizes[row]
        new = np.concatenate([[True], (place[1:] != place[:-1]) | (row[1:] != row[:-1]) | ~inside[:-1]]) & inside
        at = np.flatnonzero(new)
        end = np.flatnonzero(np.concatenate([new[1:] | ~inside[1:], [True]]) & inside)
        return row[at], at + lo, end + lo, place[at] + lo, digits[place[at]], whole[at], whole[end]

    def rows(self, start: np.ndarray) -> np.ndarray:
        """Rows without bytes share their start with the next row; the last of them has the bytes."""
        return np.searchsorted(self.starts, start, side="right") - 1

    def entries(self) -> tuple[int, np.ndarray, list[np.ndarray]]:
        """What the block publishes: its distinct keys, each with its span (0: several) and its least id."""
        if not len(self.keys):
            return self.id, self.keys, [np.empty(0, np.uint64), np.empty(0, np.int64)]
        order = np.argsort(self.place, kind="stable")
        at = np.searchsorted(self.place[order], np.arange(len(self.keys)))
        low, high = (f.reduceat(self.whole[order], at) for f in (np.minimum, np.maximum))
        return self.id, self.keys, [np.where(low == high, low, np.uint64(0)), np.minimum.reduceat(self.ids[self.rows(self.first)][order], at)]

    def pass_on(self, lists: list[list[bytes]] | None) -> tuple[np.ndarray, np.ndarray]:
        """With what came back about the keys: which units go on, and which windows of the block are known to go."""
        mixed, least = facts(lists, ["<u1", "<i8"])
        goes_on = mixed.astype(bool)[self.place]
        done = np.flatnonzero(~goes_on)
        row, key, first, last = self.rows(self.first[done]), self.place[done], self.first[done], self.last[done]
        # all that is not the first of its group: of a later id, or behind another one in the same row
        order = np.lexsort((first, row, key))
        again = np.zeros(len(done), dtype=bool)
        again[order[1:]] = (key[order][1:] == key[order][:-1]) & (row[order][1:] == row[order][:-1])
        late = again | (self.ids[row] > least[key])
        return goes_on, self._covered([first[late], last[late] + 1], [unpacked(x, "<i8", "sorted") for x in self.row_of["late"] or []])

    def _covered(self, *runs: list[np.ndarray]) -> np.ndarray:
        edges = np.zeros(len(self.text) + 1, dtype=np.int32)
        for starts, ends in (r for r in runs if r):
            np.add.at(edges, starts, 1)
            np.add.at(edges, ends, -1)
        return np.cumsum(edges[:-1], dtype=np.int32) > 0

    def next_state(self, lists: list[list[bytes]] | None, width: int) -> dict:
        """The block for the next pass: units that go on cut into units of at most ``width`` windows."""
        goes_on, late = self.pass_on(lists)
        at, first, last = self.at[goes_on], self.first[goes_on], self.last[goes_on]
        near, far = (at - last) // width, (at - first) // width
        counts = far - near + 1
        at, first, last, far = (np.repeat(x, counts) for x in (at, first, last, far))
        cell = far - (np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts))
        first, last = np.maximum(first, at - cell * width - width + 1), np.minimum(last, at - cell * width)
        return {**{k: self.row_of[k] for k in ("block", "n_bytes", "ids", "sizes", "text")}, "n_units": len(at),
                "units": [packed(at, "sorted"), packed((at - first).astype("<u2")), packed((at - last).astype("<u2"))],
                "late": [packed(x, "sorted") for x in _edges(late)]}

    def removed(self, lists: list[list[bytes]] | None) -> np.ndarray:
        """Which bytes of the block go, after the last pass."""
        starts, ends = _edges(self.pass_on(lists)[1])
        return self._covered([starts, ends + self.length - 1])


def _edges(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of marked places."""
    turns = np.flatnonzero(np.diff(np.concatenate([[False], marked, [False]]).astype(np.int8)))
    return turns[::2], turns[1::2]


def _settle(starts: np.ndarray, run: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
    """Per key: are its spans different, and the least id."""
    whole, first = values
    low, high = np.minimum.reduceat(whole, starts), np.maximum.reduceat(whole, starts)
    return [((low != high) | (low == 0)).astype(np.uint8)[run], np.minimum.reduceat(first, starts)[run]]


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``starts`` and ``ends`` of the maximal removed runs (bytes), and ``kept`` (binary).

    Removed is each byte that is covered by a string of ``length`` bytes which also starts earlier: in a row of smaller id, or
    before in the same row. A null text is empty; texts shorter than ``length`` stay. Ids are integers; null ids come first. Rows of equal ids
    stand at the same place: none is earlier, so they do not remove each other's bytes. An empty table gives no rows. Other columns
    are not looked at. Cores and spans count as equal if their 64-bit hashes agree. A block's texts, and one text, have to fit a task.
    """
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} has to be an integer, since it gives the order")
    if length < DIGIT + 8:
        raise ValueError(f"length has to be at least {DIGIT + 8}")

    def block(number: int, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in batch.column("text")]
        whole = b"".join(texts)
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([len(whole)], pa.int64()), pa.array([batch.column("id").to_pylist()], pa.list_(pa.int64())),
             pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([zstandard.ZstdCompressor(level=6).compress(whole)], pa.binary()),
             pa.array([0], pa.int64()), pa.array([None], pa.list_(pa.binary())), pa.array([None], pa.list_(pa.binary()))], names=state.names)

    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    state = pa.schema([("block", pa.int64()), ("n_bytes", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("text", pa.binary()),
                       ("n_units", pa.int64()), ("units", pa.list_(pa.binary())), ("late", pa.list_(pa.binary()))])
    out = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("kept", pa.binary())])

    def told(blocks: DataFrame, width: int) -> DataFrame:
        """A pass: the blocks, each with what the others say about its cores."""
        n_bytes, n_units = blocks.agg(F.sum("n_bytes"), F.sum("n_units")).first()
        # at first there is an anchor about every half of the places that it can have in a window
        entries = n_units if width else (n_bytes or 0) // ((length - DIGIT) // 2 + 1)
        groups = stored(exchange(published(blocks, lambda b: Block(b, length, width).entries(), parts_for(entries or 0)), ["<u8", "<i8"], _settle), "suffix-groups")
        return blocks.join(gathered(groups, "group"), F.col("block") == F.col("group_block"), "left")

    def each(make: Callable[[dict], pa.RecordBatch]):
        return lambda batches: (make(b) for batch in batches for b in _rows(batch))

    def cut(b: dict) -> pa.RecordBatch:
        block = Block(b, length, 1)
        gone = block.removed(b["group"])
        columns: list[list] = [[], [], []]
        for lo, n in zip(block.starts.tolist(), block.sizes.tolist()):
            own = gone[lo : lo + n]
            starts, ends = _edges(own)
            columns[0].append(starts)
            columns[1].append(ends)
            columns[2].append(block.text[lo : lo + n][~own].tobytes() if len(starts) else block.text[lo : lo + n].tobytes())
        return pa.RecordBatch.from_arrays([pa.array(b["ids"], pa.int64()), pa.array(block.sizes), *(pa.array(c, f.type) for c, f in zip(columns, list(out)[2:]))], schema=out)

    def after(blocks: Callable[[], DataFrame], width: int, narrower: int) -> Callable[[], DataFrame]:
        step = each(lambda b: pa.RecordBatch.from_pylist([Block(b, length, width).next_state(b["group"], narrower)], schema=state))
        return lambda: settled(spark, lambda: told(blocks(), width).mapInArrow(step, _BLOCK), "suffix-units")   # deletes the pass before

    widths, blocks = _widths(length), lambda: stored_blocks(rows, block, _BLOCK, "suffix-blocks", block_bytes=BLOCK_BYTES)
    for width, narrower in zip([0, *widths], widths):
        blocks = after(blocks, width, narrower)
    result = told(blocks(), 1).mapInArrow(each(cut), "id long, n_bytes long, starts array<long>, ends array<long>, kept binary")
    return result.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType)).withColumnRenamed("id", id_col)

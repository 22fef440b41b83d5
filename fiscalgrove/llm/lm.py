"""Language-model scores by deleted interpolation.

The model mixes three maximum-likelihood estimates of a token: after its predecessor, on its own, and
uniform over the vocabulary and one unknown word. The weights depend on how often the predecessor was seen (a bucket of its
count) and are learned by expectation-maximisation on held-out counts: each training token in turn is
deleted from the counts and predicted by the rest. Counts cover all training documents; what a block of documents needs to
know of them comes back to it through exchanges of words and of pairs (see ``blocks``), so no task
and no broadcast holds the model as a whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalgrove.llm.blocks import exchange, facts, gathered, packed, parts_for, published, stored_blocks, unpacked
from fiscalgrove.llm.shared import freed, stored

FOLDS, HELD_OUT = 7, 2
EM_ROUNDS = 40
#: least weight of each estimate, so that no token has probability zero
FLOOR = 1e-4
#: histogram cells per octave of a ratio
CELLS = 2

_BLOCK = ("block long, ids array<string>, held array<boolean>, lengths binary, tokens binary, words binary, "
          "n_words long, n_tokens long, n_train long")


def held_out(doc_id: str | None) -> bool:
    return zlib.crc32((doc_id or "").encode()) % FOLDS == HELD_OUT


def _encoded(block: int, rows: pa.RecordBatch) -> pa.RecordBatch:
    """Tokens as places in the block's own list of words, which is sorted by hash. The end of a text is the empty word."""
    index: dict[bytes, int] = {b"": 0}
    add, lengths, ids = index.setdefault, [], []
    parts = []
    for text in rows.column("text"):
        words = (text.as_py() or "").encode("utf-8", "surrogatepass").lower().split()
        parts.append(np.array([add(w, len(index)) for w in words] + [0], dtype=np.uint32))
        lengths.append(len(words) + 1)
    ids = rows.column("id").to_pylist()
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in index], dtype=np.uint64)
    order = np.argsort(hashes)
    place = np.empty(len(order), dtype=np.uint32)
    place[order] = np.arange(len(order), dtype=np.uint32)
    held = [held_out(i) for i in ids]
    n_train = sum(n for n, h in zip(lengths, held) if not h)
    columns = [[block], [ids], [held], [packed(np.array(lengths, dtype=np.uint32))], [packed(place[np.concatenate(parts)])],
               [packed(hashes[order], "sorted")], [len(index)], [sum(lengths)], [n_train]]
    kinds = [pa.int64(), pa.list_(pa.string()), pa.list_(pa.bool_()), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in _BLOCK.split(", ")])


class Block:
    """A stored block, unpacked: tokens and what precedes each, as places in the block's words."""

    def __init__(self, row: dict) -> None:
        self.id, self.ids, self.held = row["block"], row["ids"], np.array(row["held"], dtype=bool)
        self.lengths = unpacked(row["lengths"], "<u4").astype(np.int64)
        self.tokens = unpacked(row["tokens"], "<u4")
        self.words = unpacked(row["words"], "<u8", "sorted")
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.training = np.repeat(~self.held, self.lengths)

    def word_keys(self) -> tuple[int, np.ndarray, list[np.ndarray]]:
        return self.id, self.words, [np.bincount(self.tokens[self.training], minlength=len(self.words)).astype(np.int64)]

    def before(self) -> np.ndarray:
        """The end of a text also stands before its first token. Every text ends with it."""
        end = self.tokens[-1]
        before = np.concatenate([[end], self.tokens[:-1]])
        return before

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct pairs' keys, sorted, and each token's place among them."""
        first, second = self.words[self.before()], self.words[self.tokens]
        keys = (first * np.uint64(0x9E3779B97F4A7C15) + (second ^ (second >> np.uint64(29)))) * np.uint64(0xBF58476D1CE4E5B9)
        keys ^= keys >> np.uint64(31)
        keys *= np.uint64(0x94D049BB133111EB)
        keys ^= keys >> np.uint64(30)
        return np.unique(keys, return_inverse=True)

    def pair_keys(self) -> tuple[int, np.ndarray, list[np.ndarray]]:
        keys, place = self.pairs()
        return self.id, keys, [np.bincount(place[self.training], minlength=len(keys)).astype(np.int32)]


def _totals(starts: np.ndarray, run: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
    return [np.add.reduceat(values[0].astype(np.int64), starts)[run]]


def bucket(counts: np.ndarray) -> np.ndarray:
    """0 for nothing, else one more than the binary logarithm."""
    return np.where(counts > 0, 1 + np.floor(np.log2(np.maximum(counts, 1))), 0).astype(np.int64)


def _cells(block: Block, single: np.ndarray, pair: np.ndarray, n: int, v: int) -> tuple[np.ndarray, ...]:
    """Deleted estimates of the block's training tokens, gathered by bucket and by the logarithms of the two
    estimates over the uniform one: (bucket, count, sum of pair estimates, sum of single estimates) per cell."""
    _, place = block.pairs()
    t = block.training
    context = single[block.before()[t]] - 1
    two = np.where(context > 0, (pair[place][t] - 1) / np.maximum(context, 1), 0.0)
    one = (single[block.tokens[t]] - 1) / max(n - 1, 1)
    log = lambda x: np.where(x > 0, 1 + np.maximum(np.floor(CELLS * np.log2(np.maximum(x * (v + 1), 2.0**-40))) + 40 * CELLS, 0), 0).astype(np.int64)
    code = (bucket(context) * 1024 + log(two)) * 1024 + log(one)
    cells, at, count = np.unique(code, return_inverse=True, return_counts=True)
    return cells, count, np.bincount(at, two, len(cells)), np.bincount(at, one, len(cells))


def learn(cells: np.ndarray, count: np.ndarray, two: np.ndarray, one: np.ndarray, uniform: float) -> dict[int, tuple[float, float, float]]:
    """Expectation-maximisation over the cells of each bucket, and over all of them (-1) for buckets never met."""
    out = {}
    of = cells // (1024 * 1024)
    for b in [-1, *np.unique(of).tolist()]:
        pick = (of == b) | (b == -1)
        weight, estimates = count[pick], np.stack([two[pick] / count[pick], one[pick] / count[pick], np.full(pick.sum(), uniform)])
        lam = np.full(3, 1 / 3)
        for _ in range(EM_ROUNDS):
            share = lam[:, None] * estimates
            lam = (share / share.sum(axis=0) * weight).sum(axis=1) / weight.sum()
            lam = np.maximum(lam, FLOOR)
            lam /= lam.sum()
        out[int(b)] = tuple(lam.tolist())
    return out


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    A null text is empty: its one token is the end. The model learns from documents whose id, as text, has a CRC-32 that
    leaves another remainder than 2 when divided by 7; a null id counts as empty text. Rows of equal ids stand for themselves. If no
    document is left to learn from, all estimates but the uniform one are zero. An empty table gives no rows. Other
    columns are not looked at. Words and pairs are told apart by 64-bit hashes.
    """
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    blocks = stored_blocks(rows, _encoded, _BLOCK, "lm-blocks")
    sizes = blocks.agg(F.sum("n_words"), F.sum("n_tokens"), F.sum("n_train")).first()
    n = sizes[2] or 0
    words = stored(exchange(published(blocks, lambda r: Block(r).word_keys(), parts_for(sizes[0] or 0)), ["<i8"], _totals), "lm-words")
    v = words.agg(F.sum("n")).first()[0] or 0
    # pairs are at most as many as tokens; about half of them repeat within a block
    pairs = exchange(published(blocks, lambda r: Block(r).pair_keys(), parts_for((sizes[1] or 0) // 2)), ["<i4"], _totals)
    # joined anew by both jobs that read it: a stored copy of all blocks and facts would take more disk than the shuffles do
    known = blocks.join(gathered(words, "single"), F.col("block") == F.col("single_block"), "left").join(
        gathered(stored(pairs, "lm-pairs"), "pair"), F.col("block") == F.col("pair_block"), "left").drop("single_block", "pair_block")

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, np.ndarray, np.ndarray]]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield Block(row), facts(row["single"], ["<i8"])[0], facts(row["pair"], ["<i8"])[0]

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, single, pair in opened(batches):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _cells(block, single, pair, n, v)], names=["cell", "n", "two", "one"])

    # a cell for each bucket and pair of logarithms at most: a bounded table
    with freed(docs.sparkSession):
        cells = known.mapInArrow(histogram, "cell long, n long, two double, one double").groupBy("cell").agg(
            F.sum("n").alias("n"), F.sum("two").alias("two"), F.sum("one").alias("one")).toPandas().sort_values("cell")
    uniform = 1 / (v + 1)
    weights = learn(*(cells[c].to_numpy() for c in ("cell", "n", "two", "one")), uniform) if len(cells) else {-1: (0.0, 0.0, 1.0)}

    out = pa.schema([("id", pa.string()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket = np.array([weights.get(b, weights[-1]) for b in range(66)])
        for block, single, pair in opened(batches):
            _, place = block.pairs()
            own, context = single[block.tokens], single[block.before()]
            lam = by_bucket[bucket(context)]
            two = np.where(context > 0, pair[place] / np.maximum(context, 1), 0.0)
            p = lam[:, 0] * two + lam[:, 1] * own / max(n, 1) + lam[:, 2] * uniform
            # an unseen predecessor says nothing: its share goes to the other two
            p = np.where(context > 0, p, p / np.maximum(1 - lam[:, 0], FLOOR))
            sums = lambda x: np.add.reduceat(x, block.starts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.ids, pa.string()), pa.array(block.held), pa.array(block.lengths), pa.array(sums((own > 0).astype(np.int64))),
                 pa.array(sums(np.log10((own + 1) / (n + v + 1)))), pa.array(sums(np.log10(p)))], schema=out)

    result = known.mapInArrow(scored, "id string, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return result.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "held_out", "n_tokens", "n_known",
                         F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")

"""Hard negatives by a secondary sort.

Scored pairs go to (anchor, descending score, id) keys: they are repartitioned by anchor and sorted inside partitions in the
same shuffle, and an iterator reads each anchor's pairs from the best score down. A positive opens a window, a negative is
emitted for every open window that takes its score, and a window closes when it is full. At no time is more held of an
anchor than its few open windows.

All pairs would be anchors times rows. So the vectors meet in tiles first: blocks of anchors against slices of the rows.
Slices stream through a task as Arrow batches, scores are matrix products, and of each slice only those pairs go on that can be
among the first: first those of positives, then, once an anchor's positives are known, those of each of its windows. This
leaves out only pairs that others of the same slice beat, so the result is that of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalgrove.llm.shared import stored

#: positives of an anchor, and negatives of a positive
POSITIVES, NEGATIVES = 5, 5
#: a negative's score is from LOW % to HIGH % of its positive's
LOW, HIGH = 80, 100
#: anchors in a block; slices of the rows, and rows from which a further slice pays
ANCHORS, SLICES, SLICE_ROWS = 65_536, 64, 4096
#: scores computed at once
SCORES = 1 << 21
_PAIRS = "a long, anchor_id long, kind int, score long, late boolean, id long, n long"
_NONE = np.iinfo(np.int64).min


def quantised(vector: Column, factor: int) -> Column:
    """floor(factor * x) of each component as a long; null if the vector or a component is null or not finite."""
    cells = F.transform(vector, lambda x: F.floor(x.cast("double") * factor).try_cast("long"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    return F.when(F.forall(vector, finite) & F.forall(cells, lambda x: x.isNotNull()), cells)


def prepared(rows: DataFrame, id_col: str, vector_col: str, label: Column, anchor: Column, factor: int) -> DataFrame:
    """The rows that take part, stored: ``n``, ``id``, ``label``, ``vector`` (longs), ``is_anchor``."""
    found = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("string").alias("label"), quantised(F.col(vector_col), factor).alias("vector"),
                        F.coalesce(anchor, F.lit(False)).alias("is_anchor"))
    return stored(found.where("label is not null and vector is not null").select(F.monotonically_increasing_id().alias("n"), "*"), "negatives-rows")


def tiles(rows: DataFrame, windows: DataFrame | None = None) -> DataFrame:
    """Anchors and rows by block and slice (``block``, ``slice``), each tile's anchors first. Rows go to every block, anchors to every slice."""
    count, anchors = rows.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
    blocks, slices = max(1, -(-anchors // ANCHORS)), min(SLICES, max(1, -(-count // SLICE_ROWS)))
    block, slice_ = (F.pmod(F.xxhash64("n", F.lit(i)), F.lit(m)).cast("int") for i, m in enumerate((blocks, slices)))
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    chosen = rows.where("is_anchor")
    if windows is not None:
        chosen = chosen.join(windows, F.col("n") == F.col("a")).drop("a")
    else:
        chosen = chosen.withColumn("windows", F.lit(None).cast("array<bigint>"))
    head = chosen.select(block.alias("block"), every(slices).alias("slice"), F.lit(0).alias("part"), "n", "id", "label", "vector", "windows")
    rest = rows.select(every(blocks).alias("block"), slice_.alias("slice"), F.lit(1).alias("part"), "n", "id", "label", "vector", F.lit(None).cast("array<bigint>").alias("windows"))
    return head.unionByName(rest).repartition(blocks * slices, "block", "slice").sortWithinPartitions("block", "slice", "part", "id", "n")


def matrix(vectors: pa.Array) -> np.ndarray:
    """One row a vector; shorter ones end in zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.values.to_numpy(zero_copy_only=False)[vectors.offsets[0].as_py() : vectors.offsets[-1].as_py()]
    width = int(sizes.max()) if len(sizes) else 0
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products as longs; exact, in the shortest numbers that hold all sums (a sum beyond a long wraps around)."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    most = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0)) * width
    if most < 1 << 53:
        kind = np.float32 if most < 1 << 24 else np.float64
        return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)
    return a @ b.T


class Best:
    """For each of some lists the first k pairs by descending score, null ids last, id, row."""

    def __init__(self, lists: int, k: int):
        self.k = k
        self.score = np.full((lists, k), _NONE)
        self.late, self.empty = np.zeros((lists, k), bool), np.ones((lists, k), bool)
        self.id, self.n = np.zeros((lists, k), np.int64), np.zeros((lists, k), np.int64)

    def add(self, own: np.ndarray, scores: np.ndarray, allowed: np.ndarray, late: np.ndarray, ids: np.ndarray, ns: np.ndarray) -> None:
        """own: the lists; a row of scores each. Columns come by (late, id, n), so of equal scores the first columns are first."""
        some = np.flatnonzero(allowed.any(axis=1))
        if not len(some):
            return
        own, scores, allowed = own[some], scores[some], allowed[some]
        width = scores.shape[1]
        if width > self.k:
            if scores.max() < (1 << 40) and scores.min() > -(1 << 40):
                key = np.where(allowed, scores * width + (width - 1 - np.arange(width)), _NONE)
                at = np.argpartition(key, width - self.k, axis=1)[:, width - self.k :]
            else:
                at = np.lexsort((np.broadcast_to(np.arange(width), scores.shape), -scores, ~allowed), axis=1)[:, : self.k]
        else:
            at = np.broadcast_to(np.arange(width), scores.shape)
        pick = lambda x: np.take_along_axis(x, at, axis=1)
        both = [np.concatenate([old, new], axis=1) for old, new in (
            (self.score[own], pick(scores)), (self.late[own], late[at]), (self.empty[own], ~pick(allowed)), (self.id[own], ids[at]), (self.n[own], ns[at]))]
        score, late_, empty, id_, n = both
        order = np.lexsort((n, id_, late_, -score, empty), axis=1)[:, : self.k]
        for name, x in (("score", score), ("late", late_), ("empty", empty), ("id", id_), ("n", n)):
            getattr(self, name)[own] = np.take_along_axis(x, order, axis=1)


class Tile:
    """A block of anchors that meets the batches of a slice."""

    def __init__(self, positives: int, negatives: int, low: int, high: int):
        self.limits = positives, negatives, low, high
        self.parts: list[pa.RecordBatch] = []
        self.best: list[Best] | None = None

    def open(self) -> None:
        positives, negatives, _, _ = self.limits
        table = pa.Table.from_batches(self.parts).combine_chunks()
        self.ns, self.ids = table["n"].to_numpy(), table["id"]
        self.labels = table["label"].to_numpy(zero_copy_only=False).astype(object)
        self.vectors = matrix(table["vector"].combine_chunks()) if table.num_rows else np.zeros((0, 0), np.int64)
        given = table["windows"].to_pylist()
        self.finding = all(w is None for w in given)
        # an anchor's windows: what its positives score, each value once
        self.windows = np.array([(w or [])[:positives] + [_NONE] * (positives - len(w or [])) for w in given], np.int64).reshape(-1, positives)
        self.best = [Best(len(self.ns), positives)] if self.finding else [Best(len(self.ns), negatives) for _ in range(positives)]
        self.parts = []

    def meet(self, batch: pa.RecordBatch) -> None:
        if self.best is None:
            self.open()
        if not len(self.ns):
            return
        late = batch.column("id").is_null().to_numpy(zero_copy_only=False)
        ids, ns = batch.column("id").fill_null(0).to_numpy(), batch.column("n").to_numpy()
        order = np.lexsort((ns, ids, late))
        late, ids, ns = late[order], ids[order], ns[order]
        labels = batch.column("label").to_numpy(zero_copy_only=False).astype(object)[order]
        names = {x: i for i, x in enumerate(dict.fromkeys([*self.labels, *labels]))}
        mine, theirs = (np.array([names[x] for x in xs]) for xs in (self.labels, labels))
        vectors = matrix(batch.column("vector"))[order]
        _, _, low, high = self.limits
        step = max(1, SCORES // max(1, len(ns)))
        for i in range(0, len(self.ns), step):
            own = np.arange(i, min(i + step, len(self.ns)))
            scores = products(self.vectors[own], vectors)
            same = mine[own, None] == theirs[None, :]
            if self.finding:
                self.best[0].add(own, scores, same & (self.ns[own, None] != ns[None, :]), late, ids, ns)
                continue
            for best, window in zip(self.best, self.windows[own].T):
                p = window[:, None].astype(object) if np.abs(scores).max(initial=0) > 1 << 55 else window[:, None]
                some = window != _NONE
                taken = np.zeros(scores.shape, bool)
                taken[some] = ~same[some] & ((low * p[some] <= 100 * scores[some].astype(p.dtype)) & (100 * scores[some].astype(p.dtype) <= high * p[some])).astype(bool)
                best.add(own, scores, taken, late, ids, ns)

    def pairs(self) -> pa.RecordBatch:
        if self.best is None and self.parts:
            self.open()
        columns: list[list] = [[] for _ in range(7)]
        anchor_ids = self.ids.to_pylist() if self.best is not None else []
        for best in self.best or []:
            lists, places = np.nonzero(~best.empty)
            late = best.late[lists, places]
            columns[0] += self.ns[lists].tolist()
            columns[1] += [anchor_ids[i] for i in lists.tolist()]
            columns[2] += [0 if self.finding else 1] * len(lists)
            columns[3] += best.score[lists, places].tolist()
            columns[4] += late.tolist()
            columns[5] += [None if gone else x for gone, x in zip(late.tolist(), best.id[lists, places].tolist())]
            columns[6] += best.n[lists, places].tolist()
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["a", "anchor_id", "kind", "score", "late", "id", "n"])


def candidates(tiled: DataFrame, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """Per anchor and slice the first pairs of ``tiles``: of its positives, or of each window that the anchor brings."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tile = None, None
        for batch in batches:
            key = batch.column("block").to_numpy() * np.int64(1 << 32) + batch.column("slice").to_numpy() * np.int64(2) + batch.column("part").to_numpy()
            at = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
            for a, b in zip(at, at[1:]):
                if a == b:
                    continue
                if now != (key[a] & ~1):
                    if tile:
                        yield tile.pairs()
                    now, tile = key[a] & ~1, Tile(positives, negatives, low, high)
                part = batch.slice(a, b - a)
                if key[a] & 1:
                    if tile.parts or tile.best is not None:  # a block without anchors has nothing to find
                        tile.meet(part)
                else:
                    tile.parts.append(part)
        if tile:
            yield tile.pairs()

    return tiled.mapInArrow(stream, _PAIRS)


def streamed(pairs: DataFrame, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """pairs: candidates of both kinds (0: positives, 1: negatives), a pair once or more. The secondary sort and its iterator."""
    ordered = pairs.repartition("a").sortWithinPartitions("a", F.desc("score"), "kind", "late", F.asc_nulls_last("id"), "n")

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, seen, last, windows = None, 0, None, []
        for batch in batches:
            out: list[tuple] = []
            for a, anchor_id, kind, score, id_, n in zip(*(batch.column(c).to_pylist() for c in ("a", "anchor_id", "kind", "score", "id", "n"))):
                if a != anchor:
                    anchor, seen, last, windows = a, 0, None, []
                if last == (kind, n):
                    continue
                last = (kind, n)
                if kind == 0:
                    if seen < positives:
                        seen += 1
                        windows.append([id_, score, 0])
                    continue
                for window in windows:
                    if window[2] < negatives and low * window[1] <= 100 * score <= high * window[1]:
                        window[2] += 1
                        out.append((anchor_id, window[0], window[2], id_, window[1], score))
                # what is full, or whose least score is passed, takes no more
                windows = [w for w in windows if w[2] < negatives and low * w[1] <= 100 * score]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                                             names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    return ordered.mapInArrow(mine, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def mine(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None, factor: int = 256,
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """For each anchor (a row where ``anchor`` holds) and each of its first ``positives`` other rows of the same label, the first
    ``negatives`` rows of other labels whose score is from ``low`` to ``high`` % of the positive's: ``anchor_id``, ``positive_id``, ``rank``
    (from 1), ``negative_id``, ``positive_score``, ``negative_score``. Scores are inner products of floor(factor * component).

    High scores come first, of equal ones the smaller id, null ids last, then any fixed order of rows. Rows with a null label or vector, or a
    component that is null, not finite, or beyond a long, take no part. Of vectors of different lengths the longer one's rest counts as
    times zero. Rows with null or repeated ids are rows of their own; a row is no positive of itself, a copy of it is. Positives below
    zero have no negatives (the range is empty). An empty table gives no rows. Other columns are not looked at.
    """
    if high > 100:
        raise ValueError("a negative's score is at most its positive's: windows open at their positive")
    found = prepared(rows, id_col, vector_col, F.col("label") if label is None else label, anchor, factor)
    limits = (positives, negatives, low, high)
    best = candidates(tiles(found), *limits)
    firsts = stored(_first(best, positives), "negatives-positives")
    windows = firsts.where("score >= 0").groupBy("a").agg(F.reverse(F.array_sort(F.collect_set("score"))).alias("windows"))
    negative = candidates(tiles(found, windows), *limits)
    return streamed(firsts.unionByName(negative), *limits)


def _first(pairs: DataFrame, k: int) -> DataFrame:
    """The first k pairs of each anchor, by the same secondary sort."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, seen = None, 0
        for batch in batches:
            kept = []
            for i, a in enumerate(batch.column("a").to_pylist()):
                anchor, seen = (a, 1) if a != anchor else (a, seen + 1)
                if seen <= k:
                    kept.append(i)
            yield batch.take(pa.array(kept, pa.int64()))

    ordered = pairs.repartition("a").sortWithinPartitions("a", F.desc("score"), "late", F.asc_nulls_last("id"), "n")
    return ordered.mapInArrow(first, _PAIRS)

"""Periodic runs of words: passages that say the same thing over and over.

A run is a stretch of consecutive words with a smallest period q that no neighbouring word extends. Every run contains a
Lyndon word of length q (its root) that is the longest Lyndon word at its place, in the usual order of words or in the
reversed one. So each place gives two candidate roots; each is extended to both sides by the longest common extension of
two places. Those come from the suffix tree (Ukkonen) of the words, to the right, and of the reversed words, to the left: the
depth of the lowest common ancestor of two leaves, which an Euler tour with a sparse table of minima gives in constant time.

Trees are built for stretches that can hold a run only. In a run of length L >= max(6, 4 q) every five words recur
inside it, and every three words at least twice more; words where that fails are in no run, so leaving them out loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: least length of a run in words, and in periods; the screen below is made for these and for greater ones
LEAST_WORDS, LEAST_PERIODS = 6, 4
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
#: factors that make a number of three or five neighbouring words; equal passages have equal numbers
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def _passages(words: np.ndarray, width: int) -> np.ndarray:
    n = len(words) - width + 1
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out += (words[i : i + n] ^ (words[i : i + n] >> np.uint64(29))) * _MIX[i]
    return out


def _recurring(words: np.ndarray) -> np.ndarray:
    """For each place but the last four: do its five words occur twice, and each three of them three times?"""
    _, at, n = np.unique(_passages(words, 5), return_inverse=True, return_counts=True)
    _, at3, n3 = np.unique(_passages(words, 3), return_inverse=True, return_counts=True)
    often = n3[at3] >= 3
    return (n[at] >= 2) & often[:-2] & often[1:-1] & often[2:]


def stretches(words: np.ndarray) -> list[tuple[int, int]]:
    """words: numbers (uint64) that are equal for equal words. Begin and end of all stretches that can hold a run."""
    if len(words) < LEAST_WORDS:
        return []
    ordered = np.sort(_passages(words, 5))
    if not (ordered[1:] == ordered[:-1]).any():
        return []
    found, todo = [], [(0, len(words))]
    while todo:
        a, b = todo.pop()
        marks = np.flatnonzero(np.diff(np.concatenate([[False], _recurring(words[a:b]), [False]]).astype(np.int8)))
        parts = [(a + x, a + y + 4) for x, y in zip(marks[::2].tolist(), marks[1::2].tolist()) if y - x + 4 >= LEAST_WORDS]
        if parts == [(a, b)]:
            found.append((a, b))
        else:
            todo += parts
    return sorted(found)


def suffix_tree(s: list[int], letters: int) -> tuple[dict[int, int], list[int], list[int]]:
    """Ukkonen's tree of ``s``, whose last letter occurs once. Letters are below ``letters``.

    Edges (node * letters + first letter -> child), the string depth of each node, and each node's suffix (-1: inner node).
    """
    n = len(s)
    edges: dict[int, int] = {}
    start, depth, suffix, link = [0], [0], [-1], [0]
    node = edge = length = left = 0
    for i, c in enumerate(s):
        waiting = 0
        left += 1
        while left:
            if not length:
                edge = i
            key = node * letters + s[edge]
            child = edges.get(key)
            if child is None:
                edges[key] = len(start)
                start.append(i)
                suffix.append(i - left + 1)
                depth.append(n - i + left - 1)
                link.append(0)
                if waiting:
                    link[waiting] = node
                    waiting = 0
            else:
                begin = start[child]
                if suffix[child] < 0:
                    size = depth[child] - depth[node]
                    if length >= size:
                        edge += size
                        length -= size
                        node = child
                        continue
                if s[begin + length] == c:
                    length += 1
                    if waiting:
                        link[waiting] = node
                    break
                split = len(start)
                start += [begin, i]
                suffix += [-1, i - left + 1]
                depth += [left - 1, n - i + left - 1]
                link += [0, 0]
                edges[key] = split
                start[child] = begin + length
                edges[split * letters + s[begin + length]] = child
                edges[split * letters + c] = split + 1
                if waiting:
                    link[waiting] = split
                waiting = split
            left -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - left + 1
    return edges, depth, suffix


class Extensions:
    """The suffix tree of ``words`` (numbers from 1) with constant-time lowest common ancestors."""

    def __init__(self, words: np.ndarray):
        n, letters = len(words), int(words.max()) + 1
        edges, depth, suffix = suffix_tree([*words.tolist(), 0], letters)
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        order = np.argsort(keys)
        children = np.fromiter(edges.values(), np.int64, len(edges))[order]
        parents = keys[order] // letters
        del edges
        nodes = self._tour(children.tolist(), np.searchsorted(parents, np.arange(len(depth) + 1)).tolist())
        depths, suffixes = np.array(depth, np.int32), np.array(suffix, np.int64)
        self.least = [depths[nodes]]
        for k in range(len(nodes).bit_length() - 1):
            self.least.append(np.minimum(self.least[k][: -(1 << k)], self.least[k][1 << k :]))
        first, last = np.empty(len(depths), np.int64), np.empty(len(depths), np.int64)
        first[nodes[::-1]] = np.arange(len(nodes) - 1, -1, -1)
        last[nodes] = np.arange(len(nodes))
        leaves = np.flatnonzero(suffixes >= 0)
        self.at = np.empty(n + 1, np.int64)
        self.at[suffixes[leaves]] = first[leaves]
        self.n = n
        self._order(nodes, suffixes, depths, children, parents, first, last)

    @staticmethod
    def _tour(children: list[int], begin: list[int]) -> np.ndarray:
        tour: list[int] = []
        stack = [0]
        while stack:
            v = stack.pop()
            if v < 0:
                tour.append(~v)
                continue
            tour.append(v)
            for i in range(begin[v + 1] - 1, begin[v] - 1, -1):
                stack.append(~v)
                stack.append(children[i])
        return np.array(tour, np.int64)

    def _order(self, nodes, suffixes, depths, children, parents, first, last) -> None:
        """Ranks of the suffixes in the order of words, and in the reversed order; a prefix comes first in both."""
        n = self.n
        is_leaf = suffixes[nodes] >= 0
        ordered = suffixes[nodes[is_leaf]][1:]  # without the empty suffix
        self.rank = np.empty(n, np.int64)
        self.rank[ordered] = np.arange(n)
        above = np.empty(len(depths), np.int64)
        above[children] = parents
        parent = np.empty(n + 1, np.int64)
        leaves = np.flatnonzero(suffixes >= 0)
        parent[suffixes[leaves]] = above[leaves]
        parent = parent[:n]
        before = np.concatenate([[0], np.cumsum(is_leaf)])
        whole = depths[parent] == n - np.arange(n)  # the suffix ends where its parent does: it is a prefix of what else is below
        longer = np.where(whole, before[last[parent] + 1] - before[first[parent]] - 1, 0)
        opened = np.zeros(n + 1, np.int64)
        np.add.at(opened, self.rank + 1, whole & (longer > 0))
        np.add.at(opened, np.minimum(self.rank + 1 + longer, n), -(whole & (longer > 0)).astype(np.int64))
        self.reversed_rank = n - 1 - self.rank - longer + np.cumsum(opened)[self.rank]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from place a on equal those from place b on (a != b)."""
        x, y = self.at[a], self.at[b]
        lo, hi = np.minimum(x, y), np.maximum(x, y)
        k = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        out = np.empty(len(lo), np.int64)
        for step in np.unique(k):
            own = k == step
            level = self.least[step]
            out[own] = np.minimum(level[lo[own]], level[hi[own] - (1 << int(step)) + 1])
        return out


def next_smaller(rank: list[int]) -> np.ndarray:
    """For each place the next one of smaller rank; there the longest Lyndon word of the place ends."""
    out, stack = [len(rank)] * len(rank), []
    for i, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return np.array(out, np.int64)


def runs_of(words: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> np.ndarray:
    """words: numbers from 1. All runs as rows of start, length and period, by start, then period."""
    n = len(words)
    right, left = Extensions(words), Extensions(words[::-1])
    roots = []
    for rank in (right.rank, right.reversed_rank):
        period = next_smaller(rank.tolist()) - np.arange(n)
        at = np.flatnonzero(least_periods * period <= n)
        roots.append(np.stack([at, period[at]], axis=1))
    at, period = np.concatenate(roots).T
    forward, backward = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    inside = at + period < n
    forward[inside] = right.common(at[inside], (at + period)[inside])
    inside = at > 0
    backward[inside] = left.common(n - at[inside], (n - at - period)[inside])
    length = period + forward + backward
    kept = length >= np.maximum(least_words, least_periods * period)
    found = np.unique(np.stack([at - backward, period, length], axis=1)[kept], axis=0)
    return found[:, [0, 2, 1]]


def document_runs(words: list[bytes], least_words: int, least_periods: int) -> list[tuple[int, int, int]]:
    hashed = np.fromiter(map(hash, words), np.int64, len(words)).astype(np.uint64)
    found = []
    for a, b in stretches(hashed):
        numbers: dict[bytes, int] = {}
        own = np.fromiter((numbers.setdefault(w, len(numbers) + 1) for w in words[a:b]), np.int64, b - a)
        found += [(a + start, length, period) for start, length, period in runs_of(own, least_words, least_periods).tolist()]
    return sorted(found, key=lambda r: (r[0], r[2]))


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by single spaces, without those that any run holds after its first period."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0).tolist()])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_words`` (long), ``runs`` (start, length and period in words, by start, then
    period) and ``collapsed``, the text's words without the repeats, joined by single spaces.

    Words are what lies between spaces, tabs, line feeds, vertical tabs, form feeds and carriage returns. A run has at least
    ``least_words`` words and ``least_periods`` periods (6 and 4 at least). Null and empty texts have no words, no runs and an empty
    ``collapsed``. Rows with null or repeated ids stay rows of their own; other columns are not looked at. An empty table gives no
    rows. A text is worked on whole, in one task: a stretch that may hold a run takes about 1 KB a word.
    """
    if least_words < LEAST_WORDS or least_periods < LEAST_PERIODS:
        raise ValueError("runs have at least 6 words and 4 periods")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found, collapsed = [], [], []
            for text in batch.column("text"):
                words = (text.as_py() or b"").split()
                runs = document_runs(words, least_words, least_periods)
                sizes.append(len(words))
                found.append([{"start": a, "length": n, "period": q} for a, n, q in runs])
                collapsed.append(without_repeats(words, runs))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), pa.array(found, kind), pa.array(collapsed, pa.binary())],
                                             names=["id", "n_words", "runs", "collapsed"])

    cells = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    out = cells.mapInArrow(search, f"id {cells.schema['id'].dataType.simpleString()}, n_words bigint, runs {RUNS}, collapsed binary")
    return out.select(F.col("id").alias(id_col), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))

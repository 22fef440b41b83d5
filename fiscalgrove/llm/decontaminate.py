"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of ``width`` consecutive words of each benchmark item; an item of
fewer words is one window. For the patterns of one length, a table says how far the search may
jump from each block of two words: to the last place where the block ends inside a pattern, or past it
if no pattern has it. Where the jump is zero, the block ends some pattern: the patterns that
end so (a bucket) are compared word by word.

The pattern tables go to the tasks in parts of bounded size; documents pass through whole, without
a shuffle, once per part. With several parts a document's hits are joined by its row number.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalgrove.llm.shared import stored

#: bytes of benchmark text whose tables are sent to the tasks at once
PART_BYTES = 16 << 20

# lower-cases A-Z, keeps 0-9, a-z and everything beyond ASCII, makes the rest a space
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_in(text: str | None) -> list[bytes]:
    """Words of the folded text. bytes.split() knows ASCII white space only, so other bytes stay."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Patterns:
    """The Wu-Manber tables of all windows of one length."""

    def __init__(self, length: int, items_of: dict[tuple[bytes, ...], set[int]]) -> None:
        self.length, self.block = length, min(2, length)
        self.default = length - self.block + 1
        self.shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, list] = defaultdict(list)
        for pattern, items in items_of.items():
            for end in range(self.block, length + 1):
                key = b" ".join(pattern[end - self.block : end])
                self.shift[key] = min(self.shift.get(key, self.default), length - end)
            self.buckets[key].append((list(pattern), frozenset(items)))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, frozenset[int]]]:
        """(start, items) of every occurrence, in order."""
        at, n, length, default, shift = self.length - 1, len(words), self.length, self.default, self.shift.get
        single = self.block == 1
        while at < n:
            key = words[at] if single else words[at - 1] + b" " + words[at]
            jump = shift(key, default)
            if jump:
                at += jump
                continue
            start = at - length + 1
            for pattern, items in self.buckets[key]:
                if words[start : at + 1] == pattern:
                    yield start, items
            at += 1


def tables(items: list[tuple[int, str | None]], width: int) -> list[Patterns]:
    by_length: dict[int, dict] = defaultdict(lambda: defaultdict(set))
    for number, text in items:
        words = words_in(text)
        length = min(width, len(words))
        for i in range(len(words) - length + 1 if length else 0):
            by_length[length][tuple(words[i : i + length])].add(number)
    return [Patterns(length, found) for length, found in sorted(by_length.items())]


def hits_of(words: list[bytes], patterns: list[Patterns]) -> tuple[list[int], list[int], set[int]]:
    """Starts and ends (exclusive) of the maximal runs of hit words, and the items that occur."""
    spans, items = [], set()
    for p in patterns:
        for start, found in p.search(words):
            spans.append((start, start + p.length))
            items |= found
    return (*merged(spans), items)


def merged(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    starts, ends = [], []
    for start, end in sorted(spans):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def pattern_parts(benchmark: DataFrame, item_col: str, text_col: str, part_bytes: int) -> list:
    """The benchmark as broadcasts of (item number, text) pairs and item names, each of about ``part_bytes``."""
    bench = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"), F.col(text_col).cast("string").alias("text"))
    total = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // part_bytes))
    out = []
    for k in range(parts):
        items = [tuple(r) for r in bench.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == k).distinct().collect()]
        names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(names)}
        out.append(benchmark.sparkSession.sparkContext.broadcast(([(number[name], text) for name, text in items], names)))
    return out


_HITS = pa.schema([("row", pa.string()), ("n_words", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])
_HITS_DDL = "row string, n_words long, starts array<long>, ends array<long>, items array<string>"


def occurrences(docs: DataFrame, benchmark: DataFrame, row_col: str, text_col: str = "text", item_col: str = "item_id",
                item_text_col: str = "text", width: int = 10, part_bytes: int = PART_BYTES) -> DataFrame:
    """Per document: ``row`` (its ``row_col`` as text), ``n_words``, the runs of hit words as ``starts`` and ``ends``,
    ``items``: the ids of the items that occur, as a sorted array of strings.

    Null and empty texts have no words and no hits; items without words match nothing; a null item id
    is named ``null``; repeated items count once. Rows of equal or null ``row_col`` stay apart: with several parts
    the rows are stored once with a number that their hits are joined by.
    """
    shared_parts = pattern_parts(benchmark, item_col, item_text_col, part_bytes)
    narrow = docs.select(F.col(row_col).cast("string").alias("row"), F.col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("n"))
    if len(shared_parts) > 1:
        narrow = stored(narrow, "decontaminate-rows")
    found = []
    for shared in shared_parts:
        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items, names = shared.value
            patterns = tables(items, width)
            for batch in batches:
                rows = []
                for text in batch.column(1):
                    words = words_in(text.as_py())
                    starts, ends, seen = hits_of(words, patterns)
                    rows.append((len(words), starts, ends, sorted(names[i] for i in seen)))
                columns = [pa.array([r[j] for r in rows], _HITS.field(j + 1).type) for j in range(4)]
                yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), *columns, batch.column(2).cast(pa.int64())], schema=_HITS.append(pa.field("n", pa.int64())))

        found.append(narrow.mapInArrow(search, f"{_HITS_DDL}, n long"))
    if len(found) == 1:
        return found[0].drop("n")
    both = found[0]
    for more in found[1:]:
        both = both.unionByName(more)
    # runs of hit words of several parts overlap: a run starts where no earlier one reaches
    spans = F.array_sort(F.flatten(F.collect_list(F.arrays_zip("starts", "ends"))))
    grouped = both.groupBy("n").agg(F.first("row").alias("row"), F.max("n_words").alias("n_words"), spans.alias("spans"),
                                      F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def join_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [merged([(s["starts"], s["ends"]) for s in x.as_py()]) for x in batch.column("spans")]
            yield pa.RecordBatch.from_arrays([batch.column("row").cast(pa.string()), batch.column("n_words"), pa.array([r[0] for r in runs], pa.list_(pa.int64())),
                                              pa.array([r[1] for r in runs], pa.list_(pa.int64())), batch.column("items").cast(pa.list_(pa.string()))], schema=_HITS)

    return grouped.mapInArrow(join_runs, _HITS_DDL)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: its id, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``."""
    hits = occurrences(docs, benchmark, id_col, **options)
    n_hit = F.aggregate(F.zip_with("ends", "starts", lambda e, s: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return hits.select(F.col("row").cast(docs.schema[id_col].dataType).alias(id_col), "n_words", n_hit.alias("n_hit"),
                       F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                       (F.size("starts") > 0).alias("contaminated"))


def uncontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                   width: int = 10, part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows of ``docs`` in whose texts no window of the benchmark occurs, with all their columns. Rows need no key:
    each is looked at where it lies, once per part of the benchmark."""
    for shared in pattern_parts(benchmark, item_col, item_text_col, part_bytes):
        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            patterns = tables(shared.value[0], width)
            for batch in batches:
                texts = (x.as_py() for x in batch.column(text_col))
                clean = [not any(True for p in patterns for _ in p.search(words)) for words in map(words_in, texts)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs

"""The near-dedup stage against all pairs compared by brute force."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fiscalgrove.llm import similar
from tests.llm.conftest import TESTDATA


def alike(a, b):
    def shingles(text):
        w = [x.lower() for x in (text or "").split()]
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    x, y = shingles(a), shingles(b)
    return x == y or 5 * len(x & y) >= 4 * len(x | y) > 0


def plain_representatives(rows):
    """rows: (id, ASCII text). The least id of each component."""
    left, out = sorted(rows), []
    while left:
        queue, left = [left[0]], left[1:]
        out.append(queue[0][0])
        while queue:
            at = queue.pop()
            near = [r for r in left if alike(at[1], r[1])]
            queue += near
            left = [r for r in left if r not in near]
    return out


def copies(n, seed):
    """Texts of 120 words, each with a few words of its own at chosen places."""
    rnd = random.Random(seed)
    base = [rnd.choice("abcdefgh") + str(rnd.randrange(60)) for _ in range(120)]
    for _ in range(n):
        words = list(base)
        for _ in range(rnd.randrange(1, 5)):
            words[rnd.randrange(120)] = f"new{rnd.randrange(10**6)}"
        yield " ".join(words)


def test_stage_takes_out_what_is_alike(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    ours = [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, TESTDATA).collect()]
    theirs = plain_representatives([(r["doc_id"], r["text"].encode().lower().decode()) for r in docs.collect()])
    assert sorted(ours) == sorted(theirs) and {6, 145} - set(ours) == {145}


@pytest.mark.parametrize("together", [4096, 50])
def test_large_groups(spark, together):
    """In one piece, and with the members of a key in several chunks."""
    texts = [t for k in range(3) for t in copies(100, k)] + [None, "", "one", "one two", "One"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ours = [r["doc_id"] for r in similar.representatives(docs, together=together).collect()]
    assert sorted(ours) == plain_representatives(list(enumerate(texts)))


def test_nulls_repeats_and_clashing_names(clashing):
    more = clashing.withColumns({c: F.lit("clash") for c in ("bands", "members", "all", "found", "chunk")})
    out = similar.representatives(more)
    assert out.count() == 3 and out.columns == more.columns
    assert similar.representatives(more.limit(0)).count() == 0

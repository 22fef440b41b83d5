from fiscalgrove.llm import substrings


def test_small_blocks_give_the_same(spark, docs, monkeypatch):
    """Blocks of operator 6 have a size of their own, and any size gives the same result."""
    rows = docs.where("doc_id % 3 = 0 or doc_id >= 1000000")
    of = lambda: sorted(map(repr, substrings.deduplicated(rows).collect()))
    whole = of()
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 200_000)
    assert of() == whole and len(whole) > 100

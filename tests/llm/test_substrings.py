"""Digit passes of the substring operator against brute force, over several blocks."""

import random

import pytest

from fiscalgrove.llm import blocks, substrings


def _texts() -> list[tuple[int | None, str | None]]:
    """Edited copies, a passage that stands in half of the rows and is cut off at two places, runs, repeats, short and empty texts."""
    rng = random.Random(5)
    draw = lambda n, of="abcdefgh é": "".join(rng.choice(of) for _ in range(n))
    base, passage, out = draw(900), draw(260), []
    for i in range(120):
        text = list(base if i % 3 == 0 else draw(rng.choice([0, 50, 99, 100, 101, 700]), "ab"))
        for _ in range(rng.randrange(4) if text else 0):
            text[rng.randrange(len(text))] = rng.choice("xyz")
        if i % 2:
            at = rng.randrange(len(text) + 1)
            text[at:at] = passage[: rng.choice([120, 260])]
        whole = "".join(text) + ("".join(text[:300]) if i % 7 == 0 else "") + ("z" * 400 if i % 11 == 0 else "")
        out.append((i // 2 * 2 if i % 10 == 9 else i, whole))   # some ids twice
    return [*out, (None, base), (None, None), (500, "q" * 20_000)]


def _brute(docs, length):
    order = lambda d: (d is not None, d or 0)
    data, first = [(d, (t or "").encode()) for d, t in docs], {}
    for d, t in data:
        for q in range(len(t) - length + 1):
            first[t[q : q + length]] = min(first.get(t[q : q + length], order(d)), order(d))
    for d, t in data:
        seen, gone = set(), bytearray(len(t))
        for q in range(len(t) - length + 1):
            w = t[q : q + length]
            if w in seen or first[w] < order(d):
                gone[q : q + length] = b"\1" * length
            seen.add(w)
        yield (d, len(t), bytes(x for x, g in zip(t, gone) if not g), sum(gone))


@pytest.mark.parametrize("length", [100, 40])
def test_against_brute_force(spark, monkeypatch, length):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 5_000)
    monkeypatch.setattr(blocks, "PART_ENTRIES", 300)
    docs = _texts()
    out = substrings.deduplicated(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), length=length).collect()
    got = [(r["doc_id"], r["n_bytes"], bytes(r["kept"]), sum(e - s for s, e in zip(r["starts"], r["ends"]))) for r in out]
    assert sorted(got, key=repr) == sorted(_brute(docs, length), key=repr)


def test_a_pass_has_one_entry_per_block_and_core():
    """A passage in all rows, cut off and followed by other texts, adds no entries with the rows that have it."""
    rng = random.Random(1)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(400))
    counts = []
    for n in (50, 200):
        texts = [passage.encode()] * n
        row = {"block": 0, "ids": list(range(n)), "sizes": [400] * n, "text": substrings.zstandard.ZstdCompressor().compress(b"".join(texts)), "units": None, "late": None}
        counts.append(len(substrings.Block(row, 100, 0).entries()[1]))
    assert counts[0] == counts[1]

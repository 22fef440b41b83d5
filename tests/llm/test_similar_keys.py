"""The near-dedup stage retrieves by SimHash, and loses no link in classes of many chunks."""

import random

import numpy as np
import pytest

from fiscalgrove.llm import similar


def test_fingerprint_is_the_majority():
    found, words = similar.shingles("a b c d e f g h i j k l m n o p"), 3
    xors, times = similar._mixers(words)
    mixed = (found[:, None] ^ xors) * times
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(29)
    ours = similar.fingerprint(found, words)
    for w in range(words):
        for bit in range(64):
            ones = sum(int(x) >> bit & 1 for x in mixed[:, w])
            assert int(ours[w]) >> bit & 1 == (2 * ones > len(found))
    assert not similar.fingerprint(found[:0], words).any()


@pytest.mark.parametrize("bits", [8, 12])
def test_sets_just_alike_meet(bits):
    """Of pairs that are 0.8 alike nearly all share a block and are near; of unrelated ones, none is near."""
    rng = np.random.default_rng(5)
    words, hits, near, far = similar.words_for(bits), 0, 0, 128
    for _ in range(1000):
        n = 9 * int(rng.integers(3, 30))
        x = rng.integers(0, 1 << 63, n + n // 9, dtype=np.uint64)
        two = np.stack([similar.fingerprint(s, words) for s in (x[:n], x[n // 9 :], rng.integers(0, 1 << 63, n, dtype=np.uint64))])
        keys = similar.block_keys(two, bits)
        assert keys.shape == (3, similar.blocks_for(bits)) and len(np.unique(keys[0])) == keys.shape[1]
        hits += (keys[0] == keys[1]).any()
        distance = np.bitwise_count(two[:, None, : similar.CHECKED] ^ two[None, :, : similar.CHECKED]).sum(axis=2)
        near += distance[0, 1] <= similar.NEAR
        far = min(far, distance[0, 2])
    assert hits >= 993 and near >= 993 and far > similar.NEAR


def test_no_link_is_lost_between_chunks(spark):
    """Texts of one boilerplate, 0.77 alike and so not linked, but for planted pairs that are 0.82 alike."""
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(80):
        one = [f"own{i}x{j}" for j in range(30)]
        rows += [(2 * i, " ".join(base + one)), (2 * i + 1, " ".join(base + one[:8] + [f"other{i}x{j}" for j in range(22)]))]
    rnd.shuffle(rows)
    sets = {i: set(similar.shingles(t).tolist()) for i, t in rows}
    alike = lambda a, b: 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    expected = sorted(i for i in sets if not any(alike(i, j) for j in sets if j < i))
    assert expected == list(range(0, 160, 2))
    out = similar.representatives(spark.createDataFrame(rows, "doc_id long, text string"), together=8)
    assert sorted(r["doc_id"] for r in out.collect()) == expected

"""Periodic runs against a search over all periods."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from fiscalgrove.llm import periodic
from fiscalgrove.llm.queries import op12_periodic_runs, run_digests, with_repeats
from tests.llm.conftest import DDL, TESTDATA


def plain_runs(w):
    """All runs, from stretches of words that equal the word q further on; periods that a smaller one explains are left out."""
    n, found = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and j > i:
                part = w[i : j + q]
                if not any(all(part[x] == part[x + r] for x in range(len(part) - r)) for r in range(1, q)):
                    found.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_kept(w, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return [x for i, x in enumerate(w) if i not in gone]


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_runs_of_random_words(letters):
    rnd = random.Random(letters)
    for _ in range(800):
        w = [rnd.choice("abcde"[:letters]).encode() for _ in range(rnd.randrange(40))]
        if rnd.random() < 0.6:
            root, at = [rnd.choice("abcde"[:letters]).encode() for _ in range(rnd.randrange(1, 6))], rnd.randrange(len(w) + 1)
            w[at:at] = root * rnd.randrange(2, 7) + root[: rnd.randrange(len(root))]
        runs = periodic.document_runs(w, 6, 4)
        assert runs == plain_runs(w)
        assert periodic.without_repeats(w, runs) == b" ".join(plain_kept(w, runs))


def test_screen_and_whole_document_agree():
    """The screen leaves out no run: without it, trees over the whole document find the same."""
    rnd = random.Random(9)
    for _ in range(200):
        w = [rnd.randrange(1, 5) for _ in range(60)] + [1, 2] * rnd.randrange(6) + [rnd.randrange(1, 40) for _ in range(60)]
        whole = periodic.runs_of(periodic.np.array(w), 6, 4)
        assert periodic.document_runs([str(x).encode() for x in w], 6, 4) == [tuple(r) for r in whole.tolist()]


def test_extensions():
    rnd = random.Random(4)
    for _ in range(100):
        w = [rnd.randrange(1, 4) for _ in range(rnd.randrange(2, 30))]
        tree = periodic.Extensions(periodic.np.array(w))
        places = [(a, b) for a in range(len(w)) for b in range(len(w)) if a != b]
        same = lambda a, b: next((k for k in range(len(w)) if a + k >= len(w) or b + k >= len(w) or w[a + k] != w[b + k]), len(w))
        got = tree.common(*periodic.np.array(places).T)
        assert got.tolist() == [same(a, b) for a, b in places]
        assert tree.rank.argsort().tolist() == sorted(range(len(w)), key=lambda i: w[i:])
        assert tree.reversed_rank.argsort().tolist() == sorted(range(len(w)), key=lambda i: [-x for x in w[i:]])


def altered(doc_id, text):
    w = [x for x in (text or "").encode().split()]
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_query(spark, docs, texts):
    got = {r["doc_id"]: r for r in run_digests(periodic.find_runs(with_repeats(docs))).collect()}
    assert set(got) == set(texts)
    found = 0
    for doc_id, text in texts.items():
        w = altered(doc_id, text)
        if len(w) > 2500:
            continue
        runs, r = plain_runs(w), got[doc_id]
        found += len(runs)
        assert r["n_runs"] == len(runs)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{a},{n},{q}\n" for a, n, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(b" ".join(plain_kept(w, runs))).hexdigest()
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        assert (r["start"], r["length"], r["period"]) == best
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
    assert found > 20
    long = next(i for i, t in texts.items() if t == "the " * 30_000)
    assert (got[long]["n_runs"], got[long]["length"], got[long]["period"]) == (1, 30_000, 1)
    assert op12_periodic_runs(spark, TESTDATA).count() == 200


def test_nulls_repeats_and_clashing_names(spark, clashing):
    out = periodic.find_runs(clashing.withColumns({c: F.lit("clash") for c in ("runs", "n_words", "collapsed", "id")}))
    assert out.columns == ["doc_id", "n_words", "runs", "collapsed"]
    rows = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in out.collect()), key=repr)
    assert rows == sorted([(None, 0, [], ""), (1, 3, [], "a b c"), (1, 3, [], "a b c"), (None, 48, [(0, 48, 4)], "mail me at a@b.example"), (2, 0, [], "")], key=repr)
    assert [tuple(r) for r in run_digests(periodic.find_runs(with_repeats(spark.createDataFrame([(None, None, None, None, None)], DDL)))).select("doc_id", "n_runs", "start").collect()] == [(None, 0, None)]
    assert periodic.find_runs(clashing.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.find_runs(clashing, least_periods=2)

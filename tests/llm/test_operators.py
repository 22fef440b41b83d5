"""Each operator against a plain version of what it has to give."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from fiscalgrove.llm import blocks, chat, decontaminate, licenses, lm, mixing, pii, quality, simhash, substrings, tokencount
from tests.llm.conftest import DDL, TESTDATA

WORD = re.compile(r"[^\x20\x09-\x0D]+")
lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


@pytest.fixture()
def small_blocks(monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 100_000)
    monkeypatch.setattr(blocks, "PART_ENTRIES", 20_000)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_chat(spark):
    from tokenizers import Tokenizer

    rows = [(1, 1, "user", "</s>[INST] ok [/INST]"), (1, 2, "assistant", "</s>[INST] ok [/INST]"), (1, 0, None, None), (2, 0, "assistant", "\n\nx <|im_end|>\n<\\|im_start|> é"),
            (2, 0, "assistant", "\n\nx <|im_end|>\n<\\|im_start|> é"), (None, None, "a\\nb\n<s>", "日本語 \U0001f600"), (3, 0, "assistant", ""), (3, 1, "assistant", "[\\\\INST]")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    out = {r["conv_id"]: r for r in chat.format_chats(df, public_tokenizers.path("byte_bpe_50k.json")).collect()}
    got = {r["conv_id"]: r for r in chat.digests(chat.format_chats(df, public_tokenizers.path("byte_bpe_50k.json"))).collect()}
    encoder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder.encode_special_tokens = True
    for conv in (1, 2, None, 3):
        turns = sorted([(-1 if r[1] is None else r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv])
        assert chat.parsed(out[conv]["formatted"]) == [(r, t) for _, r, t in turns]
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert got[conv]["n_turns"] == len(turns) and got[conv]["loss_chars"] == len(loss)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        assert got[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert list(out[conv]["token_ids"]) == encoder.encode(out[conv]["formatted"], add_special_tokens=False).ids
        assert len(out[conv]["loss_mask"]) == len(out[conv]["token_ids"]) and any(out[conv]["loss_mask"]) == bool(loss)
    assert chat.format_chats(df.limit(0), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_escapes_are_reversible():
    rnd = random.Random(1)
    for _ in range(3000):
        t = "".join(rnd.choice(["<", "[", "\\", "|im_end|>", "INST]", "s>", "SYS>>", "n", "\n", "<|im_start|>"]) for _ in range(rnd.randrange(8)))
        assert chat.unescaped(chat.escaped(t)) == t and chat.unescaped_role(chat.escaped_role(t)) == t
        assert not any(c in chat.escaped(t) for c in chat.CONTROL if c != "<<SYS>>") and "\n" not in chat.escaped_role(t)


def test_licenses(docs, texts):
    words = lambda t: regex.findall(r"[\p{L}\p{N}]+", (t or "").lower())
    runs = lambda w: [" ".join(w[i : i + 5]) for i in range(len(w) - 4)]
    more = {2_000_000 + i: t for i, t in enumerate([licenses.NOTICES["gpl-grant"] + " x " + licenses.NOTICES["mit"], licenses.NOTICES["gpl-grant"].replace("redistribute", "share"), "released under THE mit license"])}
    df = docs.unionByName(docs.sparkSession.createDataFrame([(k, t, None, None, 0) for k, t in more.items()], DDL))
    want = {}
    for doc, text in {**texts, **more}.items():
        w = words(text)
        for name, notice in licenses.NOTICES.items():
            n, own = len(words(notice)), set(runs(words(notice)))
            best = 0.0
            for i, s in enumerate(runs(w)):
                for at in ((i - 1, i) if s in own else ()):
                    if at >= 0:
                        first = max(0, at - n)
                        best = max(best, len(own & set(runs(w[first : at + 6 + n]))) / len(own))
            if best >= 0.8:
                want[doc, name] = best
    got = {(r["doc_id"], r["license"]): r["containment"] for r in licenses.scan(df).collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want) and len(want) > 5


def plain_print(text):
    w = WORD.findall(lower(text))
    runs = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    counts = Counter(runs)
    ones = [0] * 64
    for s, n in counts.items():
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += n * (h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(runs))


def plain_components(prints):
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    a = np.array([prints[i] for i in ids], dtype=np.uint64)
    for i in range(len(ids)):
        for j in np.nonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= 4)[0]:
            x, y = top(ids[i]), top(ids[i + 1 + j])
            parent[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def test_simhash(docs, texts):
    got = by_id(simhash.near_duplicates(docs))
    prints = {d: plain_print(t) for d, t in texts.items()}
    assert {d: r["fingerprint"] for d, r in got.items()} == {d: f"{p:016x}" for d, p in prints.items()}
    groups = plain_components(prints)
    assert {d: r["component_id"] for d, r in got.items()} == groups
    assert sorted(r["doc_id"] for r in simhash.representatives(docs).collect()) == sorted(set(groups.values()))


@pytest.mark.parametrize("together", [4096, 8])
def test_simhash_dense_groups(spark, together):
    """Many near fingerprints under one key, compared in one task or over points halfway."""
    rnd = random.Random(5)
    prints = list({c ^ sum(1 << k for k in rnd.sample(range(64), rnd.randrange(7))) for c in (rnd.getrandbits(64) for _ in range(4)) for _ in range(40)})
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    root = {r["node"]: r["root"] for r in simhash.grouped(df, 4, together).collect()}
    ours: dict = {}
    for i, p in enumerate(prints):
        ours.setdefault(root.get(simhash._signed(p), simhash._signed(p)), set()).add(i)
    theirs: dict = {}
    for i, r in plain_components(dict(enumerate(prints))).items():
        theirs.setdefault(r, set()).add(i)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_mixing(docs, texts):
    _, totals = mixing.mix(docs)
    rows = totals.collect()
    again = sorted(tuple(r) for r in mixing.mix(docs)[1].select("id", "taken").collect())
    assert again == sorted((r["id"], r["taken"]) for r in rows) and len(rows) == len(texts)
    size = {d: len(WORD.findall(t or "")) for d, t in texts.items()}
    assert all(r["size"] == size[r["id"]] and 0 <= r["taken"] <= 3 * r["size"] for r in rows)
    of: dict = {}
    for r in rows:
        of.setdefault(r["source"], []).append(r)
    order = sorted(s for s in of if s is not None) + [None]
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    goal = {s: 0.0 for s in order}
    free, left = set(order), float(sum(size.values()))
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] > 3 * sum(r["size"] for r in of[s])}
        for s in full or free:
            goal[s] = 3 * sum(r["size"] for r in of[s]) if full else share[s]
        left -= sum(goal[s] for s in full)
        free -= full or free
    for s, members in of.items():
        assert all(abs(r["target"] - goal[s]) < 1e-6 * (1 + goal[s]) and r["source_size"] == sum(m["size"] for m in members) for r in members)
        assert abs(sum(r["taken"] for r in members) - goal[s]) <= 1


def test_mix_shards(docs):
    draws, _ = mixing.mix(docs, shards=5)
    per = draws.groupBy("source", "shard").agg(F.countDistinct("block", "round").alias("n")).collect()
    assert {r["shard"] for r in per} == set(range(5))
    quotas = np.array([7, 0, 13, 1])
    out = mixing.split_quotas(quotas, 5, 3)
    assert (out.sum(axis=0) == quotas).all() and np.ptp(out.sum(axis=1)) <= 1
    mixed = mixing.mixed_documents(docs)
    count = lambda t: len(WORD.findall(t or ""))
    assert sum(count(r["text"]) for r in mixed.select("text").collect()) == mixing.mix(docs)[0].agg(F.sum("words")).first()[0]


def test_quality(docs, texts):
    got = by_id(quality.assess(docs))
    for doc, text in texts.items():
        text = text or ""
        w, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
        at: dict = {}
        for i in range(len(w) - 7):
            at.setdefault(tuple(w[i : i + 8]), []).append(i)
        repeated = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(8)}
        r = got[doc]
        assert tuple(r)[1:6] == (len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))
        assert r["base_failed"] == (len(w) < 20 or 100 * len(repeated) > 30 * len(w)) and not (r["kept"] and r["base_failed"])
    assert sorted(r["doc_id"] for r in quality.kept_documents(docs).collect()) == sorted(d for d, r in got.items() if r["kept"])


def test_quality_thresholds_follow_the_group(spark):
    """What is usual in one source is rejected in another."""
    words, code = (" ".join(f"w{i}x{end}" for i in range(40)) for end in ("", "#$"))
    usual = [(i, f"{words} n{i}", "en", "plain", 0) for i in range(300)] + [(1000 + i, f"{code} n{i}", "en", "code", 0) for i in range(300)]
    rows = usual + [(5000, code, "en", "plain", 0), (5001, words, "en", "rare", 0)]
    got = by_id(quality.assess(spark.createDataFrame(rows, DDL)))
    assert got[1000]["kept"] and got[0]["kept"] and got[5001]["kept"] and not got[5000]["kept"] and not got[5000]["base_failed"]


@pytest.mark.usefixtures("small_blocks")
def test_substrings(docs, texts):
    got, seen = by_id(substrings.deduplicated(docs.unionByName(docs.sparkSession.createDataFrame([(-5, "z" * 30 + (texts[10**6 + 21] or ""), None, None, 0)], DDL)))), set()
    texts = {-5: "z" * 30 + (texts[10**6 + 21] or ""), **texts}
    for doc in sorted(texts):
        data = (texts[doc] or "").encode()
        gone = bytearray(len(data))
        for q in range(len(data) - 99):
            w = data[q : q + 100]
            if w in seen:
                gone[q : q + 100] = b"\1" * 100
            else:
                seen.add(w)
        assert bytes(got[doc]["kept"]) == bytes(x for x, g in zip(data, gone) if not g), doc
        assert list(zip(got[doc]["starts"], got[doc]["ends"])) == [m.span() for m in re.finditer(b"\1+", bytes(gone))]


@pytest.mark.parametrize("part_bytes", [1 << 20, 400])
def test_decontamination(spark, docs, texts, part_bytes):
    """In one part, and with the benchmark in several."""
    bench = spark.read.parquet(f"{TESTDATA}/benchmark.parquet").select("item_id", "text").limit(15).unionByName(spark.createDataFrame(
        [(-1, None), (-2, " ,. "), (-3, "one"), (-4, "THE the"), (-4, "one two three"), (None, "x\ny x")], "item_id long, text string"))
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    patterns: dict = {}
    for item, text in bench.collect():
        w = split(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            patterns.setdefault(tuple(w[i : i + n]), set()).add("null" if item is None else str(item))
    got = by_id(decontaminate.contamination(docs, bench, part_bytes=part_bytes))
    lengths = sorted({len(p) for p in patterns})
    for doc, text in texts.items():
        w, hit, items = split(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                found = patterns.get(tuple(w[i : i + n]))
                if found:
                    hit.update(range(i, i + n))
                    items |= found
        assert tuple(got[doc]) == (doc, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit))
    clean = decontaminate.uncontaminated(docs, bench, part_bytes=part_bytes)
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(d for d, r in got.items() if not r["contaminated"]) and clean.columns == docs.columns


@pytest.mark.usefixtures("small_blocks")
def test_lm_scores(docs, texts):
    tokens = {d: [*WORD.findall(lower(t)), None] for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    count = Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    n, v = sum(count.values()), len(count)
    got = by_id(lm.score(docs))
    for d, ws in tokens.items():
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws)
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[d], len(ws), sum(count[w] > 0 for w in ws), n)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and -math.inf < r["score"] < 0
    real = [r for r in got.values() if r["held_out"] and r["doc_id"] < 10**6]
    assert sum(r["score"] for r in real) > 0.9 * sum(r["base_score"] for r in real)   # better than single words on texts not learnt from


def test_lm_interpolation_is_a_distribution():
    lam = lm.learn(np.array([1 << 20, (1 << 20) + 5]), np.array([30, 10]), np.array([15.0, 0.0]), np.array([3.0, 1.0]), 0.001)
    assert all(abs(sum(w) - 1) < 1e-9 and min(w) > 0 for w in lam.values()) and lam[1][0] > 0.5


def test_token_counts(docs, texts):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = Tokenizer.from_file(path)
    more = {3_000_000 + i: t for i, t in enumerate(["<|endoftext|>a<|startoftext|>", "I'LL don't 12345 ½ x²", "a\x1cb\x1fc\x85d", "x" * 70_000 + " y" * 70_000, ("a" * 65_530 + " ") * 3, "<|endoftext|>" * 9_000])}
    got = by_id(tokencount.count_tokens(docs.unionByName(docs.sparkSession.createDataFrame([(k, t, None, None, 0) for k, t in more.items()], DDL)), path))
    for doc, text in {**texts, **more}.items():
        n = len(encoder.encode(text or "", add_special_tokens=False).ids)
        assert tuple(got[doc]) == (doc, len((text or "").encode()), n, n > 2048), doc


PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(c) if not i % 2 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
            if (True, kind == 1 and all(int(x) <= 255 for x in m[0].split(".")), 12 <= len(d) <= 19 and luhn, 9 <= len(d) <= 15)[kind]:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_personal_data(docs, texts):
    found = {r["doc_id"]: r for r in pii.find(docs).collect()}
    for doc, text in texts.items():
        base, spans = [tuple(s) for s in found[doc]["base"]], [tuple(s) for s in found[doc]["spans"]]
        assert base == plain_spans(text), doc
        assert set(base) <= set(spans) and spans == sorted(spans) and all(0 <= a < b <= len(text or "") for a, _, b in spans)
    assert any(s["kind"] == len(pii.BASE) + 1 for r in found.values() for s in r["spans"])   # the planted token
    masked = by_id(pii.masked(docs))
    for doc, text in texts.items():
        out, at = "", 0
        for a, kind, b in sorted(tuple(s) for s in found[doc]["spans"]):
            if a >= at:
                out += (text or "")[at:a] + f"[{(pii.BASE + pii.ADDED)[kind].upper()}]"
            at = max(at, b)
        assert masked[doc]["text"] == (None if text is None else out + text[at:]), doc


def test_reliabilities_are_found():
    """Two good labelers and one that guesses: expectation-maximisation tells them apart."""
    rnd, patterns = random.Random(2), Counter()
    for _ in range(4000):
        y = rnd.random() < 0.4
        vote = lambda p: "1" if (rnd.random() < p) == y else "-1"
        patterns["number", (vote(0.9), vote(0.9), vote(0.5), "0")] += 1
    post = pii.estimate(dict(patterns))
    assert min(p for (_, v), p in post.items() if v[:2] == ("1", "1")) > 0.9 > 0.1 > max(p for (_, v), p in post.items() if v[:2] == ("-1", "-1"))


OPERATORS = {
    "licenses": lambda d: licenses.scan(d), "simhash": simhash.near_duplicates, "representatives": simhash.representatives, "mix": lambda d: mixing.mix(d)[1],
    "quality": quality.assess, "kept": quality.kept_documents, "substrings": substrings.deduplicated, "lm": lm.score, "pii": pii.find, "masked": pii.masked,
    "tokens": lambda d: tokencount.count_tokens(d, public_tokenizers.path("word_bpe_49k.json")),
    "contamination": lambda d: decontaminate.contamination(d, d.sparkSession.createDataFrame([(1, "a b c")], "item_id long, text string")),
    "uncontaminated": lambda d: decontaminate.uncontaminated(d, d.sparkSession.createDataFrame([(1, "a b c")], "item_id long, text string")),
}
FEWER = {"licenses": 0, "representatives": 3, "kept": 0, "uncontaminated": 3}


@pytest.mark.parametrize("name", OPERATORS)
def test_nulls_repeats_and_clashing_names(clashing, name):
    assert OPERATORS[name](clashing).count() == FEWER.get(name, 5)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(clashing, name):
    assert OPERATORS[name](clashing.limit(0)).count() == 0

"""Sharding along the curve against plain sorting."""

import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from fiscalgrove.llm import hilbert


@pytest.mark.parametrize(("dims", "bits"), [(1, 3), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_curve(spark, dims, bits):
    """All cells, each once, and neighbours on the curve are neighbours in the cube."""
    cells = list(product(range(1 << bits), repeat=dims))
    df = spark.createDataFrame(cells, ", ".join(f"c{i} int" for i in range(dims)))
    at = {r["h"]: tuple(r)[:dims] for r in df.withColumn("h", hilbert.curve_index([F.col(f"c{i}") for i in range(dims)], bits)).collect()}
    assert sorted(at) == list(range(len(cells)))
    assert all(sum(abs(x - y) for x, y in zip(at[i], at[i + 1])) == 1 for i in range(len(at) - 1))


def plain_assign(rows, shards, bits=8):
    """rows: (id, text, values). id, size, checksum, place, shard, slot."""
    states, steps = hilbert.curve_steps(len(rows[0][2]))
    dims = len(rows[0][2])
    low = lambda v: (v is not None, v if v is not None else 0)
    cells = []
    for i in range(dims):
        values = sorted(low(r[2][i]) for r in rows)
        cells.append([values.index(low(r[2][i])) * 2**bits // len(rows) for r in rows])
    found = []
    for k, (id_, text, _) in enumerate(rows):
        state = at = 0
        for b in range(bits - 1, -1, -1):
            step = steps[(state << dims) + sum((cells[i][k] >> b & 1) << i for i in range(dims))]
            at, state = at << dims | step % (1 << dims), step >> dims
        data = (text or "").encode()
        found.append((at, zlib.crc32(data), low(id_), id_, len(data) + 1))
    found.sort(key=lambda x: x[:3])
    total, before, out, slots = sum(f[4] for f in found), 0, [], {}
    for at, crc, _, id_, size in found:
        shard = min(shards - 1, (2 * before + size) * shards // (2 * total))
        before += size
        out.append((id_, size, crc, at, shard, slots.setdefault(shard, 0)))
        slots[shard] += 1
    return out


def test_assign(docs):
    rows = [(r["doc_id"], r["text"], (r["lang"], r["source"], len((r["text"] or "").encode()) + 1)) for r in docs.collect()]
    got = sorted(tuple(r) for r in hilbert.assign(docs, shards=7).collect())
    assert got == sorted(plain_assign(rows, 7))
    sizes, share = {}, sum(g[1] for g in got) / 7
    for g in got:
        sizes[g[4]] = sizes.get(g[4], 0) + g[1]
    assert all(abs(s - share) <= max(g[1] for g in got) for s in sizes.values())
    assert sorted(tuple(r) for r in hilbert.assign(docs.repartition(5), shards=7).collect()) == got


def test_hot_values(spark):
    """A third of the rows is one text of one source, most languages are null."""
    df = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").otherwise(F.concat(F.lit("t"), "id")).alias("text"),
                                 F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 40)).alias("source"), F.when(F.col("id") % 50 == 0, "en").alias("lang"))
    rows = [(r["doc_id"], r["text"], (r["lang"], r["source"], len(r["text"]) + 1)) for r in df.collect()]
    assert sorted(tuple(r) for r in hilbert.assign(df, shards=16).collect()) == sorted(plain_assign(rows, 16))


def test_written_shards_and_manifest(spark, docs, tmp_path):
    path = str(tmp_path / "shards")
    manifest = hilbert.write_shards(docs, path, ("lang", "source", "n_chars"), shards=12, slots=20)
    back = spark.read.parquet(path)
    assert sorted(map(repr, back.select(*docs.columns).collect())) == sorted(map(repr, docs.collect()))
    shards = {r["doc_id"]: r["shard"] for r in hilbert.assign(docs, ("lang", "source", "n_chars"), shards=12).collect()}
    assert {r["doc_id"]: int(r["shard"]) for r in back.collect()} == shards
    rows = {r["shard"]: r for r in manifest.collect()}
    assert sum(r["rows"] for r in rows.values()) == docs.count()
    sources = sorted(r["source"] for r in docs.where("source is not null").collect())
    low, high = sources[len(sources) // 2], sources[len(sources) // 2 + 20]
    part = hilbert.read_shards(spark, path, manifest, source=(low, high), n_chars=(100, 900))
    wanted = "source between '{}' and '{}' and n_chars between 100 and 900".format(low.replace("'", "\\'"), high.replace("'", "\\'"))
    assert part.where(wanted).count() == docs.where(wanted).count() > 0
    assert part.select("shard").distinct().count() < len(rows)


def test_nulls_repeats_and_clashing_names(spark, clashing):
    more = clashing.withColumns({c: F.lit("clash") for c in ("range_", "d0", "c0", "curve", "crc", "shard", "slot", "one", "number", "before")}).drop("size")
    rows = [(r["doc_id"], r["text"], (r["lang"], r["n_chars"], len((r["text"] or "").encode()) + 1)) for r in more.collect()]
    got = [tuple(r) for r in hilbert.assign(more, ("lang", "n_chars", "size"), shards=3).collect()]
    assert sorted(got, key=repr) == sorted(plain_assign(rows, 3), key=repr)
    assert hilbert.assign(more.limit(0), ("lang", "n_chars", "size")).count() == 0
    none = spark.createDataFrame([(i, None, None, None, None) for i in range(4)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(tuple(r) for r in hilbert.assign(none, shards=2).select("doc_id", "size", "text_crc32", "shard", "slot").collect()) == [(0, 1, 0, 0, 0), (1, 1, 0, 0, 1), (2, 1, 0, 1, 0), (3, 1, 0, 1, 1)]

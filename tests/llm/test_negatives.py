"""Hard negatives against all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fiscalgrove.llm import negatives

DDL = "vec_id long, embedding array<float>, label int"


def plain_mine(rows, is_anchor, k=5):
    """rows: (id, vector, label)."""
    good = [(i, r[0], [math.floor(256 * x) for x in r[1]], r[2]) for i, r in enumerate(rows)
            if r[2] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    out = []
    for n, a, v, label in good:
        if a is None or not is_anchor(a):
            continue
        scored = sorted(((-sum(x * y for x, y in zip(v, w)), b is None, b or 0, m, l) for m, b, w, l in good if m != n))
        for minus, late, b, _, _ in [s for s in scored if s[4] == label][:5]:
            taken = [s for s in scored if s[4] != label and 80 * -minus <= 100 * -s[0] <= 100 * -minus][:k]
            out += [(a, None if late else b, rank, None if s[1] else s[2], -minus, -s[0]) for rank, s in enumerate(taken, 1)]
    return sorted(out, key=repr)


def run(df, **more):
    return sorted((tuple(r) for r in negatives.mine(df, F.col("vec_id") % 10 == 0, **more).collect()), key=repr)


def vectors(n, seed, width=6, scale=0.2):
    rnd = random.Random(seed)
    return [(i, [round(rnd.gauss(0.1, scale), 3) for _ in range(width)], rnd.randrange(3)) for i in range(n)]


@pytest.mark.parametrize("setting", ["one tile", "many tiles"])
def test_all_pairs(spark, monkeypatch, setting):
    if setting == "many tiles":
        monkeypatch.setattr(negatives, "ANCHORS", 7)
        monkeypatch.setattr(negatives, "SLICE_ROWS", 40)
        monkeypatch.setattr(negatives, "SCORES", 500)
    rows = vectors(400, 1)
    rows += [(400 + i, rows[3][1], rows[3][2] if i % 2 else 9) for i in range(60)]  # many copies: ties
    got = run(spark.createDataFrame(rows, DDL).repartition(3))
    assert got == plain_mine([(i, [float(np.float32(x)) for x in v], l) for i, v, l in rows], lambda a: a % 10 == 0)
    assert len(got) > 500


def test_odd_rows(spark):
    """Nulls everywhere, components that are no numbers, lengths that differ, empty vectors, repeated and null ids, scores below zero."""
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (10, [1.0], 1), (20, [], 1), (None, [1.0, 0.5], 1), (None, [0.9, 0.5], 2), (None, [0.9, 0.5], 2), (1, [0.95, 0.5], 2), (1, [0.95, 0.5], 2),
            (2, None, 1), (3, [None, 1.0], 1), (4, [nan, 1.0], 2), (5, [inf], 2), (6, [1.0, 0.5], None), (30, [-1.0, 0.2], 3), (31, [1.0, 0.1], 3), (7, [0.9, 0.4, 3.0], 2), (40, [0.0, 0.0], 4), (41, [5.0, 0.0], 4)]
    got = run(spark.createDataFrame(rows, DDL).withColumns({c: F.lit("clash") for c in ("n", "id", "a", "vector", "block", "slice", "part", "windows", "kind", "score")}))
    assert got == plain_mine([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], l) for i, v, l in rows], lambda a: a % 10 == 0)
    assert got and run(spark.createDataFrame([], DDL)) == [] and run(spark.createDataFrame([(0, [1.0], None)], DDL)) == []
    assert run(spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 2)], DDL)) == []


def test_great_components(spark):
    rows = [(i, [x * 10.0**6 for x in v], l) for i, v, l in vectors(120, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert run(df) == plain_mine(rows, lambda a: a % 10 == 0)
    beyond = spark.createDataFrame([(0, [1e300], 1), (1, [1.0], 1), (2, [1.0], 2)], "vec_id long, embedding array<double>, label int")
    assert run(beyond) == []


def test_other_limits(spark):
    rows = vectors(200, 5)
    want = plain_mine([(i, [float(np.float32(x)) for x in v], l) for i, v, l in rows], lambda a: a % 10 == 0, k=2)
    assert run(spark.createDataFrame(rows, DDL), negatives=2) == want
    with pytest.raises(ValueError):
        negatives.mine(spark.createDataFrame(rows, DDL), F.col("vec_id") == 0, high=120)


def test_secondary_sort_shuffle(spark):
    """One shuffle by anchor, and the sort inside partitions on top of it; nothing is collected per anchor."""
    plan = negatives.mine(spark.createDataFrame(vectors(50, 3), DDL), F.col("vec_id") % 10 == 0)._jdf.queryExecution().executedPlan().toString()
    assert "Sort [a" in plan and "collect_list" not in plan and "CartesianProduct" not in plan

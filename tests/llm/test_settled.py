"""What a step stores on its way is deleted once its result is stored, and not before."""

import os
from urllib.parse import urlparse

import pytest

from fiscalgrove.llm.shared import settled, stored


def folder(df):
    return os.path.dirname(urlparse(df.inputFiles()[0]).path)


def test_only_the_result_stays(spark):
    seen = []

    def inner():
        seen.append(folder(a := stored(spark.range(5), "a")))
        return a

    def outer():
        b = settled(spark, inner, "b")
        seen.append(folder(b))
        assert not os.path.exists(seen[0]) and os.path.exists(seen[1])
        return b.selectExpr("id + 1 AS id")

    out = settled(spark, outer, "c")
    assert sorted(r[0] for r in out.collect()) == [1, 2, 3, 4, 5]
    assert not any(map(os.path.exists, seen)) and os.path.exists(folder(out))
    after = stored(spark.range(1), "d")
    settled(spark, lambda: out, "e")
    assert os.path.exists(folder(after)) and os.path.exists(folder(out))


def test_a_failed_step_ends_its_scope(spark):
    def fails():
        raise ValueError("no")

    with pytest.raises(ValueError):
        settled(spark, fails, "f")
    kept = stored(spark.range(1), "g")
    assert kept.count() == 1

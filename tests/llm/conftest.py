import random

import pytest
from pyspark.sql import functions as F

TESTDATA = "/root/testdata/sf0.001"
DDL = "doc_id long, text string, lang string, source string, n_chars long"


def odd_texts():
    """Null, empty, without words, very long, one word over and over, ties, control characters, accents, digits in all shapes."""
    rnd = random.Random(7)
    passage = "".join(rnd.choice("abcdef ") for _ in range(150))
    texts = [None, "", " \t\n\x0b", "one", "One  two\r\nthree", "the " * 30_000, "x" * 120_000, "a@b.c_d@e.f x@y", "1.2.3.4.5.6.7.8 999.1.1.1 0255.1.1.1",
             "4111 1111-1111 1111 5 6 7", "é+49 (0)30 123456789 +1", "1 " * 20_000, "a@b" + ".c" * 5_000, "1.2." * 3_000, "+1" + "(2) " * 2_000, "9" * 5_000,
             "a b c d e f g h a b c d e f g h " * 3, "x\ny\nx\n \n \nx", "ab" * 400, 'token = "1eb9c654e721b4f812088970e66a6345cee33dd6"', "İ ΣΑΣ É é # $ % | < >\x00"]
    texts += [rnd.choice("xyz") * k + passage + rnd.choice("uvw") * k for k in range(0, 40, 9)]
    texts += ["".join(rnd.choice("01259.@ab-+ ()_%é|\n") for _ in range(rnd.randrange(80))) for _ in range(150)]
    return texts


@pytest.fixture(scope="session")
def docs(spark):
    given = spark.read.parquet(f"{TESTDATA}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    extra = [(10**6 + i, t, None if i % 2 else "en", None if i % 3 else "s'1", 0) for i, t in enumerate(odd_texts())]
    return given.unionByName(spark.createDataFrame(extra, DDL)).coalesce(3)


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def clashing(spark):
    """Null and repeated ids, repeated rows, nulls in every column, and extra columns with names that operators use inside."""
    rows = [(None, None, None, None, None), (1, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5), (None, "mail me at a@b.example " * 12, "en", None, 3), (2, "", None, "s", 0)]
    names = ("id", "row", "fp", "n", "key", "block", "stats", "base", "candidates", "size", "words", "spans", "node", "root", "u", "v", "s", "placed", "w", "h", "most")
    return spark.createDataFrame(rows, DDL).withColumns({c: F.lit("clash") for c in names})

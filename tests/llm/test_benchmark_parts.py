"""Operator 7 gives one row per row, whatever the size of the benchmark."""

from fiscalgrove.llm import decontaminate


def test_null_and_repeated_ids_in_several_parts(spark):
    texts = ["one two three", "nothing here", "x y z", None, "four five and one two three", "nothing"]
    docs = spark.createDataFrame(list(zip([None, None, 1, 1, 2, 1], texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two three"), (2, "four five"), (3, "x y"), (4, "y z")], "item_id long, text string")
    one, several = (sorted(map(tuple, decontaminate.contamination(docs, bench, part_bytes=b).collect()), key=repr) for b in (1 << 20, 4))
    assert one == several and len(several) == len(texts)

import os

import psutil
import public_tokenizers
import pytest

from fiscalgrove.llm import chat


def threads():
    """The most threads of a Python worker of this session."""
    return max(p.num_threads() for p in psutil.Process().children(recursive=True) if "pyspark.daemon" in p.cmdline())


@pytest.mark.skipif((os.cpu_count() or 1) < 4, reason="with few cores a pool of threads cannot be told from none")
def test_a_task_encodes_on_its_own_thread(spark):
    """Encoding in batches started a thread for each of the machine's cores in each worker; their heaps stayed and took an executor beyond its memory."""

    def nothing(batches):
        import numpy  # noqa: F401
        import tokenizers  # noqa: F401

        yield from batches

    rows = spark.range(400).selectExpr("id % 100 as conv_id", "id as turn", "if(id % 200 < 100, 'user', 'assistant') as role", "repeat('some words ', 20) as text")
    assert rows.mapInArrow(nothing, rows.schema).count() == 400
    before = threads()
    out = chat.format_chats(rows, public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert len(out) == 100 and all(len(r["token_ids"]) == len(r["loss_mask"]) > 0 for r in out)
    assert threads() <= before + 1

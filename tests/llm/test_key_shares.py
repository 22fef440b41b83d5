import random

import zstandard

from fiscalgrove.llm import substrings
from fiscalgrove.llm.blocks import runs_by_part


def test_keys_of_the_first_pass_spread_over_all_parts():
    """Anchors are least hashes; taken as they are, the first of 49 parts got 59 % of the keys of all blocks, in one task."""
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("abcdefgh ") for _ in range(50_000)).encode() for _ in range(4)]
    text = zstandard.ZstdCompressor().compress(b"".join(texts))
    block = {"block": 0, "ids": [1, 2, 3, 4], "sizes": [len(t) for t in texts], "text": text, "units": None, "late": None}
    _, keys, _ = substrings.Block(block, substrings.LENGTH, 0).entries()
    shares = [(b - a) / len(keys) for _, a, b in runs_by_part(keys, 49)]
    assert len(keys) > 4_000 and len(shares) == 49 and max(shares) < 2 / 49

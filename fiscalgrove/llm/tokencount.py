"""Token counts by a compiled finite-state transducer.

The merge rules of a BPE vocabulary with word ends are compiled, on demand, to a deterministic
transducer over byte symbols. Its state after a word's prefix holds, for every suffix of the
prefix that can still grow into a token, the token before that suffix and the number of tokens
so far, relative to now. A transition is annotated with the change in the number of tokens. That the
last token alone decides follows from a property of BPE: a sequence of tokens is an encoding
exactly if each neighbouring pair is one.

A long text is cut into chunks. White space brings the transducer to its start state, so the
state map of a chunk is: what stands before its first white space (which the state coming in
decides), the number of tokens in between, and what is left after its last white space. Such maps
compose associatively; a balanced scan composes the chunks of a text.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 16
#: transitions and words kept per Python worker; beyond it the caches start anew (results stay the same)
CACHE = 1 << 20

SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 bytes stand
    for themselves, the others for the characters from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Transducer:
    """Counts the tokens of words; states and transitions are compiled when first needed."""

    def __init__(self, merges: list[tuple[str, str]], vocabulary: list[str], end: str) -> None:
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.parts = {a + b: (a, b) for a, b in merges}
        self.end = end
        self.tokens = {self.symbols(t): t for t in vocabulary}
        self.prefixes = {s[:i] for s in self.tokens for i in range(1, len(s))}
        self.bytes = byte_symbols()
        self.spines: dict[tuple[str, int], list[tuple[str, float]]] = {}
        self.forget()

    def forget(self) -> None:
        start = (((), "", 0),)
        self.states, self.ids, self.arcs, self.pairs = [start], {start: 0}, [{}], {}

    def symbols(self, token: str) -> tuple[str, ...]:
        stem = token[: -len(self.end)] if token.endswith(self.end) and token != self.end else None
        return tuple(token) if stem is None else (*stem[:-1], stem[-1] + self.end)

    def spine(self, token: str, side: int) -> list[tuple[str, float]]:
        """The nodes along the left (0) or right (1) edge of a token's merge tree, each with the rank of
        the merge that used it up."""
        if (token, side) not in self.spines:
            nodes, used = [(token, float("inf"))], self.parts.get(token)
            while used:
                nodes.append((used[side], self.rank[used]))
                used = self.parts.get(used[side])
            self.spines[token, side] = nodes
        return self.spines[token, side]

    def fits(self, before: str, token: str) -> bool:
        """Do both tokens stay as they are side by side: does no merge across their border come before
        the merges that use up its two sides? Of equal ranks the leftmost goes first."""
        fit = self.pairs.get((before, token))
        if fit is None:
            rank, right = self.rank.get, self.spine(token, 0)
            fit = True
            for a, used_a in self.spine(before, 1):
                for b, used_b in right:
                    r = rank((a, b))
                    if r is not None and r < used_a and r <= used_b:
                        fit = False
            self.pairs[before, token] = fit
        return fit

    def last(self, grown: list[tuple]) -> tuple[str, int]:
        """The last token of the encoding, and the change in the number of tokens."""
        for suffix, before, n in grown:
            token = self.tokens.get(suffix)
            if token and (not before or self.fits(before, token)):
                return token, n + 1
        raise ValueError(f"no token ends in {grown}")

    def compiled(self, state: int, symbol: str) -> tuple[int, int]:
        """A new transition: the next state and the change in the number of tokens. A state stands for a
        tuple of (open suffix, token before it, tokens up to there less tokens up to now)."""
        grown = [((*suffix, symbol), before, n) for suffix, before, n in self.states[state]]
        last, change = self.last(grown)
        key = (*[(s, before, n - change) for s, before, n in grown if s in self.prefixes], ((), last, 0))
        new = self.ids.setdefault(key, len(self.states))
        if new == len(self.states):
            self.states.append(key)
            self.arcs.append({})
        self.arcs[state][symbol] = arc = (new, change)
        return arc

    def count(self, word: str) -> int:
        """Runs over the word; its last byte, with the mark of a word's end, only adds to the count."""
        if len(self.states) >= CACHE or len(self.pairs) >= CACHE:
            self.forget()
        state, n, arcs, symbols = 0, 0, self.arcs, self.bytes
        data = word.encode("utf-8", "surrogatepass")
        for b in data[:-1]:
            symbol = symbols[b]
            state, change = arcs[state].get(symbol) or self.compiled(state, symbol)
            n += change
        end = symbols[data[-1]] + self.end
        return n + self.last([((*suffix, end), before, m) for suffix, before, m in self.states[state]])[1]


class Counter(dict):
    """Pieces between white space -> tokens, filled by the transducer, and the scan over chunks."""

    def __init__(self, spec: dict) -> None:
        super().__init__()
        self.transducer = Transducer([tuple(m) for m in spec["merges"]], spec["vocabulary"], spec["end"])
        self.words = regex.compile(spec["pattern"]).findall
        self.special = spec["special"]
        self.cut = regex.compile("|".join(map(regex.escape, sorted(spec["special"], key=len, reverse=True))) or r"(?!)").split

    def __missing__(self, piece: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        n = self[piece] = sum(map(self.transducer.count, self.words(piece)))
        return n

    def plain(self, text: str) -> int:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # each character is lowered on its own
        text = text.lower()
        pieces = _SPACES.split(text) if _SEPARATORS.search(text) else text.split()
        return sum(map(self.__getitem__, pieces))

    def piece(self, text: str) -> int:
        """Tokens of a text at whose ends the transducer is in its start state."""
        if not any(s in text for s in self.special):
            return self.plain(text)
        parts = self.cut(text)
        return sum(map(self.plain, parts)) + len(parts) - 1

    def state_map(self, chunk: str) -> tuple[str, int | None, str]:
        """(head, tokens between, tail); without white space: (chunk, None, '')."""
        first = _SPACES.search(chunk)
        if not first:
            return chunk, None, ""
        last = chunk.rstrip(_ALL_SPACES)
        tail = chunk[max((last.rfind(c) for c in _ALL_SPACES), default=-1) + 1 :] if last == chunk else ""
        return chunk[: first.start()], self.piece(chunk[first.start() : len(chunk) - len(tail)]), tail

    def compose(self, a: tuple, b: tuple) -> tuple:
        if a[1] is None and b[1] is None:
            return a[0] + b[0], None, ""
        if a[1] is None:
            return a[0] + b[0], b[1], b[2]
        if b[1] is None:
            return a[0], a[1], a[2] + b[0]
        return a[0], a[1] + self.piece(a[2] + b[0]) + b[1], b[2]

    def tokens(self, text: str) -> int:
        if len(text) <= CHUNK:
            return self.piece(text)
        maps = [self.state_map(text[i : i + CHUNK]) for i in range(0, len(text), CHUNK)]
        while len(maps) > 1:  # a balanced scan: neighbours compose, level by level
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        head, between, tail = maps[0]
        return self.piece(head) + (0 if between is None else between + self.piece(tail))


_SPACES = regex.compile(f"[{SPACE}]")
#: str.split() takes these for white space, the vocabulary's pattern does not
_SEPARATORS = regex.compile(r"[\x1c-\x1f]")
_ALL_SPACES = "".join(c for c in map(chr, range(0x3001)) if _SPACES.match(c))


def read_spec(path: str) -> dict:
    """The parts of a tokenizer file that the transducer needs. Refuses files of another make, whose
    counts it would get wrong."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, steps = spec["model"], [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    split = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
    if model["type"] != "BPE" or not model["end_of_word_suffix"] or steps != ["NFC", "Replace", "Lowercase"] or split.get("behavior") != "Removed":
        raise ValueError(f"{path}: a lower-casing BPE vocabulary with word ends is expected")
    pattern = split["pattern"]["Regex"].replace(r"\s", SPACE)
    return {"merges": model["merges"], "vocabulary": list(model["vocab"]), "end": model["end_of_word_suffix"],
            "pattern": pattern, "special": [t["content"] for t in spec["added_tokens"]]}


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_bytes``, ``n_tokens``, ``over_limit``.

    A null text counts as empty: 0 bytes, 0 tokens. Ids may be null or repeated; every row is
    counted on its own. Other columns are not looked at. ``tokenizer`` is a file on the driver; its
    content (of fixed size) is sent to the tasks. Texts go through whole, in Arrow batches; no shuffle.
    """
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer))
    out = pa.schema([("id", pa.string()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(spec.value)
        for batch in batches:
            texts = (x.as_py() or "" for x in batch.column(1))
            rows = [(len(t.encode("utf-8", "surrogatepass")), counter.tokens(t)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.string()), *(pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1))], schema=out)

    id_type = docs.schema[id_col].dataType
    counted = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        count, "id string, n_bytes long, n_tokens long")
    return counted.select(F.col("id").cast(id_type).alias(id_col), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"))

"""Chat formatting with masks that are aligned by offsets.

A conversation is rendered whole, encoded once with offsets, and the sorted spans of the turns
that are learnt from are intersected with the sorted token spans by binary search. Control strings
inside texts and roles are escaped with one more backslash behind their first character, which
reading back takes away again, so no text can open or close a turn.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: strings that a text must not hold as they are: the template's own marks, and those of other common templates
CONTROL = (OPEN, CLOSE, "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "<unk>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

# each starts with < or [; "<<SYS>>" is guarded by its inner part
_INNER = sorted({c[1:].lstrip("<") for c in CONTROL}, key=len, reverse=True)
_GUARD = re.compile(r"([<\[])(\\*)(?=" + "|".join(map(re.escape, _INNER)) + ")")
_GUARDED = re.compile(r"([<\[])\\(\\*)(?=" + "|".join(map(re.escape, _INNER)) + ")")
_TURN = re.compile(re.escape(OPEN) + r"(.*?)\n(.*?)" + re.escape(CLOSE) + r"\n", re.S)


def escaped(text: str) -> str:
    return _GUARD.sub(r"\1\\\2", text)


def unescaped(text: str) -> str:
    return _GUARDED.sub(r"\1\2", text)


def escaped_role(role: str) -> str:
    """A role stands on a line of its own, so its line feeds are written as backslash and n."""
    return escaped(role).replace("\\", "\\\\").replace("\n", "\\n")


def unescaped_role(role: str) -> str:
    return unescaped(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role))


def render(turns: list[tuple[str, str]], learn: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The conversation's text and the spans of the texts that are learnt from, in order."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escaped_role(role)}\n", escaped(text)
        if role == learn:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, f"{CLOSE}\n"]
        at += len(head) + len(body) + len(CLOSE) + 1
    return "".join(parts), spans


def parsed(formatted: str) -> list[tuple[str, str]]:
    """Reads the turns back."""
    return [(unescaped_role(role), unescaped(text)) for role, text in _TURN.findall(formatted)]


def masked_spans(tokens: np.ndarray, turns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """tokens, turns: sorted spans (n x 2). Returns the mask of the tokens that reach into a turn, and the parts
    of the turns under the mask as starts and ends: token spans clipped to turns, each character once."""
    mask = np.zeros(len(tokens), dtype=bool)
    if not len(tokens) or not len(turns):
        return mask, np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.searchsorted(tokens[:, 1], turns[:, 0], side="right")  # the first token that ends behind the turn's start
    last = np.searchsorted(tokens[:, 0], turns[:, 1], side="left")    # behind the last that starts before the turn's end
    counts = np.maximum(last - first, 0)
    turn = np.repeat(np.arange(len(turns)), counts)
    index = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first, counts)
    mask[index] = True
    starts, ends = np.maximum(tokens[index, 0], turns[turn, 0]), np.minimum(tokens[index, 1], turns[turn, 1])
    # tokens that share a character have the same span: what an earlier one has covered does not count again
    reach = np.maximum.accumulate(np.concatenate([[0], ends]))[:-1]
    starts = np.maximum(starts, reach)
    keep = starts < ends
    return mask, starts[keep], ends[keep]


def slices(batch: pa.RecordBatch, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` characters each: what comes of a part is sent on before the next one."""
    sizes = np.array([sum(len(t.as_py()) for t in texts) for texts in batch.column("text")], dtype=np.int64)
    group = np.cumsum(sizes) // most
    at = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(at, at[1:]):
        if b > a:
            yield batch.slice(a, b - a)


_DDL = "conv_id string, n_turns long, formatted string, token_ids array<int>, loss_mask array<boolean>, loss_starts array<long>, loss_ends array<long>"


def format_chats(conversations: DataFrame, tokenizer: str, learn: str = "assistant", id_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: id, ``n_turns``, ``formatted``, ``token_ids``, ``loss_mask`` (one flag per
    token), ``loss_starts`` and ``loss_ends`` (the parts of ``formatted`` under the mask, in code points).

    Rows go by turn, then role, then text (null turns first). A null text or role is empty; rows with a null id make up
    one conversation; repeated rows are turns of their own. An empty table gives no rows; other columns are not
    looked at. A conversation is encoded in one piece, so one must fit in a task; many never share one.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = conversations.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file, of fixed size
    turns = conversations.select(
        F.col(id_col).cast("string").alias("conv_id"),
        F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("t"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns")).select("conv_id", "turns.role", "turns.text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_str(spec.value)
        encoder.encode_special_tokens = True  # the template's own escapes decide what is control
        for batch in batches:
            for part in slices(batch):
                rows = []
                for r, t in zip(part.column("role"), part.column("text")):
                    text, spans = render(list(zip(r.as_py(), t.as_py())), learn)
                    # one by one: an encoding takes a hundred times its text's memory, and a batch would be encoded by a thread
                    # for each of the machine's cores, each with a heap of its own that the worker keeps
                    code = encoder.encode(text, add_special_tokens=False)
                    tokens = np.array(code.offsets, dtype=np.int64).reshape(-1, 2)
                    mask, starts, ends = masked_spans(tokens, np.array(spans, dtype=np.int64).reshape(-1, 2))
                    rows.append((text, np.array(code.ids, dtype=np.int32), mask, starts, ends))
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv_id").cast(pa.string()), pa.array([len(r) for r in part.column("role")], pa.int64()),
                     *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(
                         (pa.string(), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.list_(pa.int64()))))],
                    names=["conv_id", "n_turns", "formatted", "token_ids", "loss_mask", "loss_starts", "loss_ends"])

    out = whole.mapInArrow(encode, _DDL)
    return out.withColumn("conv_id", F.col("conv_id").cast(conversations.schema[id_col].dataType)).withColumnRenamed("conv_id", id_col)


def digests(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """What the output says when it is read back: turns parsed from the text, loss text taken by the spans."""
    import hashlib

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, starts, ends in zip(*(batch.column(c) for c in ("formatted", "loss_starts", "loss_ends"))):
                text = text.as_py()
                turns = parsed(text)
                # parts that touch are one text; unescaping looks at whole texts only
                spans: list[list[int]] = []
                for s, e in zip(starts.as_py(), ends.as_py()):
                    if spans and spans[-1][1] == s:
                        spans[-1][1] = e
                    else:
                        spans.append([s, e])
                loss = "".join(unescaped(text[s:e]) for s, e in spans)
                sha = lambda x: hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest()
                rows.append((len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(text)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(pa.string()), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(
                    (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())))],
                names=["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    got = formatted.select(F.col(id_col).cast("string").alias("id"), "formatted", "loss_starts", "loss_ends").mapInArrow(
        read, "id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return got.withColumn("id", F.col("id").cast(formatted.schema[id_col].dataType)).withColumnRenamed("id", id_col)

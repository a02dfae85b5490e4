"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as ``<turn>role<text>words</turn>`` for each turn.  Inside roles and texts ``\\`` becomes
``\\\\`` and ``<`` becomes ``\\l``, so no text can hold a marker and the rendering reads back exactly.  The rendering is
encoded once with character offsets; the markers are special tokens, so no token crosses from one field to the next.  A
token is under the loss mask if its span meets an assistant text's span, found by binary search in the sorted spans.

Long conversations are rendered in parts that end where a turn ends, so memory and tasks stay bounded; since every part
ends with a marker, the tokens of the parts are the tokens of the whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, BODY, CLOSE = "<turn>", "<text>", "</turn>"
#: Turns of one part, by number, and the characters after which a part ends early.
TURNS, CHARS = 64, 200_000

_TURN = re.compile(f"{OPEN}([^<]*){BODY}([^<]*){CLOSE}")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\l")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: "<" if m[1] == "l" else m[1], text)


def rendered(turns: list[tuple[str, str]], trained: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The rendering of (role, text) turns, and the spans of the escaped texts of role ``trained``, ascending."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = OPEN + escaped(role) + BODY, escaped(text)
        at += len(head)
        if role == trained:
            spans.append((at, at + len(body)))
        at += len(body) + len(CLOSE)
        parts += (head, body, CLOSE)
    return "".join(parts), spans


def parsed(text: str) -> list[tuple[str, str]]:
    """The turns of a rendering."""
    return [(unescaped(role), unescaped(body)) for role, body in _TURN.findall(text)]


def under(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Whether each token (starts, ends) meets one of the ascending, disjoint ``spans``."""
    if not spans:
        return np.zeros(len(starts), dtype=bool)
    first, last = np.array(spans, dtype=np.int64).T
    at = np.searchsorted(last, starts, side="right")  # the first span that ends after the token begins
    begins = np.append(first, np.iinfo(np.int64).max)[at]
    return (begins < ends) & (starts < ends)


def masked_text(text: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> str:
    """The unescaped text under the mask; tokens that share a character show it once."""
    reach = 0
    pieces: list[tuple[int, int]] = []
    for s, e in zip(starts[mask].tolist(), ends[mask].tolist()):
        if pieces and s <= reach:
            pieces[-1] = (pieces[-1][0], max(reach, e))
        else:
            pieces.append((s, e))
        reach = max(reach, e)
    return "".join(unescaped(text[s:e]) for s, e in pieces)


_PART = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("part", pa.int64()), ("text", pa.string()), ("ids", pa.list_(pa.int32())),
                   ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("loss", pa.list_(pa.bool_()))])


def formatted(conversations: DataFrame, tokenizer: str, trained: str = "assistant") -> DataFrame:
    """Parts of every conversation: conv_id, block and part (their order), text, ids, token starts and ends, loss.

    Turns are ordered by turn (null first), then role and text, so ties and repeated rows have a fixed order and all
    stay.  Null roles and texts are empty; rows without conv_id are one conversation.  Extra columns are ignored.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("conv_id", F.coalesce(F.floor(F.col("turn") / TURNS).cast("long"), F.lit(-2 ** 63)).alias("block"), "turn", "role", "text")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_file(tokenizer)
        encoder.add_special_tokens([OPEN, BODY, CLOSE])

        def part(key, number, turns) -> pa.RecordBatch:
            text, spans = rendered(turns, trained)
            tokens = encoder.encode(text, add_special_tokens=False)
            starts, ends = np.array(tokens.offsets, dtype=np.int64).reshape(-1, 2).T
            row = (*key, number, text, tokens.ids, starts, ends, under(starts, ends, spans))
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _PART)], schema=_PART)

        now, number, turns, chars = None, 0, [], 0
        for batch in batches:
            for conv, block, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4))):
                if turns and ((conv, block) != now or chars >= CHARS):
                    yield part(now, number, turns)
                    number, turns, chars = (number + 1 if (conv, block) == now else 0), [], 0
                now = conv, block
                turns.append((role, text))
                chars += len(text)
        if turns:
            yield part(now, number, turns)

    schema = "conv_id long, block long, part long, text string, ids array<int>, starts array<long>, ends array<long>, loss array<boolean>"
    return rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "turn", "role", "text").mapInArrow(render, schema)


def digests(parts: DataFrame) -> DataFrame:
    """What ``parts`` say when read back, a row a conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256
    and formatted_chars.  Digests are streamed: a task holds one part at a time, however long the conversation."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, rows = None, None, []

        def close():
            if state is not None:
                n, turns, chars, loss, size = state
                rows.append((now, n, turns.hexdigest(), chars, loss.hexdigest(), size))

        for batch in batches:
            table = batch.select(["conv_id", "text", "starts", "ends", "loss"])
            for conv, text, starts, ends, mask in zip(table.column(0).to_pylist(), table.column(1).to_pylist(), table.column(2), table.column(3), table.column(4)):
                if state is None or conv != now:
                    close()
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in parsed(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{body}\n".encode())
                lost = masked_text(text, starts.values.to_numpy(), ends.values.to_numpy(), mask.values.to_numpy(zero_copy_only=False))
                state[2] += len(lost)
                state[3].update(lost.encode())
                state[4] += len(text)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)
            rows = []
        close()
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    ordered = parts.select("conv_id", "block", "part", "text", "starts", "ends", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "block", "part")
    return ordered.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

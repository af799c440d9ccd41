"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as a whole, encoded once with offsets, and the spans of the assistant's texts are
intersected with the token spans by binary search. The template's markers are added tokens, so no token straddles the
edge of a text; control strings inside texts are escaped so that they stay text and can be read back exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# Control strings of common chat templates, which must not be read as markers when a text holds them.
CONTROL = (
    TURN, TEXT, END, "<|endoftext|>", "<|startoftext|>", "<|im_start|>", "<|im_end|>",
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)
_CONTROL = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL))
_TURNS = re.compile(f"{re.escape(TURN)}(.*?){re.escape(TEXT)}(.*?){re.escape(END)}", re.DOTALL)


def escape(text: str) -> str:
    """Double every backslash and put one behind the first character of every control string."""
    return _CONTROL.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(turns: Sequence[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as one text, and the [start, end) of each turn's text in it, in code points."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation."""
    return [(unescape(role), unescape(text)) for role, text in _TURNS.findall(formatted)]


def token_ranges(starts: np.ndarray, ends: np.ndarray, spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Tokens [first, last) that lie inside each span; both lists are sorted, so two binary searches per span."""
    if not spans:
        return []
    edges = np.asarray(spans, np.int64)
    first = np.searchsorted(starts, edges[:, 0], "left")
    last = np.maximum(np.searchsorted(ends, edges[:, 1], "right"), first)
    return list(zip(first.tolist(), last.tolist(), strict=True))


def load_tokenizer(path: str):
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.add_special_tokens([AddedToken(c, normalized=False, special=True) for c in (TURN, TEXT, END)])
    return tokenizer


FORMATTED = (
    "conv_id long, n_turns long, formatted string, token_ids array<int>, loss_tokens array<struct<first:int,last:int>>, "
    "loss_spans array<struct<start:int,end:int>>"
)


def format_conversations(turns: DataFrame, tokenizer_path: str, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text): rendered text, ids, loss mask.

    Turns are ordered by turn, then role, then text; null turns come last, null roles and texts are empty, repeated
    rows stay, and null conv_ids form one conversation. ``loss_tokens`` are ranges of token positions under the mask,
    ``loss_spans`` the same ranges in code points of ``formatted``; an empty text has an empty range. An empty table
    gives no rows; further columns are ignored. A conversation is one row, so it has to fit one task; texts of any
    length up to that are encoded whole.
    """
    key = F.struct(
        F.col("turn").isNull().alias("late"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    talks = turns.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.array_sort(F.collect_list(key)).alias("turns"))
    talks = talks.select("conv_id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                rows = batch.slice(at, 64).to_pylist()
                out = []
                for row in rows:
                    formatted, spans = render(list(zip(row["roles"], row["texts"], strict=True)))
                    encoded = tokenizer.encode(formatted, add_special_tokens=False)
                    offsets = np.asarray(encoded.offsets, np.int64).reshape(-1, 2)
                    wanted = [s for s, role in zip(spans, row["roles"], strict=True) if role == loss_role]
                    ranges = token_ranges(offsets[:, 0], offsets[:, 1], wanted)
                    out.append(
                        {
                            "conv_id": row["conv_id"],
                            "n_turns": len(spans),
                            "formatted": formatted,
                            "token_ids": encoded.ids,
                            "loss_tokens": [{"first": a, "last": b} for a, b in ranges],
                            "loss_spans": [
                                {"start": int(offsets[a, 0]), "end": int(offsets[b - 1, 1])} if b > a else {"start": s, "end": s}
                                for (a, b), (s, _) in zip(ranges, wanted, strict=True)
                            ],
                        }
                    )
                yield pa.RecordBatch.from_pylist(out, schema=_ARROW)

    return talks.mapInArrow(task, FORMATTED)


_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("formatted", pa.string()),
        ("token_ids", pa.list_(pa.int32())),
        ("loss_tokens", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
        ("loss_spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ]
)


def digests(formatted: DataFrame) -> DataFrame:
    """Read rendered conversations back: turns, loss text and their digests."""
    from hashlib import sha256

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                text = row["formatted"]
                turns = parse(text)
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in row["loss_spans"])
                told = "".join(f"{role}\n{said}\n" for role, said in turns)
                out.append(
                    {
                        "conv_id": row["conv_id"],
                        "n_turns": len(turns),
                        "turns_sha256": sha256(told.encode()).hexdigest(),
                        "loss_chars": len(loss),
                        "loss_sha256": sha256(loss.encode()).hexdigest(),
                        "formatted_chars": len(text),
                    }
                )
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_DIGESTS)

    columns = formatted.select("conv_id", "formatted", "loss_spans")
    return columns.mapInArrow(
        task,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


_DIGESTS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)

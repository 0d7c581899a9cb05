"""Formatting conversations with a compiled template, and reading the result back.

Turns of a conversation come together by one exchange on its id and stream through the template in
order, so a conversation is never held whole: its text leaves in parts of bounded length.  A digest
over a conversation needs its turns one after another, so one conversation is read by one task.

Defined cases: a null text or role is empty; a null turn comes first; turns of one number follow by
role and text; rows that repeat are turns of their own; a null id is a conversation of its own; an empty
table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import groupby
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from statcube.llm.chat_template import DEFAULT_TEMPLATE, compile_template, unescape

PART_CHARS = 1 << 20
PARTS = "conv_id long, part long, formatted string, learned array<struct<start: long, end: long>>"
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

_TURN = re.compile(r"\[INST\] (.*?) \[/INST\]|<<SYS>>(.*?)\n(.*?)<</SYS>>|(.*?)</s>", re.S)


def _batches(rows: Iterable[tuple[Any, ...]], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``size`` rows and, roughly, of bounded text."""
    held: list[tuple[Any, ...]] = []
    weight = 0
    for row in rows:
        held.append(row)
        weight += sum(len(v) for v in row if isinstance(v, (str, list)))
        if len(held) == size or weight > 4 * PART_CHARS:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema=schema)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Any, ...]]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns])


def format_conversations(turns: DataFrame, template: str = DEFAULT_TEMPLATE, part_chars: int = PART_CHARS) -> DataFrame:
    """Formatted conversations: conv_id, part, formatted, learned.

    ``formatted`` of a conversation's parts in order is its text; ``learned`` holds the spans of each part
    that a model learns to produce, as code points from the part's start.
    """
    schema = pa.schema([
        ("conv_id", pa.int64()), ("part", pa.int64()), ("formatted", pa.string()),
        ("learned", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)

        def parts() -> Iterator[tuple[Any, ...]]:
            for conv_id, group in groupby(_rows(batches), key=lambda r: r[0]):
                messages = ({"role": r[2] or "", "text": r[3] or ""} for r in group)
                part, length, pieces, spans = 0, 0, [], []
                for text, learned in render(messages):
                    if length and length + len(text) > part_chars:
                        yield conv_id, part, "".join(pieces), spans
                        part, length, pieces, spans = part + 1, 0, [], []
                    if learned:
                        spans.append({"start": length, "end": length + len(text)})
                    pieces.append(text)
                    length += len(text)
                yield conv_id, part, "".join(pieces), spans

        yield from _batches(parts(), schema)

    kept = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    ordered = kept.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(run, PARTS)


def _read(parts: Iterable[tuple[Any, ...]]) -> tuple[int, str, int, str, int]:
    """Digests of one conversation from its formatted parts."""
    turns, loss = hashlib.sha256(), hashlib.sha256()
    n_turns = loss_chars = formatted_chars = 0
    rest = ""
    for _, part, formatted, learned in parts:
        formatted_chars += len(formatted)
        for span in learned:
            text = unescape(formatted[span["start"]:span["end"]])
            loss.update(text.encode())
            loss_chars += len(text)
        rest += formatted
        at = len("<s>") if part == 0 else 0
        while m := _TURN.match(rest, at):
            if m[1] is not None:
                role, text = "user", m[1]
            elif m[2] is not None:
                role, text = unescape(m[2]), m[3]
            else:
                role, text = "assistant", m[4]
            turns.update(f"{role}\n{unescape(text)}\n".encode())
            n_turns += 1
            at = m.end()
        rest = rest[at:]
    if rest:
        raise ValueError(f"formatted text that is no turn: {rest[:60]!r}")
    return n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), formatted_chars


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests per conversation, read from the formatted parts as ``format_conversations`` orders them."""
    schema = pa.schema([
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = groupby(_rows(batches), key=lambda r: r[0])
        yield from _batches(((conv_id, *_read(group)) for conv_id, group in groups), schema)

    return formatted.mapInArrow(run, DIGESTS)

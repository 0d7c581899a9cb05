"""Encoding texts with a public byte-pair vocabulary, and decoding the ids.

A text is cut at white space; each piece between is cut at special tokens, normalised (NFC, lower case) and
split into runs of letters, single numbers, runs of other characters and English endings.  Each part goes
through the automaton of :mod:`statcube.llm.bpe_automaton`; decoding joins the labels of the arcs.

The vocabulary is a file of the driver, at a path that the caller gives.  It is compiled once; the tables go
to the executors as one broadcast, whose size depends on the vocabulary alone (21 MB for 49,000 tokens).

Defined cases: a null or empty text has no ids and decodes to an empty text; repeated rows are encoded each;
a text of any length is encoded whole; a null list of ids decodes to an empty text and an id outside the vocabulary is
an error; an empty table gives no rows; other columns pass through, but one named as the result is replaced.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

from statcube.llm.bpe_automaton import Automaton, compile_merges

# White space of the split, and its English endings.
SPACES = "\t\n\x0b\f\r \x85\xa0  -     　"
ENDINGS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
# Letters and numbers of Unicode 16 that Python's Unicode 15.1 does not know, and the lower case of
# later letters: (first, last, distance).  The library has them; for U+11938 it has no composition.
NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NEW_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)
NEW_LOWER = (
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1),
    (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 32), (0x16EA0, 0x16EB8, 27),
)
UNCOMPOSED = ("\U00011938", "\U00011935\U00011930")
# Marks that the library's older tables leave where they stand.
UNMOVED = (
    (0x7FD, 0x7FD), (0x898, 0x89F), (0x8CA, 0x8D3), (0x9FE, 0x9FE), (0xC3C, 0xC3C), (0xD3B, 0xD3C), (0xEBA, 0xEBA),
    (0x1715, 0x1715), (0x1ABF, 0x1ACE), (0x1DF6, 0x1DFA), (0xA82C, 0xA82C), (0x10D24, 0x10D27), (0x10EAB, 0x10EAC),
    (0x10EFD, 0x10EFF), (0x10F46, 0x10F50), (0x10F82, 0x10F85), (0x11070, 0x11070), (0x1133B, 0x1133B),
    (0x1145E, 0x1145E), (0x11839, 0x1183A), (0x1193D, 0x1193E), (0x11943, 0x11943), (0x119E0, 0x119E0),
    (0x11A34, 0x11A34), (0x11A47, 0x11A47), (0x11A99, 0x11A99), (0x11D42, 0x11D42), (0x11D44, 0x11D45),
    (0x11D97, 0x11D97), (0x11F41, 0x11F42), (0x16FF0, 0x16FF1), (0x1E08F, 0x1E08F), (0x1E130, 0x1E136),
    (0x1E2AE, 0x1E2AE), (0x1E2EC, 0x1E2EF), (0x1E4EC, 0x1E4EF),
)

# Pieces and parts remembered by a task (some 50 MB each), and the longest that is.
REMEMBERED, REMEMBERED_CHARS = 250_000, 64
# Rows encoded and ids decoded at once: results leave a task in short batches.
ROWS, IDS_AT_ONCE = 256, 1 << 18


def _class(initial: str, more: tuple[tuple[int, int], ...], limit: int) -> str:
    """The inside of a character class: all characters of a general category below a limit."""
    member = np.array([unicodedata.category(chr(c))[0] == initial for c in range(0x110000)], np.int8)
    for first, last in more:
        member[first:last + 1] = 1
    member = member[:limit]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], member, [0]]))).tolist()
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edges[::2], edges[1::2]))


def part_patterns() -> list[str]:
    """Patterns of the parts that are encoded one by one: for ASCII, for the first plane, for all characters."""
    patterns = []
    for limit in (0x80, 0x10000, 0x110000):
        letters, numbers = _class("L", NEW_LETTERS, limit), _class("N", NEW_NUMBERS, limit)
        patterns.append("|".join([*ENDINGS, f"[{letters}]+", f"[{numbers}]", f"[^{letters}{numbers}{SPACES}]+"]))
    return patterns


def part_finder(patterns: list[str]) -> Callable[[str], list[str]]:
    """Cuts normalised text without white space into parts, by the narrowest pattern: wide ones are slow."""
    plain, plane, every = [re.compile(p).findall for p in patterns]

    def run(text: str) -> list[str]:
        return plain(text) if text.isascii() else plane(text) if max(text) < "\U00010000" else every(text)

    return run


def lowered() -> Callable[[str], str]:
    """Composed and lower-cased text, character by character: no character looks at its neighbours."""
    table = {c: c + by for first, last, by in NEW_LOWER for c in range(first, last + 1)}
    table[ord("Σ")] = ord("σ")

    # Marks between which the others are put in order, and the pair that is not composed.
    fixed = re.compile("([" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in UNMOVED) + f"]|{UNCOMPOSED[1]})")

    def run(text: str) -> str:
        if text.isascii():
            return text.lower()
        composed = [unicodedata.normalize("NFC", s) if i % 2 == 0 else s for i, s in enumerate(fixed.split(text))]
        return "".join(composed).translate(table).lower()

    return run


class Vocabulary:
    """A vocabulary file, compiled: ids of special tokens, label of every id, the automaton."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, steps = described["model"], [s["type"] for s in (described.get("normalizer") or {}).get("normalizers", [])]
        if model["type"] != "BPE" or steps != ["NFC", "Replace", "Lowercase"] or not model.get("end_of_word_suffix"):
            raise ValueError(f"{path} is no lower-case byte-pair vocabulary with word ends")
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.labels = [""] * (1 + max([*model["vocab"].values(), *self.special.values()]))
        for label, token in [*model["vocab"].items(), *self.special.items()]:
            self.labels[token] = label
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.automaton = compile_merges(model["vocab"], merges, model["end_of_word_suffix"])

    def tables(self) -> tuple:
        """What encoding needs, as plain values."""
        a = self.automaton
        return self.special, part_patterns(), list(a.spelling), a.target, a.group, a.arcs, a.n_states


@lru_cache(maxsize=4)
def read_vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class _Encoder:
    """Ids of whole texts; remembers pieces it has met, up to a bound."""

    def __init__(self, special: dict[str, int], patterns: list[str], *tables: object):
        self.automaton = Automaton(*tables)
        self.special = special
        # Without a start of a special token, which most pieces are, the split is left out.
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.start = os.path.commonprefix(list(special))
        self.normal, self.parts = lowered(), part_finder(patterns)
        self.cut = re.compile(f"[^{SPACES}]+").findall
        # Controls that Python takes for white space and the library does not.
        self.odd = re.compile("[\x1c-\x1f]").search
        self.known: dict[str, bytes] = {}
        self.known_parts: dict[str, bytes] = {}

    @staticmethod
    def keep(known: dict[str, bytes], text: str, found: bytes) -> bytes:
        if len(text) <= REMEMBERED_CHARS:
            if len(known) >= REMEMBERED:
                known.clear()
            known[text] = found
        return found

    def part(self, part: str) -> bytes:
        """Ids of a part, four bytes each."""
        found = self.known_parts.get(part)
        if found is None:
            ids = self.automaton.encode(part.encode())
            found = self.keep(self.known_parts, part, struct.pack(f"={len(ids)}i", *ids))
        return found

    def piece(self, piece: str) -> bytes:
        found = self.known.get(piece)
        if found is None:
            pieces = self.specials.split(piece) if self.special and self.start in piece else [piece]
            ids = []
            for i, some in enumerate(pieces):
                if i % 2:
                    ids.append(struct.pack("=i", self.special[some]))
                else:
                    ids.extend(map(self.part, self.parts(self.normal(some))))
            found = self.keep(self.known, piece, b"".join(ids))
        return found

    def text(self, text: str) -> bytes:
        pieces = self.cut(text) if self.odd(text) else text.split()
        return b"".join(map(self.piece, pieces))


def _with(df: DataFrame, column: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*[f for f in df.schema if f.name != column], T.StructField(column, kind)])


def encode_texts(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids") -> DataFrame:
    """The columns of ``docs`` and the ids of each whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary.tables())
    others = [c for c in docs.columns if c != ids]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(*sent.value)
        for batch in (b.slice(start, ROWS) for b in batches for start in range(0, b.num_rows, ROWS)):
            found = [encoder.text(t.as_py() or "") for t in batch.column(text)]
            offsets = np.concatenate([[0], np.cumsum([len(f) // 4 for f in found])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(offsets, np.frombuffer(b"".join(found), np.int32))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], lists], names=[*others, ids])

    return docs.mapInArrow(run, _with(docs, ids, T.ArrayType(T.IntegerType())))


def decode_ids(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The columns of ``encoded`` and the labels of each row's ids, joined by a space, special tokens included."""
    sent = encoded.sparkSession.sparkContext.broadcast(vocabulary.labels)
    others = [c for c in encoded.columns if c != text]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = pa.array(sent.value, pa.string())
        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(ids)), 0).to_numpy(zero_copy_only=False))
            start = 0
            while start < batch.num_rows:
                # As many rows as stay below the bound, but one at least.
                upto = (ends[start - 1] if start else 0) + IDS_AT_ONCE
                stop = max(start + 1, int(np.searchsorted(ends, upto, "right")))
                some = batch.slice(start, stop - start)
                lengths = np.diff(ends[start:stop], prepend=ends[start - 1] if start else 0)
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                spelt = pc.binary_join(pa.ListArray.from_arrays(offsets, labels.take(some.column(ids).flatten())), " ")
                yield pa.RecordBatch.from_arrays([*[some.column(c) for c in others], spelt], names=[*others, text])
                start = stop

    return encoded.mapInArrow(run, _with(encoded, text, T.StringType()))

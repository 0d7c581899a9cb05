"""Removal of passages that an earlier document has, by difference-cover anchors.

A difference cover modulo ``PERIOD`` holds, for any two residues, a shift that brings both into the cover.
So if two documents share a run of ``WINDOW`` words, then whatever the positions, an anchor of
``ANCHOR`` = WINDOW - PERIOD + 1 words starts at a cover position in both, inside the run.  Only windows
at cover positions are hashed and exchanged, 3 of 7.  Anchors found in two documents are then extended: every
window of full length around them is hashed with 96 bits and met with the equal ones; a window is removed
when a smaller document has it.

Meeting happens in buckets of a hash, whose number grows with the text so that a bucket stays small.  Entries
travel as packed arrays.  A task first meets the entries of its own documents: what is decided there goes
round the buckets, and one witness per hash stands for the rest.  So a passage in a third of all
documents sends one entry per block of documents into its bucket.  Marks go back packed to the part of the
documents they belong to, parts being another hash, and are read beside its texts.

Defined cases: a null or empty text has no words; a row without id is left whole and no one's source; rows
that repeat an id are one document, judged each by its own text; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from statcube.llm.wordhash import windows, word_hashes

WINDOW = 13
PERIOD, COVER = 7, (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1

# Words of the documents that a task meets at once, bytes of text per bucket, and per part of the documents.
BLOCK_WORDS = 1 << 20
BUCKET_BYTES = 16 << 20
PART_BYTES = 4 << 20

_MARK = np.dtype([("at", "<u4"), ("check", "<u2")])
_WITNESS = np.uint32(0xFFFFFFFF)
_ENTRIES = "bucket long, decided boolean, low binary, high binary, docs binary, at binary"
_MARKS = "part long, docs binary, marks binary"
_RESULT = "doc_id long, n_words long, n_removed long, kept_text string"
_ENTRY_SCHEMA = pa.schema([
    ("bucket", pa.int64()), ("decided", pa.bool_()), ("low", pa.binary()), ("high", pa.binary()),
    ("docs", pa.binary()), ("at", pa.binary())])


def _planes(a: np.ndarray) -> bytes:
    """Bytes of one significance together: the zero ones then take no space once compressed."""
    return a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()


def _from_planes(data: bytes, dtype: type) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.frombuffer(data, np.uint8).reshape(width, -1).T.copy().view(dtype).ravel()


Texts = Iterable[tuple[int, str, np.ndarray]]
_NO_MARKS = np.zeros(0, _MARK)


def _unmarked(batches: Iterable[pa.RecordBatch]) -> Texts:
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            yield doc_id, text.as_py() or "", _NO_MARKS


def _with_marks(rows: pa.Table, marks: pa.Table) -> Texts:
    """Rows of one part with the marks that the buckets sent for it."""
    docs = np.concatenate([_from_planes(b, np.int64) for b in marks.column("docs").to_pylist()] or [np.zeros(0, np.int64)])
    found = np.concatenate([np.frombuffer(b, _MARK) for b in marks.column("marks").to_pylist()] or [_NO_MARKS])
    order = np.argsort(docs, kind="stable")
    docs, found = docs[order], found[order]
    for doc_id, text in zip(rows.column("doc_id").to_pylist(), rows.column("text")):
        first, last = np.searchsorted(docs, [doc_id, doc_id + 1])
        yield doc_id, text.as_py() or "", found[first:last]


def _part_of(docs: np.ndarray, parts: int) -> np.ndarray:
    """The part of an id; ``_part_column`` is the same in Spark."""
    return (docs ^ (docs >> 17) ^ (docs >> 31)) % parts


def _part_column(parts: int) -> Column:
    d = F.col("doc_id")
    return F.pmod(d.bitwiseXOR(F.shiftright(d, 17)).bitwiseXOR(F.shiftright(d, 31)), F.lit(parts))


Found = tuple[np.ndarray, np.ndarray, np.ndarray]


def _anchors(words: np.ndarray, _: np.ndarray) -> Found:
    at = np.flatnonzero(np.isin(np.arange(max(0, len(words) - ANCHOR + 1)) % PERIOD, COVER))
    low = windows(words, ANCHOR)[at]
    return low, np.zeros(0, np.uint64), at


def _marked(words: np.ndarray, found: np.ndarray, width: int) -> np.ndarray:
    """Positions of marks, of those that are this text's by their check bits."""
    hashes = windows(words, width)
    found = found[found["at"] < len(hashes)]
    at = found["at"].astype(np.int64)
    return at[hashes[at].astype(np.uint16) == found["check"]]


def _windows_around(words: np.ndarray, marks: np.ndarray) -> Found:
    n = len(words) - WINDOW + 1
    anchors = _marked(words, marks, ANCHOR)
    if n <= 0 or not len(anchors):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    near = np.zeros(n + PERIOD, bool)
    for shift in range(PERIOD):
        starts = anchors - shift
        near[starts[starts >= 0].clip(max=n)] = True
    at = np.flatnonzero(near[:n])
    return windows(words, WINDOW)[at], windows(words, WINDOW, first=WINDOW)[at], at


def _groups(order: np.ndarray, keys: list[np.ndarray], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sorted entries: first of its group?, smallest document and largest document of the group."""
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        k = key[order]
        new[1:] |= k[1:] != k[:-1]
    starts = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    ends = np.append(starts[1:], len(order)) - 1
    d = docs[order]
    return new, d[starts][group] if len(order) else d, d[ends][group] if len(order) else d


def _entries(find: Callable[[np.ndarray, np.ndarray], Found], later_only: bool, buckets: int):
    """Task function: entries of blocks of documents, those decided within a block apart."""
    schema = _ENTRY_SCHEMA

    def block(found: list[tuple[int, Found]], number: int) -> Iterator[pa.RecordBatch]:
        low, high, at = (np.concatenate([f[k] for _, f in found]) for k in range(3))
        docs = np.repeat(np.array([d for d, _ in found], np.int64), [len(f[2]) for _, f in found])
        if not len(low):
            return
        at = at.astype(np.uint32)
        keys = [low, high] if len(high) else [low]
        order = np.lexsort([docs, *keys[::-1]])
        new, least, most = _groups(order, keys, docs)
        decided = docs[order] > least if later_only else most > least
        rows = []
        known = order[decided]
        if len(known):
            spread = (number * 7919 + int(docs[known[0]])) % buckets
            rows.append((spread, True, low[known].astype(np.uint16).tobytes(), b"", _planes(docs[known]), _planes(at[known])))
        sent = ~decided | (new & decided)
        places = np.where(decided, _WITNESS, at[order])[sent]
        sent = order[sent]
        bucket = ((low[sent] >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
        by_bucket = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[by_bucket], prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:]):
            part = by_bucket[a:b]
            own = sent[part]
            rows.append((
                int(bucket[part[0]]), False, low[own].astype(np.uint32).tobytes(), high[own].tobytes() if len(high) else b"",
                _planes(docs[own]), _planes(places[part])))
        yield pa.RecordBatch.from_arrays([pa.array(c, schema.field(i).type) for i, c in enumerate(zip(*rows))], schema=schema)

    def run(texts: Texts) -> Iterator[pa.RecordBatch]:
        found, n, number = [], 0, 0
        for doc_id, text, marks in texts:
            words = word_hashes(text.encode())
            found.append((doc_id, find(words, marks)))
            n += len(words)
            if n >= BLOCK_WORDS:
                yield from block(found, number)
                found, n, number = [], 0, number + 1
        if found:
            yield from block(found, number)

    return run


def _meet(later_only: bool, parts: int) -> Callable[[pa.Table], pa.Table]:
    """Group function: marks of one bucket, packed by the part that their documents are in."""

    def meet(bucket: pa.Table) -> pa.Table:
        docs_out, at_out, check_out = [], [], []
        fields: list[list[np.ndarray]] = [[], [], [], []]
        for decided, low, high, docs, at in zip(*[bucket.column(c).to_pylist() for c in ("decided", "low", "high", "docs", "at")]):
            d, p = _from_planes(docs, np.int64), _from_planes(at, np.uint32)
            if decided:
                docs_out.append(d), at_out.append(p), check_out.append(np.frombuffer(low, np.uint16))
            else:
                for field, value in zip(fields, (np.frombuffer(low, np.uint32), np.frombuffer(high, np.uint64), d, p)):
                    field.append(value)
        if fields[0]:
            low, high, docs, at = map(np.concatenate, fields)
            keys = [low, high] if len(high) else [low]
            order = np.lexsort([docs, *keys[::-1]])
            _, least, most = _groups(order, keys, docs)
            chosen = order[((docs[order] > least) if later_only else (most > least)) & (at[order] != _WITNESS)]
            docs_out.append(docs[chosen]), at_out.append(at[chosen]), check_out.append(low[chosen].astype(np.uint16))
        docs, at, check = np.concatenate(docs_out), np.concatenate(at_out), np.concatenate(check_out)
        part = _part_of(docs, parts)
        order = np.lexsort([docs, part])
        docs, part = docs[order], part[order]
        marks = np.empty(len(order), _MARK)
        marks["at"], marks["check"] = at[order], check[order]
        edges = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(order))
        spans = list(zip(edges[:-1], edges[1:]))
        return pa.table({
            "part": pa.array([int(part[x]) for x, _ in spans], pa.int64()),
            "docs": pa.array([_planes(docs[x:y]) for x, y in spans], pa.binary()),
            "marks": pa.array([marks[x:y].tobytes() for x, y in spans], pa.binary())})

    return meet


def _removed(texts: Texts) -> pa.RecordBatch:
    out: list[list[object]] = [[], [], [], []]
    for doc_id, text, marks in texts:
        data = text.encode()
        words = data.split()
        n, n_removed = len(words), 0
        starts = _marked(word_hashes(data), marks, WINDOW) if len(marks) else ()
        if len(starts):
            covered = np.zeros(n + 1, np.int64)
            np.add.at(covered, starts, 1)
            np.add.at(covered, starts + WINDOW, -1)
            keep = np.cumsum(covered[:n]) == 0
            n_removed = n - int(keep.sum())
            words = [w for w, k in zip(words, keep.tolist()) if k]
        for column, value in zip(out, (doc_id, n, n_removed, b" ".join(words).decode())):
            column.append(value)
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["doc_id", "n_words", "n_removed", "kept_text"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by one space) of every row.

    Runs one job when called, the sum of text lengths that sets the number of buckets.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, parts = 1 + size // BUCKET_BYTES, 1 + 2 * (size // (2 * PART_BYTES))
    by_part = rows.where("doc_id IS NOT NULL").withColumn("part", _part_column(parts))

    def met(entries: DataFrame, later_only: bool):
        return entries.groupBy("bucket").applyInArrow(_meet(later_only, parts), _MARKS).groupBy("part")

    find_anchors = _entries(_anchors, False, buckets)
    find_windows = _entries(_windows_around, True, buckets)

    def around(texts: pa.Table, marks: pa.Table) -> pa.Table:
        return pa.Table.from_batches(find_windows(_with_marks(texts, marks)), schema=_ENTRY_SCHEMA)

    def remaining(texts: pa.Table, marks: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_removed(_with_marks(texts, marks))])

    anchors = met(by_part.drop("part").mapInArrow(lambda batches: find_anchors(_unmarked(batches)), _ENTRIES), False)
    repeats = met(by_part.groupBy("part").cogroup(anchors).applyInArrow(around, _ENTRIES), True)
    named = by_part.groupBy("part").cogroup(repeats).applyInArrow(remaining, _RESULT)
    nameless = rows.where("doc_id IS NULL").mapInArrow(lambda batches: (_removed(_unmarked([b])) for b in batches), _RESULT)
    return named.union(nameless)

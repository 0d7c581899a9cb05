"""Benchmark passages in documents, by the q-gram lemma and banded alignment.

Texts are compared in lower case with white space as one blank.  An item of m characters occurs in a
document when a part of it is within e = floor(0.1 m) edits of the whole item.  Such an occurrence shares
at least m - q + 1 - q e q-grams with the item, all on e + 1 neighbouring diagonals (position in the
document minus position in the item).  q is 8, or for short items as much less as that number needs to be 1 or more.  So shared q-grams are counted in overlapping bands of
2 (e + 1) diagonals, bands with fewer are dropped, and the others are verified by an alignment inside the
band.  The lemma loses no occurrence.

Items go to the tasks in blocks of bounded size, and each block takes one pass over the documents; no
document is shuffled.

Defined cases: null and empty texts have no occurrence; items below 10 characters have no edits, so they are
found as they are; items of equal text are found each by its own id; rows that repeat are searched each
for itself; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from statcube.llm.wordhash import MULTIPLIERS, mixed

Q = 8
# One edit for so many characters of an item.
CHARS_PER_EDIT = 10
# Shared q-grams of a document counted at once, which bounds memory where many items share a q-gram.
HITS_AT_ONCE = 1 << 20
# Bytes of item text sent to every task at once.
BLOCK_BYTES = 4 << 20

OCCURRENCES = "doc_id long, item_id long, start long, end long, edits long"
_TABLE_BITS = 22
_FAR = np.int64(1 << 40)  # above every position in a text


def normalised(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points in lower case with single blanks, and where each stood in the text."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower()[:1] or c for c in text)
    points = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = (points == 32) | ((points >= 9) & (points <= 13)) | (points == 0xA0)
    keep = np.ones(len(points), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    return np.where(space, np.uint32(32), points)[keep], np.flatnonzero(keep)


def qgrams(points: np.ndarray, q: int = Q) -> np.ndarray:
    n = len(points) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    wide, total = points.astype(np.uint64), np.zeros(n, np.uint64)
    for k in range(q):
        total += wide[k:k + n] * MULTIPLIERS[k]
    return mixed(total)


def edit_budget(length: int) -> int:
    """Edits allowed to an item."""
    return length // CHARS_PER_EDIT


def gram_length(length: int) -> int:
    """The q of an item: within its budget of edits at least one of its q-grams stays whole."""
    return min(Q, length // (edit_budget(length) + 1))


def item_groups(rows: list[tuple[int, str]]) -> list[Items]:
    """The items of a block, grouped by the length of their q-grams."""
    groups: dict[int, list[tuple[int, np.ndarray]]] = {}
    for i, text in rows:
        points = normalised(text)[0] if text else np.zeros(0, np.uint32)
        points = points[1:] if len(points) and points[0] == 32 else points
        points = points[:-1] if len(points) and points[-1] == 32 else points
        if len(points):
            groups.setdefault(gram_length(len(points)), []).append((i, points))
    return [Items(prepared, q) for q, prepared in sorted(groups.items())]


class Items:
    """Q-grams of items with one q, sorted, with a bit table in front."""

    def __init__(self, prepared: list[tuple[int, np.ndarray]], q: int):
        self.q = q
        self.ids = [i for i, _ in prepared]
        self.points = [p for _, p in prepared]
        self.budget = np.array([edit_budget(len(p)) for p in self.points], np.int64)
        self.needed = np.array([len(p) - q + 1 for p in self.points], np.int64) - q * self.budget
        grams = [qgrams(p, q) for p in self.points]
        keys = np.concatenate(grams)
        order = np.argsort(keys, kind="stable")
        self.keys, self.first, self.n = np.unique(keys[order], return_index=True, return_counts=True)
        self.item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])[order]
        self.at = np.concatenate([np.arange(len(g)) for g in grams])[order]
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[keys >> np.uint64(64 - _TABLE_BITS)] = True

    def places(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of a document whose q-gram some item has, and which q-gram that is."""
        places = np.flatnonzero(self.table[grams >> np.uint64(64 - _TABLE_BITS)])
        key = np.searchsorted(self.keys, grams[places]).clip(max=len(self.keys) - 1)
        same = self.keys[key] == grams[places]
        return places[same], key[same]

    def hits(self, places: np.ndarray, key: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Items and diagonals of all q-grams that a document shares with the items, in bounded parts."""
        ends = np.cumsum(self.n[key])
        start = 0
        while start < len(places):
            upto = (ends[start - 1] if start else 0) + HITS_AT_ONCE
            stop = max(start + 1, int(np.searchsorted(ends, upto, "right")))
            first, n = self.first[key[start:stop]], self.n[key[start:stop]]
            entry = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
            yield self.item[entry], np.repeat(places[start:stop], n) - self.at[entry]
            start = stop


def crowded_bands(items: Items, places: np.ndarray, key: np.ndarray) -> list[tuple[int, int]]:
    """Items and first diagonals of the bands that meet the lemma's count."""
    shared = np.zeros(len(items.ids), np.int64)
    for item, _ in items.hits(places, key):
        shared += np.bincount(item, minlength=len(items.ids))
    enough = shared >= items.needed
    if not enough.any():
        return []
    parts, counts = [], []
    for item, diagonal in items.hits(places, key):
        item, diagonal = item[enough[item]], diagonal[enough[item]]
        # One number per item and band.  A diagonal lies in the band that starts at its step and in the one before.
        band = np.floor_divide(diagonal, items.budget[item] + 1) + _FAR
        keys = item * (2 * _FAR) + band
        keys, n = np.unique(np.concatenate([keys, keys - 1]), return_counts=True)
        parts.append(keys)
        counts.append(n)
    keys, place = np.unique(np.concatenate(parts), return_inverse=True)
    total = np.bincount(place, np.concatenate(counts)).astype(np.int64)
    full = keys[total >= items.needed[keys // (2 * _FAR)]]
    return [(int(k // (2 * _FAR)), int((k % (2 * _FAR) - _FAR) * (items.budget[k // (2 * _FAR)] + 1))) for k in full]


def aligned(item: np.ndarray, document: np.ndarray, low: int, budget: int) -> tuple[int, int, int]:
    """Fewest edits that align the whole item inside a band, with start and end in the document.

    Stops once every cell of a row is over the budget.

    Cell k of row p stands at document position p + low + k.  Cost and start share one integer, so the
    minimum takes the fewest edits and then the earliest start.
    """
    m, width = len(item), 2 * (budget + 1)
    unit = _FAR
    at = np.arange(low, low + m + width)
    padded = np.where((at >= 0) & (at < len(document)), document[at.clip(0, max(0, len(document) - 1))], np.uint32(0xFFFFFFFF))
    steps = np.arange(width) * unit
    cost = np.arange(low, low + width).clip(0, len(document)).astype(np.int64)
    for p in range(m):
        moved = cost + np.where(padded[p:p + width] == item[p], 0, unit)
        np.minimum(moved[:-1], cost[1:] + unit, out=moved[:-1])
        cost = np.minimum.accumulate(moved - steps) + steps
        if p % 8 == 7 and cost.min() > (budget + 1) * unit:
            break
    k = int(np.argmin(cost))
    return int(cost[k] // unit), int(cost[k] % unit), min(len(document), max(0, m + low + k))


def occurrences(groups: list[Items], text: str) -> list[tuple[int, int, int, int]]:
    """(item id, start, end, edits) of the verified regions; of overlapping ones of an item, the best."""
    points, place = normalised(text)
    rows = []
    for items in groups:
        places, key = items.places(qgrams(points, items.q))
        if not len(places):
            continue
        found: dict[int, list[tuple[int, int, int]]] = {}
        for i, low in crowded_bands(items, places, key):
            edits, start, end = aligned(items.points[i], points, low, int(items.budget[i]))
            if edits <= items.budget[i] and end > start:
                found.setdefault(i, []).append((edits, start, end))
        for i, regions in found.items():
            taken: list[tuple[int, int, int]] = []
            for edits, start, end in sorted(regions):
                if all(end <= s or start >= e for _, s, e in taken):
                    taken.append((edits, start, end))
                    rows.append((items.ids[i], int(place[start]), int(place[end - 1]) + 1, edits))
    return rows


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``block_bytes``: only one block is held at a time."""
    rows = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long"), "text").distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // block_bytes
    for block in range(blocks):
        picked = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield [(r[0], r[1]) for r in picked.orderBy("item_id", "text").collect()]


def find_occurrences(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start, end, edits: every occurrence, in code points of the document.

    Reads the benchmark when called.
    """
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    return reduce(DataFrame.union, [_search(texts, rows) for rows in item_blocks(benchmark)])


def _search(texts: DataFrame, rows: list[tuple[int, str]]) -> DataFrame:
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "item_id", "start", "end", "edits")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = item_groups(rows)
        for batch in batches:
            found = [
                (doc_id, *region) for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1))
                for region in occurrences(items, text.as_py() or "")]
            columns = list(zip(*found)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return texts.mapInArrow(run, OCCURRENCES)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any occurrence; all columns pass through, no row is moved."""
    kept = docs
    for rows in item_blocks(benchmark):
        kept = kept.where(~_contains(rows)(F.col("text")))
    return kept


def _contains(rows: list[tuple[int, str]]) -> Callable[[Column], Column]:
    @F.pandas_udf("boolean")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items = item_groups(rows)
        for texts in batches:
            yield pd.Series([isinstance(t, str) and bool(occurrences(items, t)) for t in texts], dtype=bool)

    return found

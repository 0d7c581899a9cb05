"""Elements of XML messages as nested Arrow arrays, a slice of messages at a time.

Expat says whether a message is well-formed.  The tags of all messages of a slice are then looked at together, as
arrays of places in its bytes.  A message with markup beyond plain tags and texts (references, comments, CDATA,
single quotes inside tags, mixed content), or a broken one, is handed back for ``from_xml``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cached_property
from xml.parsers import expat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Bytes of messages looked at together; a longer message makes a slice of its own.
SLICE = 1 << 21

_SPACES = b" \t\n\r"
_STOPS = np.isin(np.arange(256), list(_SPACES + b"/>"))
_MARKS = np.isin(np.arange(256), list(_SPACES + b"/>:<"))
_LOOKED_AT = np.isin(np.arange(256), list(_SPACES + b"/>:<&\r\"'"))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def fits(kind: T.DataType) -> bool:
    """Whether elements of a type can be read here: no texts next to attributes."""
    if isinstance(kind, T.ArrayType):
        return fits(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(f.name != "_VALUE" and fits(f.dataType) for f in kind)
    return isinstance(kind, T.StringType)


def read(messages: pa.Array, kind: T.StructType, paths: Sequence[Sequence[str]]) -> tuple[pa.Array, pa.Array]:
    """Per message the elements below the first path that has any, or null and the message itself where it was not read."""
    if not len(messages):
        return pa.array([], pa.list_(to_arrow_type(kind))), messages
    whole = messages.cast(pa.large_binary())
    places = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    found, odd = [], []
    for first, last in _slices(places):
        part = _Slice(whole, places[first : last + 1], whole[first:last], kind, [name for path in paths for name in path])
        found.append(part.elements(paths))
        odd.append(part.odd)
    return pa.concat_arrays(found), pc.if_else(pa.array(np.concatenate(odd)), messages, None)


def _slices(places: np.ndarray) -> Iterator[tuple[int, int]]:
    first, n = 0, len(places) - 1
    while first < n:
        last = int(np.searchsorted(places, places[first] + SLICE, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def _fields(kind: T.DataType) -> Iterator[T.StructField]:
    if isinstance(kind, T.ArrayType):
        yield from _fields(kind.elementType)
    elif isinstance(kind, T.StructType):
        for f in kind:
            yield f
            yield from _fields(f.dataType)


def _well_formed(*parts: bytes | memoryview) -> bool:
    parser = expat.ParserCreate("utf-8")
    try:
        for i, part in enumerate(parts):
            parser.Parse(part, i == len(parts) - 1)
    except expat.ExpatError:
        return False
    return True


def _is_text(kind: T.DataType) -> bool:
    return isinstance(kind.elementType if isinstance(kind, T.ArrayType) else kind, T.StringType)


class _Slice:
    """Tags of some messages.

    ``at`` are the places of the bytes that matter to markup and ``chars`` these bytes.  ``lt`` and ``gt`` number
    those that begin and end tags, ``tag`` the opening ones among the tags.
    """

    def __init__(self, whole: pa.Array, places: np.ndarray, messages: pa.Array, kind: T.StructType, path: Sequence[str]):
        self.kind = kind
        self.ends = places - places[0]
        data = whole.buffers()[2]
        self.bytes = memoryview(data)[places[0] : places[-1]] if data else memoryview(b"")
        self.buf = np.frombuffer(self.bytes, np.uint8)
        self.absent = np.asarray(messages.is_null())
        self.odd = np.zeros(len(messages), bool)
        self.at = np.flatnonzero(_LOOKED_AT[self.buf])
        self.chars = self.buf[self.at]
        self.lt, self.gt = self._where(b"<"), self._where(b">")
        self.rank = np.cumsum(self.chars == ord("<"), dtype=np.int32)
        self._keep_plain()
        self._keep_well_formed()
        fields = list(_fields(kind))
        self.attributes = {f.name for f in fields if f.name.startswith("_")}
        self.texts = {f.name for f in fields if not f.name.startswith("_") and _is_text(f.dataType)}
        self.names = list(dict.fromkeys([*path, *(f.name for f in fields)]))
        self._open()
        self._quoted()

    def _where(self, chars: bytes) -> np.ndarray:
        mask = self.chars == chars[0]
        for char in chars[1:]:
            mask |= self.chars == char
        return np.flatnonzero(mask)

    def _message(self, marks: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, self.at[marks], "right") - 1

    def _drop_odd(self) -> None:
        if self.odd[self.message].any():
            kept = ~self.odd[self.message]
            self._take(kept, kept)

    def _take(self, lt: np.ndarray, gt: np.ndarray) -> None:
        self.lt, self.gt, self.message, self.rank = self.lt[lt], self.gt[gt], self.message[lt], None

    # --- which messages are plain ---

    def _keep_plain(self) -> None:
        """Messages whose tags are all from ``<`` to the only ``>`` before the next ``<``."""
        opened, closed = (np.diff(np.searchsorted(self.at[p], self.ends)) for p in (self.lt, self.gt))
        self.odd |= (opened != closed) | (opened == 0)
        self.odd[self._message(self._where(b"&\r"))] = True
        self.message = np.repeat(np.arange(len(self.odd)), opened)
        if self.odd.any():
            self._take(~self.odd[self.message], np.repeat(~self.odd, closed))
        self.odd[self.message[self.lt > self.gt]] = True
        self.odd[self.message[1:][self.gt[:-1] > self.lt[1:]]] = True
        self._drop_odd()
        second = self.buf[self.at[self.lt] + 1]
        self.odd[self.message[second == ord("!")]] = True
        declared = second == ord("?")
        if declared.any():
            leading = np.concatenate([[True], self.message[1:] != self.message[:-1]]) & (self.buf[self.at[self.gt] - 1] == ord("?"))
            self.odd[self.message[declared & ~leading]] = True
            self._take(~declared, ~declared)
        self.odd[self._message(self._inside(self._where(b"'"))[0])] = True

    def _inside(self, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those marks that are inside tags, and the tags."""
        tag = np.searchsorted(self.lt, marks, "right") - 1 if self.rank is None else self.rank[marks] - 1
        within = tag >= 0
        within[within] = marks[within] < self.gt[tag[within]]
        return marks[within], tag[within]

    def _keep_well_formed(self) -> None:
        self._drop_odd()
        if not self._well_formed_together():
            for i in np.flatnonzero(~self.odd & ~self.absent):
                self.odd[i] = not _well_formed(self.bytes[self.ends[i] : self.ends[i + 1]])
            self._drop_odd()

    def _well_formed_together(self) -> bool:
        """Whether messages that are one element from end to end each are well-formed inside a common root."""
        if self.odd.any():
            return False
        first, last = self.buf[self.ends[:-1]], self.buf[self.ends[1:] - 1]
        step = self._steps()[2]
        open_tags = np.cumsum(step)
        final = np.concatenate([self.message[1:] != self.message[:-1], [True]])
        apart = (first == ord("<")).all() and (last == ord(">")).all() and ((open_tags == 0) == final).all()
        return bool(apart) and _well_formed(b"<r>", self.bytes, b"</r>")

    def _steps(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        closing, empty = self.buf[self.at[self.lt] + 1] == ord("/"), self.buf[self.at[self.gt] - 1] == ord("/")
        return closing, empty, np.where(closing, -1, np.where(empty, 0, 1))

    # --- opening tags and their attributes ---

    @cached_property
    def _stops(self) -> tuple[np.ndarray, np.ndarray]:
        return self._ranked(_STOPS)

    @cached_property
    def _marks(self) -> tuple[np.ndarray, np.ndarray]:
        return self._ranked(_MARKS)

    def _ranked(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of some bytes, and how many of them there are up to each mark."""
        mask = chars[self.chars]
        return self.at[mask], np.cumsum(mask, dtype=np.int32)

    def _named(self, start: np.ndarray, end: np.ndarray, name: str, odd: np.ndarray) -> np.ndarray:
        """Which names are this one; a message that writes it in another case is odd."""
        wanted = np.frombuffer(name.encode(), np.uint8)
        found = np.flatnonzero(end - start == len(wanted))
        read = self.buf[start[found][:, None] + np.arange(len(wanted))]
        same = (read == wanted).all(axis=1)
        if not same.all():
            like = (_LOWER[read] == _LOWER[wanted]).all(axis=1)
            self.odd[odd[found[like & ~same]]] = True
        return found[same]

    def _open(self) -> None:
        closing, empty, step = self._steps()
        self.tag = np.flatnonzero(~closing)
        self.depth = (np.cumsum(step) - (step == 1))[self.tag]
        self.empty = empty[self.tag]
        stops, rank = self._stops
        marks, _ = self._marks
        end = stops[rank[self.lt[self.tag]]]
        # The last mark before the end is the next one after the ``<``, or a colon behind it.
        start = marks[np.searchsorted(marks, end) - 1] + 1 if len(end) else end
        message = self.message[self.tag]
        self.name = np.full(len(start), -1, np.int16)
        for i, name in enumerate(self.names):
            these = self._named(start, end, name, message)
            self.name[these] = i
            if name in self.attributes:
                self.odd[message[these]] = True
            elif name in self.texts:
                full = self.tag[these[~self.empty[these]]]
                self.odd[self.message[full[~closing[full + 1]]]] = True
        self.levels = [np.flatnonzero(self.depth == d) for d in range(int(self.depth.max(initial=-1)) + 1)]

    def _quoted(self) -> None:
        """Places of the wanted attributes of each tag."""
        quotes, tag = self._inside(self._where(b'"'))
        first, tag = quotes[0::2], tag[0::2]
        self.opens, self.closes = self.at[first], self.at[quotes[1::2]]
        end, message = self.opens - 1, self.message[tag]
        spaced = (self.buf[end] != ord("=")) | np.isin(self.buf[end - 1], list(_SPACES))
        self.odd[message[spaced]] = True
        breaks = self._where(b"\t\n")
        if len(first) and len(breaks):
            one = np.searchsorted(first, breaks, "right") - 1
            self.odd[self._message(breaks[(one >= 0) & (breaks < quotes[1::2][one])])] = True
        marks, rank = self._marks
        start = marks[rank[first] - 1] + 1
        self.quoted: dict[str, np.ndarray] = {}
        for name in self.attributes:
            these = self._named(start, end, name[1:], message)
            twice = these[1:][tag[these[1:]] == tag[these[:-1]]]
            self.odd[message[twice]] = True
            place = np.full(len(self.lt), -1)
            place[tag[these]] = these
            self.quoted[name] = place[self.tag]

    # --- arrays ---

    def _strings(self, start: np.ndarray, end: np.ndarray) -> pa.Array:
        """Trimmed texts between places."""
        size = end - start
        ends = np.concatenate([[0], np.cumsum(size)])
        data = self.buf[np.arange(ends[-1]) + np.repeat(start - ends[:-1], size)]
        texts = pa.StringArray.from_buffers(len(start), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data))
        return pc.ascii_trim(texts, _SPACES.decode())

    def _children(self, parents: np.ndarray, depth: int, name: str) -> tuple[np.ndarray, np.ndarray]:
        """Child tags of that name, with the place of the parent of each among the parents."""
        if depth + 1 >= len(self.levels) or not len(parents):
            return np.empty(0, int), np.empty(0, int)
        level, below = self.levels[depth], self.levels[depth + 1]
        below = below[self.name[below] == self.names.index(name)]
        above = level[np.searchsorted(level, below) - 1]
        place = np.minimum(np.searchsorted(parents, above), len(parents) - 1)
        known = parents[place] == above
        return below[known], place[known]

    def _last(self, parents: np.ndarray, depth: int, name: str) -> np.ndarray:
        """The last child of that name of each parent, or -1."""
        found, place = self._children(parents, depth, name)
        last = np.full(len(parents), -1)
        last[place] = found
        return last

    def _text_of(self, tags: np.ndarray) -> pa.Array:
        tag = self.tag[tags]
        start = self.at[self.gt[tag]] + 1
        following = self.at[self.lt[np.minimum(tag + 1, len(self.lt) - 1)]]
        return self._strings(start, np.where(self.empty[tags], start, following))

    def _values(self, kind: T.DataType, tags: np.ndarray, depth: int) -> pa.Array:
        if isinstance(kind, T.StringType):
            return self._text_of(tags)
        columns = [self._field(f, tags, depth) for f in kind]
        return pa.StructArray.from_arrays(columns, fields=[pa.field(f.name, c.type) for f, c in zip(kind, columns)])

    def _field(self, f: T.StructField, tags: np.ndarray, depth: int) -> pa.Array:
        if f.name in self.attributes:
            at = self.quoted[f.name][tags]
            return _spread(self._strings(self.opens[at[at >= 0]] + 1, self.closes[at[at >= 0]]), at >= 0)
        if isinstance(f.dataType, T.ArrayType):
            found, place = self._children(tags, depth, f.name)
            return _lists(self._values(f.dataType.elementType, found, depth + 1), place, len(tags))
        last = self._last(tags, depth, f.name)
        return _spread(self._values(f.dataType, last[last >= 0], depth + 1), last >= 0)

    def elements(self, paths: Sequence[Sequence[str]]) -> pa.Array:
        n = len(self.odd)
        roots = self.levels[0] if self.levels else np.empty(0, int)
        roots = roots[~self.odd[self.message[self.tag[roots]]]]
        served, messages, arrays = np.zeros(n, bool), [], []
        for *above, name in paths:
            tags = roots
            for depth, group in enumerate(above):
                tags = self._last(tags, depth, group)
                tags = tags[tags >= 0]
            tags, _ = self._children(tags, len(above), name)
            message = self.message[self.tag[tags]]
            tags, message = tags[~served[message]], message[~served[message]]
            served[message] = True
            messages.append(message)
            arrays.append(self._values(self.kind, tags, len(above) + 1))
        message = np.concatenate(messages)
        order = np.argsort(message, kind="stable")
        full = [a for a in arrays if len(a)]
        values = full[0] if len(full) == 1 else pa.concat_arrays(arrays).take(pa.array(order))
        return _lists(values, message[order], n, self.odd)


def _spread(values: pa.Array, present: np.ndarray) -> pa.Array:
    """Values at the places that have one, null elsewhere."""
    if present.all():
        return values
    return values.take(pa.array(np.cumsum(present) - 1, mask=~present))


def _lists(values: pa.Array, place: np.ndarray, n: int, null: np.ndarray | None = None) -> pa.Array:
    """Values listed by ascending place; null are the places named, else those without a value."""
    sizes = np.bincount(place, minlength=n)
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    null = sizes == 0 if null is None else null
    return pa.ListArray.from_arrays(ends, values, mask=pa.array(null) if null.any() else None)

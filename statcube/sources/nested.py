"""Trees nested inside one message, unfolded into rows by one walk with a stack, however deep they are."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Rows handed on at once.
ROWS = 10_000


def unfold(
    df: DataFrame, column: str, keep: Sequence[str], rows_of: Callable[[str | None], Iterable[tuple]], schema: str
) -> DataFrame:
    """The rows that ``rows_of`` gives for each message, next to the kept columns of the message."""
    own = T.StructType.fromDDL(schema)
    kept = [df.schema[c] for c in keep]
    arrow = to_arrow_schema(own)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places: list[int] = []
            rows: list[tuple] = []
            for place, message in enumerate(batch.column(len(keep)).to_pylist()):
                for row in rows_of(message):
                    places.append(place)
                    rows.append(row)
                    if len(rows) >= ROWS:
                        yield handed(batch, places, rows)
                        places, rows = [], []
            yield handed(batch, places, rows)

    def handed(batch: pa.RecordBatch, places: list[int], rows: list[tuple]) -> pa.RecordBatch:
        picked = pa.array(places, pa.int64())
        columns = [pa.array(list(c), f.type) for c, f in zip(zip(*rows), arrow)] if rows else [pa.array([], f.type) for f in arrow]
        return pa.RecordBatch.from_arrays(
            [*[batch.column(i).take(picked) for i in range(len(keep))], *columns], names=[*keep, *arrow.names])

    return df.select(*keep, F.col(column).alias("_message")).mapInArrow(run, T.StructType([*kept, *own]))


def walk(tops: Iterable[Any], below: Callable[[Any, Any], tuple[Iterable[Any], Any]], start: Any) -> Iterator[tuple[Any, Any]]:
    """(node, state) of all nodes, each before its children; ``below`` gives a node's children and their state."""
    stack = [(iter(tops), start)]
    while stack:
        nodes, state = stack[-1]
        node = next(nodes, None)
        if node is None:
            stack.pop()
            continue
        yield node, state
        children, handed = below(node, state)
        stack.append((iter(children), handed))


# --- JSON -----------------------------------------------------------------------


def parsed(message: str | None) -> dict:
    """A JSON object; anything else counts as an empty one."""
    try:
        value = json.loads(message) if message else {}
    except ValueError:
        value = {}
    return value if isinstance(value, dict) else {}


def objects(value: Any) -> list[dict]:
    """The objects of a list; anything else counts as no list."""
    return [v for v in value if isinstance(v, dict)] if isinstance(value, list) else []


def part(value: Any, *names: str) -> Any:
    """What stands below a chain of names, or None."""
    for name in names:
        value = value.get(name) if isinstance(value, dict) else None
    return value


def text(value: Any) -> str | None:
    """A JSON value as text: strings as they are, others as written."""
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False, separators=(",", ":"))

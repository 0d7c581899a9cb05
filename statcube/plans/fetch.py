"""Read one cube: filters, window, ends of series, labels."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from statcube.model import TIME, VALUE, CubeQuery
from statcube.operators.filters import filter_dims, filter_period
from statcube.operators.labels import enrich_labels
from statcube.operators.series import first_and_last_n, first_n, last_n, sort_by_time
from statcube.operators.timeaxis import with_dates


def fetch(cube: DataFrame, query: CubeQuery, dims: Sequence[str], ordered: bool = True) -> DataFrame:
    """Observations of a query.

    Codes and the window are filtered first, so they reach the scan (the window of a
    cube stored with dates does so too).  ``ordered=False`` spares the global sort where
    the order does not matter.
    """
    rows = filter_period(filter_dims(cube, query.filters, dims), query.start, query.end)
    rows = with_dates(rows)
    if query.first_n and query.last_n:
        rows = first_and_last_n(rows, dims, query.first_n, query.last_n)
    elif query.first_n:
        rows = first_n(rows, dims, query.first_n)
    elif query.last_n:
        rows = last_n(rows, dims, query.last_n)
    return sort_by_time(rows) if ordered else rows


def run_spec(
    spec: Mapping, cubes: Mapping[str, DataFrame] | Callable[[str], DataFrame],
    dims: Mapping[str, str | None], codelists: DataFrame | None = None, lang: str | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Run a saved query.  ``dims`` maps the dimensions of its cube to codelist ids."""
    query = CubeQuery.from_spec(spec)
    cube = cubes(query.dataset) if callable(cubes) else cubes[query.dataset]
    present = [d for d in dims if d in cube.columns]
    rows = fetch(cube, query, present or [c for c in cube.columns if c not in (TIME, VALUE)], ordered=False)
    if query.labels:
        if codelists is None:
            raise ValueError("labels are wanted but no codelists are given")
        rows = enrich_labels(rows, dims, codelists, lang)
    return sort_by_time(rows) if ordered else rows

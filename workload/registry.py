"""Registry of queries: a Spark function and, where SQL can say it, the same in SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from statcube.session import scratch_path, spread
from workload.views import TABLES, VIEWS, with_flows

# Tables whose rows are costly to work on: texts to tokenise or to parse.
LONG_TEXTS = ("documents", "pages")

_PLACE = re.compile(r"\{(%s)\}" % "|".join([*TABLES, *VIEWS]))


class Data:
    """Views over the tables of one folder, built when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._built:
            if name in VIEWS:
                needed = set(_PLACE.findall(VIEWS[name]))
                self._built[name] = self.spark.sql(VIEWS[name], **{n: getattr(self, n) for n in needed})
            elif name in TABLES:
                table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
                self._built[name] = spread(table) if name in LONG_TEXTS else table
            else:
                raise AttributeError(name)
        return self._built[name]

    @cached_property
    def codelists(self) -> DataFrame:
        return self.codes.withColumnRenamed("ord", "order")

    def spread(self, name: str) -> DataFrame:
        """A table about to be turned into messages and parsed."""
        return spread(getattr(self, name))

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)


Query = Callable[[Data], DataFrame]
_QUERIES: dict[str, tuple[Query, str | None]] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its SQL form."""

    def add(function: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = (function, sql and with_flows(sql))
        return function

    return add


def _with_views(sql: str) -> str:
    """SQL with the views it uses in front, each after those it needs itself."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in _PLACE.findall(text):
            if name in VIEWS and name not in order:
                visit(VIEWS[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    plain = lambda text: _PLACE.sub(r"\1", text)
    views = ",\n".join(f"{name} AS ({plain(VIEWS[name])})" for name in order)
    body = plain(sql.strip())
    if not views:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {views},\n{body[len('WITH RECURSIVE '):]}"
    if body.upper().startswith("WITH "):
        return f"WITH {views},\n{body[len('WITH '):]}"
    return f"WITH {views}\n{body}"


def _load() -> None:
    for module in ("cubes", "catalogs", "finding", "messages", "archives"):
        import_module(f"workload.{module}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: (lambda spark, folder, f=f: f(Data(spark, folder))) for name, (f, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: _with_views(sql) for name, (_, sql) in _QUERIES.items() if sql is not None}

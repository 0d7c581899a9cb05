"""The operators run over the given tables, each next to an independent SQL form."""

from workload.registry import oracle_sql, queries  # noqa: F401

"""Query registry shared by the catalog modules.

``register(name, sql)`` records a ``(spark, sf_dir) -> DataFrame`` callable
and, for exactly-checkable operators, the DuckDB SQL that computes the same
table from the same parquet views.  ``sql`` may be a callable returning the
string (for parameters generated in Python, e.g. a projection matrix).
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str | Callable[[], str]] = {}


def register(name: str, sql: str | Callable[[], str] | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def oracle_sql() -> dict[str, str]:
    return {k: (v() if callable(v) else v) for k, v in ORACLE.items()}

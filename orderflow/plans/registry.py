"""Registry of the queries bound to the driver tables.

Each entry pairs a Spark callable ``(spark, sf_dir) -> DataFrame`` with an
independent DuckDB SQL oracle over the same parquet tables (or ``None`` when
the operator is not expressible in SQL).
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco

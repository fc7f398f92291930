"""All registered queries and the SQL that they are held against."""

from __future__ import annotations

import re
from collections.abc import Callable

from tileweave.sources.derived import SQL as DERIVED

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def with_derived(sql: str) -> str:
    """sql with a CTE for each derived table that it names."""
    sql = re.sub(r"\bby\b", '"by"', sql)  # a coordinate's name, and a keyword
    used = [f"{name} AS MATERIALIZED ({text})" for name, text in DERIVED.items() if re.search(rf"\b{name}\b", sql)]
    if not used:
        return sql
    head = re.match(r"\s*WITH (RECURSIVE )?", sql)
    if head:
        return f"WITH {head[1] or ''}{', '.join(used)}, {sql[head.end():]}"
    return f"WITH {', '.join(used)} {sql}"


def query(name: str, sql: str | None = None):
    """Register fn(spark, sf_dir) under name, with the DuckDB SQL of the same rows."""

    def put(fn: Callable) -> Callable:
        if name in QUERIES:
            raise ValueError(name)
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = with_derived(sql)
        return fn

    return put


def load() -> None:
    """Import every module that registers queries."""
    from tileweave.plans import features, landcover, mesh, network, overlay, raster, records, reports, rings, sources, tiles  # noqa: F401


load()

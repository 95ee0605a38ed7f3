"""Queries and their oracles, kept side by side."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .fixtures import FX

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def _for_oracle(view: str) -> str:
    """Spark replaces every match; the oracle engine does so only with the flag ``g``."""
    return view.replace("'[^A-Za-z]', '')", "'[^A-Za-z]', '', 'g')")


def with_views(sql: str) -> str:
    """Prepend the ``fx_*`` views that ``sql`` mentions as common table expressions."""
    views = [v for v in FX if re.search(rf"\b{v}\b", sql)]
    if not views:
        return sql.strip()
    head = ",\n".join(f"{v} AS ({_for_oracle(FX[v]).strip()})" for v in views)
    body = sql.strip()
    match = re.match(r"WITH\s+(RECURSIVE\s+)?", body, re.I)
    if match:
        return f"WITH {match.group(1) or ''}{head},\n{body[match.end():]}"
    return f"WITH {head}\n{body}"


def query(name: str, sql: str | None = None):
    def add(fn: Run) -> Run:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, fn, with_views(sql) if sql else None)
        return fn

    return add

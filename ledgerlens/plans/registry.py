"""Query registry: name -> Spark builder (spark, sf_dir) -> DataFrame, plus optional oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all():
    # importing the plan modules fills the registry
    from ledgerlens.plans import batch, features, evaluation, monitoring, ml, ranges, streams  # noqa: F401
    return QUERIES, ORACLE

"""Registry of the queries of this package: name -> (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

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


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_all():
    from ledgerlens.llm import (ctw, decontam, hard_negatives, importance, mixing, near_dedup, secret_scan,  # noqa: F401
                                repeats, token_count, token_store, topk, toxicity, url_filter)
    return QUERIES, ORACLE

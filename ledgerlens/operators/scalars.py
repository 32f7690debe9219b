"""One-row aggregates used inside row expressions.

Each column of a one-row aggregate becomes a scalar subquery: Spark merges the subqueries over the same
aggregate into one job, runs it once and hands the values to every task as literals.  No join is planned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def scalars(one_row: DataFrame, names: list[str] | None = None) -> dict[str, Column]:
    return {c: one_row.select(c).scalar() for c in (names or one_row.columns)}

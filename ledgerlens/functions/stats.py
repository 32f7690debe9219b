"""Distribution functions as column expressions (no scipy on the cluster path).

Student-t two-sided p-value uses the exact finite series for integer degrees of freedom (Abramowitz & Stegun
26.7.3 / 26.7.4), evaluated with a higher-order ``aggregate`` over ``sequence`` so it stays a JVM expression.
The t quantile refines the Cornish-Fisher expansion around the normal quantile by Newton steps on that series.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.hashing import sql_double as D


def z_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def t_two_sided_p(t: Column, df: Column) -> Column:
    """P(|T| >= |t|) for T ~ Student(df), df a positive integer column."""
    nu = df.cast("int")
    theta = F.atan(F.abs(t) / F.sqrt(nu.cast("double")))
    c2 = F.pow(F.cos(theta), 2)
    even = (nu % 2) == 0
    m = F.when(even, (nu / 2).cast("int") - 1).otherwise(((nu - 3) / 2).cast("int"))
    steps = F.when(m >= 1, F.sequence(F.lit(1), m)).otherwise(F.array().cast("array<int>"))

    def step(acc, j):
        jd = j.cast("double")
        f = F.when(even, (2 * jd - 1) / (2 * jd)).otherwise((2 * jd) / (2 * jd + 1))
        a = acc["a"] * c2 * f
        return F.struct(a.alias("a"), (acc["s"] + a).alias("s"))

    series = F.aggregate(steps, F.struct(F.lit(1.0).alias("a"), F.lit(1.0).alias("s")), step)["s"]
    a_even = F.sin(theta) * series
    a_odd = F.when(nu == 1, 2 * theta / F.lit(math.pi)).otherwise(
        (2 / F.lit(math.pi)) * (theta + F.sin(theta) * F.cos(theta) * series))
    return F.lit(1.0) - F.when(even, a_even).otherwise(a_odd)


def t_two_sided_p_sql(t: str, df: str) -> str:
    """DuckDB spelling: the same series with terms in closed form via lgamma."""
    nu = f"CAST({df} AS BIGINT)"
    theta = f"atan(abs({t}) / sqrt(CAST({nu} AS DOUBLE)))"
    c2 = f"pow(cos({theta}), 2)"
    even_terms = (f"coalesce(list_sum(list_transform(range(1, {nu} // 2), lambda j: exp(lgamma(2 * j + 1) "
                  f"- 2 * lgamma(j + 1) - j * ln(4) + j * ln({c2})))), 0)")
    odd_terms = (f"coalesce(list_sum(list_transform(range(1, ({nu} - 3) // 2 + 1), lambda j: exp(j * ln(4) "
                 f"+ 2 * lgamma(j + 1) - lgamma(2 * j + 2) + j * ln({c2})))), 0)")
    a_even = f"(sin({theta}) * (1 + {even_terms}))"
    a_odd = (f"(CASE WHEN {nu} = 1 THEN 2 * {theta} / pi() ELSE (2 / pi()) * ({theta} + sin({theta}) * cos({theta}) "
             f"* (1 + {odd_terms})) END)")
    return f"(1 - CASE WHEN {nu} % 2 = 0 THEN {a_even} ELSE {a_odd} END)"


NEWTON_STEPS = 12


def _cornish_fisher(p: float) -> tuple[float, ...]:
    z = z_quantile(p)
    return (z, (z ** 3 + z) / 4, (5 * z ** 5 + 16 * z ** 3 + 3 * z) / 96,
            (3 * z ** 7 + 19 * z ** 5 + 17 * z ** 3 - 15 * z) / 384,
            (79 * z ** 9 + 776 * z ** 7 + 1482 * z ** 5 - 1920 * z ** 3 - 945 * z) / 92160)


def _t_density_scale(nu: Column) -> Column:
    """Gamma((nu + 1) / 2) / (sqrt(nu pi) Gamma(nu / 2)) for whole nu, by its recursion in steps of two."""
    first = F.when(nu % 2 == 0, F.lit(2)).otherwise(F.lit(1))
    start = F.when(nu % 2 == 0, F.lit(1 / (2 * math.sqrt(2)))).otherwise(F.lit(1 / math.pi))
    steps = F.when(nu > 2, F.sequence(first, nu - 2, F.lit(2))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, start, lambda acc, v: acc * (v + 1) / v * F.sqrt(v.cast("double") / (v + 2)))


def t_quantile(p: float, df: Column) -> Column:
    """Upper quantile (p > 0.5) of Student(df), df a positive integer column: error below 1e-9.

    The distribution function is concave above its median, so Newton steps from below the quantile approach it from
    there and a step from above lands below it: they converge from any start."""
    z, *g = _cornish_fisher(p)
    nu = df.cast("int")
    v = nu.cast("double")
    start = F.lit(z) + sum((F.lit(x) / F.pow(v, k) for k, x in enumerate(g, 1)), F.lit(0.0))

    def step(acc, _):
        slope = acc["c"] * F.pow(1 + acc["t"] * acc["t"] / v, -(v + 1) / 2)
        missing = F.lit(p) - (1 - t_two_sided_p(acc["t"], nu) / 2)
        return F.struct((acc["t"] + missing / slope).alias("t"), acc["c"].alias("c"))

    first = F.struct(start.alias("t"), _t_density_scale(nu).alias("c"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(NEWTON_STEPS)), first, step)["t"]


def t_quantile_sql(p: float, df: str) -> str:
    """DuckDB spelling: the density's scale from lgamma, the same Newton steps as a list reduction."""
    z, *g = _cornish_fisher(p)
    v = f"CAST({df} AS DOUBLE)"
    start = f"({D(z)} + " + " + ".join(f"{D(x)} / pow({v}, {k})" for k, x in enumerate(g, 1)) + ")"
    slope = (f"(exp(lgamma(({v} + 1) / 2) - lgamma({v} / 2)) / sqrt({v} * pi()) * pow(1 + q * q / {v}, -({v} + 1) / 2))")
    step = f"q + ({D(p)} - (1 - {t_two_sided_p_sql('q', df)} / 2)) / {slope}"
    return (f"list_reduce(list_prepend({start}, list_transform(range({NEWTON_STEPS}), lambda i: 0.0::DOUBLE)), "
            f"lambda q, i: {step})")

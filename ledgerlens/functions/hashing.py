"""Repeatable random draws.

``rand``, ``randomSplit`` and Python's salted ``hash`` give different answers across runs, engines and after an
executor is lost and a task re-runs.  A draw here is a pure function of a row key and a salt:

    u = int(first 8 hex digits of md5(key || ':' || salt), 16) / 2**32        (uniform in [0, 1))

The same formula is written in SQL for the DuckDB oracle (``sql_uniform``), so samples, splits, bootstrap weights
and synthetic labels match row for row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _key(key, salt: str) -> Column:
    k = key if isinstance(key, Column) else F.col(key)
    return F.concat_ws(":", k.cast("string"), F.lit(str(salt)))


def uniform(key, salt: str | int = 42) -> Column:
    """Uniform [0,1) double from md5 of the key and a salt."""
    h = F.conv(F.substring(F.md5(_key(key, str(salt))), 1, 8), 16, 10).cast("bigint")
    return h.cast("double") / F.lit(TWO_32)


def sql_uniform(key_sql: str, salt: str | int = 42) -> str:
    """The DuckDB spelling of :func:`uniform`."""
    return (f"(CAST(('0x' || substr(md5(concat_ws(':', CAST({key_sql} AS VARCHAR), '{salt}')), 1, 8)) AS BIGINT)"
            f" / {TWO_32})")


def poisson1_cdf(kmax: int = 20) -> list[float]:
    """Cumulative probabilities of Poisson(1) for k = 0..kmax (inverse-CDF thresholds)."""
    out, p, acc = [], math.exp(-1.0), 0.0
    for k in range(kmax + 1):
        if k > 0:
            p = p / k
        acc += p
        out.append(acc)
    return out


def poisson1(u: Column, kmax: int = 20) -> Column:
    """Poisson(1) draw by inverse CDF from a uniform column (P(k > 20) < 1e-19, below double resolution)."""
    cdf = poisson1_cdf(kmax)
    expr = F.lit(kmax)
    for k in range(kmax - 1, -1, -1):
        expr = F.when(u < F.lit(cdf[k]), F.lit(k)).otherwise(expr)
    return expr


def sql_double(x: float) -> str:
    """A DOUBLE literal that parses to exactly the same binary value as the Python float."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def sql_poisson1(u_sql: str, kmax: int = 20) -> str:
    cdf = poisson1_cdf(kmax)
    whens = " ".join(f"WHEN {u_sql} < {sql_double(cdf[k])} THEN {k}" for k in range(kmax))
    return f"(CASE {whens} ELSE {kmax} END)"


def md5_unit(text: str, salt: str | int = 42) -> float:
    """Python twin of :func:`uniform` for driver-side choices over small parameter lists and for pandas code."""
    import hashlib
    h = hashlib.md5(f"{text}:{salt}".encode()).hexdigest()
    return int(h[:8], 16) / TWO_32


# ---- Poisson draws of any mean -------------------------------------------------------------------------------------
#
# Means below SMALL_MEAN add up that many Poisson(1) draws.  From there on a draw is taken by transformed rejection: a
# candidate k = floor((2a / us + b) * u + n + 0.43) from two uniforms is accepted by the exact log probability of k, or
# turned down and the next pair tried.  A try is accepted nine times in ten or more, whatever n is, so neither the cost
# nor the distribution depends on its size.

SMALL_MEAN = 10                      # the constants of the rejection hold from this mean on
TRIES = 48                           # all fail with a chance below 1e-30
TWO_52 = 4503599627370496.0
#: fixed values: the constants of the transformed rejection, and of the Stirling series of ln k!
_B, _A, _INV, _VR = (0.931, 2.53), (-0.059, 0.02483), (1.1239, 1.1328, 3.4), (0.9277, 3.6224, 2.0)


def _unit52(name: Column, salt: str) -> Column:
    """Uniform in (0, 1) with 52 bits."""
    h = F.conv(F.substring(F.md5(F.concat_ws(":", name, F.lit(salt))), 1, 13), 16, 10).cast("bigint")
    return (h.cast("double") + 0.5) / F.lit(TWO_52)


def _sql_unit52(name: str, salt: str) -> str:
    return f"((CAST(('0x' || substr(md5(concat_ws(':', {name}, '{salt}')), 1, 13)) AS BIGINT)::DOUBLE + 0.5::DOUBLE) / {sql_double(TWO_52)})"


def poisson(n: Column, name: Column, seed: int) -> Column:
    """A Poisson(n) draw (bigint) of a whole number n >= 0; a function of ``name`` and ``seed`` alone."""
    each = F.aggregate(F.sequence(F.lit(1), F.greatest(F.least(n, F.lit(SMALL_MEAN)), F.lit(1)).cast("int")), F.lit(0), lambda acc, i: (
        acc + poisson1(uniform(F.concat_ws(":", name, i.cast("string")), seed))))
    m = n.cast("double")
    b = F.lit(_B[0]) + F.lit(_B[1]) * F.sqrt(m)
    a = F.lit(_A[0]) + F.lit(_A[1]) * b
    inv = F.lit(_INV[0]) + F.lit(_INV[1]) / (b - F.lit(_INV[2]))
    sure = F.lit(_VR[0]) - F.lit(_VR[1]) / (b - F.lit(_VR[2]))

    def attempt(i):
        key = F.concat_ws(":", name, i.cast("string"))
        pair = F.array(F.struct((_unit52(key, f"{seed}u") - 0.5).alias("u"), _unit52(key, f"{seed}v").alias("v")))
        pair = F.transform(pair, lambda s: F.struct(s["u"], s["v"], (F.lit(0.5) - F.abs(s["u"])).alias("us")))
        pair = F.transform(pair, lambda s: F.struct(s["u"], s["v"], s["us"], F.floor(
            (2 * a / s["us"] + b) * s["u"] + m + F.lit(0.43)).cast("double").alias("k")))

        def judged(s):
            k, us, v = s["k"], s["us"], s["v"]
            stirling = 1 / (12 * k) - 1 / (360 * k * k * k) + 1 / (1260 * k * k * k * k * k)
            low = F.aggregate(F.sequence(F.lit(1), F.greatest(k, F.lit(1.0)).cast("int")), F.lit(0.0), lambda t, j: t + F.log(j.cast("double")))
            exact = F.when(k < 10, k * F.log(m) - m - low).otherwise(
                -(k * F.log(k / m) - (k - m)) - stirling - 0.5 * F.log(F.lit(2 * math.pi) * k))
            fits = F.log(v * inv / (a / (us * us) + b)) <= exact
            return F.when((us >= 0.07) & (v <= sure), k).when((k < 0) | ((us < 0.013) & (v > us)), F.lit(None)).when(fits, k)
        return F.transform(pair, judged)[0]

    large = F.aggregate(F.sequence(F.lit(1), F.lit(TRIES)), F.lit(None).cast("double"),
                        lambda acc, i: F.when(acc.isNotNull(), acc).otherwise(attempt(i)))
    return F.when(n <= 0, F.lit(0)).when(n < SMALL_MEAN, each).otherwise(large).cast("bigint")


def sql_poisson(n: str, name: str, seed: int) -> str:
    """The DuckDB spelling of :func:`poisson`."""
    each = (f"list_sum(list_transform(range(1, least({n}, {SMALL_MEAN}) + 1), lambda i: "
            f"{sql_poisson1(sql_uniform(f'concat_ws(chr(58), {name}, CAST(i AS VARCHAR))', seed))}))")
    d = sql_double
    m = f"CAST({n} AS DOUBLE)"
    b = f"({d(_B[0])} + {d(_B[1])} * sqrt({m}))"
    a = f"({d(_A[0])} + {d(_A[1])} * {b})"
    inv = f"({d(_INV[0])} + {d(_INV[1])} / ({b} - {d(_INV[2])}))"
    sure = f"({d(_VR[0])} - {d(_VR[1])} / ({b} - {d(_VR[2])}))"
    key = f"concat_ws(':', {name}, CAST(i AS VARCHAR))"
    pairs = f"list_transform(range(1, {TRIES} + 1), lambda i: {{'u': {_sql_unit52(key, f'{seed}u')} - 0.5::DOUBLE, 'v': {_sql_unit52(key, f'{seed}v')}}})"
    pairs = f"list_transform({pairs}, lambda s: {{'u': s.u, 'v': s.v, 's': 0.5::DOUBLE - abs(s.u)}})"
    pairs = f"list_transform({pairs}, lambda s: {{'v': s.v, 's': s.s, 'k': floor((2 * {a} / s.s + {b}) * s.u + {m} + {d(0.43)})}})"
    stirling = "(1 / (12 * s.k) - 1 / (360 * s.k * s.k * s.k) + 1 / (1260 * s.k * s.k * s.k * s.k * s.k))"
    low = "coalesce(list_sum(list_transform(range(1, CAST(greatest(least(s.k, 10), 1) AS BIGINT) + 1), lambda j: ln(j::DOUBLE))), 0.0::DOUBLE)"
    exact = (f"CASE WHEN s.k < 10 THEN s.k * ln({m}) - {m} - {low} ELSE -(s.k * ln(greatest(s.k, 1) / {m}) - (s.k - {m})) - {stirling} "
             f"- 0.5::DOUBLE * ln({d(2 * math.pi)} * greatest(s.k, 1)) END")
    fits = f"ln(s.v * {inv} / ({a} / (s.s * s.s) + {b})) <= {exact}"
    judged = (f"CASE WHEN s.s >= 0.07 AND s.v <= {sure} THEN s.k WHEN s.k < 0 OR (s.s < 0.013 AND s.v > s.s) THEN NULL "
              f"WHEN {fits} THEN s.k END")
    large = f"list_filter(list_transform({pairs}, lambda s: {judged}), lambda x: x IS NOT NULL)[1]"
    return f"CAST(CASE WHEN {n} <= 0 THEN 0 WHEN {n} < {SMALL_MEAN} THEN {each} ELSE {large} END AS BIGINT)"

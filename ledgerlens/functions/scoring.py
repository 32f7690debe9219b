"""Rule scorers and their reply fields as native column expressions.

Every scorer also has a ``*_sql`` spelling used by the DuckDB oracle.  Thresholds are parameters whose defaults
are the reference values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.hashing import sql_double as D
from ledgerlens.functions.hashing import sql_uniform, uniform


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def _pmod_sql(x: str, m: int) -> str:
    return f"((({x}) % {m} + {m}) % {m})"


# ---- request scorer (mock model of the scoring service) ------------------------------------------------------

def hour_of_seconds(seconds) -> Column:
    """(seconds // 3600) % 24 with floor semantics."""
    return F.pmod(F.floor(_c(seconds) / F.lit(3600)), F.lit(24))


# fixed values: points of the request scorer for a large and a medium amount, a night hour, a risky customer
REQUEST_POINTS = (0.3, 0.1, 0.2, 0.4)
# fixed values: points of the balance scorer for a large amount, a night hour, a balance under twice the amount, an
# amount above the balance
BALANCE_POINTS = (0.3, 0.2, 0.4, 0.5)


def request_risk_score(amount, seconds, customer_id, large: float = 1000.0, medium: float = 500.0,
                       night_before: int = 6, night_after: int = 22, risky_mod: int = 100, risky_below: int = 5,
                       cap: float = 0.95, jitter_salt: str = "jitter") -> Column:
    """0.3 if amount > large else 0.1 if > medium; +0.2 at night; +0.4 for risky customer ids; + jitter 0..0.09;
    capped.  The jitter is a stable hash of the customer id (Python's string hash is salted per process)."""
    for_large, for_medium, for_night, for_customer = map(F.lit, REQUEST_POINTS)
    a = F.when(_c(amount) > large, for_large).when(_c(amount) > medium, for_medium).otherwise(F.lit(0.0))
    h = hour_of_seconds(seconds)
    b = F.when((h < night_before) | (h > night_after), for_night).otherwise(F.lit(0.0))
    c = F.when(F.pmod(_c(customer_id), F.lit(risky_mod)) < risky_below, for_customer).otherwise(F.lit(0.0))
    jitter = F.floor(uniform(_c(customer_id), jitter_salt) * 10).cast("double") / F.lit(100.0)
    return F.least(F.lit(0.0) + a + b + c + jitter, F.lit(cap))


def request_risk_score_sql(amount: str, seconds: str, customer_id: str, large: float = 1000.0,
                           medium: float = 500.0, night_before: int = 6, night_after: int = 22,
                           risky_mod: int = 100, risky_below: int = 5, cap: float = 0.95,
                           jitter_salt: str = "jitter") -> str:
    h = _pmod_sql(f"floor(({seconds}) / 3600)", 24)
    a = f"(CASE WHEN {amount} > {D(large)} THEN {D(0.3)} WHEN {amount} > {D(medium)} THEN {D(0.1)} ELSE {D(0.0)} END)"
    b = f"(CASE WHEN {h} < {night_before} OR {h} > {night_after} THEN {D(0.2)} ELSE {D(0.0)} END)"
    c = f"(CASE WHEN {_pmod_sql(customer_id, risky_mod)} < {risky_below} THEN {D(0.4)} ELSE {D(0.0)} END)"
    j = f"(CAST(floor({sql_uniform(customer_id, jitter_salt)} * 10) AS DOUBLE) / {D(100.0)})"
    return f"least({D(0.0)} + {a} + {b} + {c} + {j}, {D(cap)})"


# ---- balance scorer (fallback service) -----------------------------------------------------------------------

def balance_risk_score(amount, hour, balance, large: float = 1000.0, cap: float = 0.95, night_before: int = 6,
                       night_after: int = 22, cover: float = 2.0, points=BALANCE_POINTS) -> Column:
    """Points for a large amount, a night hour, a balance under ``cover`` times the amount and an amount above the
    balance; capped."""
    for_large, for_night, for_cover, for_balance = map(F.lit, points)
    zero = F.lit(0.0)
    a = F.when(_c(amount) > large, for_large).otherwise(zero)
    b = F.when((_c(hour) < night_before) | (_c(hour) > night_after), for_night).otherwise(zero)
    c = F.when(_c(balance) < _c(amount) * cover, for_cover).otherwise(zero)
    d = F.when(_c(amount) > _c(balance), for_balance).otherwise(zero)
    return F.least(zero + a + b + c + d, F.lit(cap))


def balance_risk_score_sql(amount: str, hour: str, balance: str, large: float = 1000.0, cap: float = 0.95) -> str:
    a = f"(CASE WHEN {amount} > {D(large)} THEN {D(0.3)} ELSE {D(0.0)} END)"
    b = f"(CASE WHEN {hour} < 6 OR {hour} > 22 THEN {D(0.2)} ELSE {D(0.0)} END)"
    c = f"(CASE WHEN {balance} < {amount} * 2 THEN {D(0.4)} ELSE {D(0.0)} END)"
    d = f"(CASE WHEN {amount} > {balance} THEN {D(0.5)} ELSE {D(0.0)} END)"
    return f"least({D(0.0)} + {a} + {b} + {c} + {d}, {D(cap)})"


# ---- threshold scorer (test-mode service) --------------------------------------------------------------------

def threshold_is_fraud(amount, scenario, large: float = 1000.0) -> Column:
    return (_c(amount) > large) | (_c(scenario) == 1)


def threshold_is_fraud_sql(amount: str, scenario: str, large: float = 1000.0) -> str:
    return f"({amount} > {D(large)} OR {scenario} = 1)"


def threshold_probability(is_fraud: Column) -> Column:
    return F.when(is_fraud, F.lit(0.8)).otherwise(F.lit(0.2))


# ---- stream heuristic (scoring job test mode) ----------------------------------------------------------------

def stream_heuristic(amount, key, large: float = 5000.0, random_rate: float = 0.1, salt: str = "stream") -> Column:
    """struct(prediction, probability): fraud if amount > large or a stable 10 % draw; 0.9 / 0.8 / 0.1."""
    amt = F.coalesce(_c(amount), F.lit(0.0))
    is_large = amt > large
    is_random = uniform(_c(key), salt) < random_rate
    prediction = F.when(is_large | is_random, F.lit(1.0)).otherwise(F.lit(0.0))
    probability = F.when(is_large, F.lit(0.9)).when(is_random, F.lit(0.8)).otherwise(F.lit(0.1))
    return F.struct(prediction.alias("prediction"), probability.alias("probability"))


def stream_heuristic_sql(amount: str, key: str, large: float = 5000.0, random_rate: float = 0.1,
                         salt: str = "stream") -> tuple[str, str]:
    amt = f"coalesce({amount}, {D(0.0)})"
    u = sql_uniform(key, salt)
    pred = f"(CASE WHEN {amt} > {D(large)} OR {u} < {D(random_rate)} THEN {D(1.0)} ELSE {D(0.0)} END)"
    prob = (f"(CASE WHEN {amt} > {D(large)} THEN {D(0.9)} WHEN {u} < {D(random_rate)} THEN {D(0.8)} "
            f"ELSE {D(0.1)} END)")
    return pred, prob


# ---- reply fields --------------------------------------------------------------------------------------------

def risk_band(p, high: float = 0.7, medium: float = 0.3) -> Column:
    return F.when(_c(p) >= high, "high").when(_c(p) >= medium, "medium").otherwise("low")


def risk_band_sql(p: str, high: float = 0.7, medium: float = 0.3) -> str:
    return f"(CASE WHEN {p} >= {D(high)} THEN 'high' WHEN {p} >= {D(medium)} THEN 'medium' ELSE 'low' END)"


def confidence(p) -> Column:
    return F.least(F.lit(0.95), F.lit(0.7) + F.abs(_c(p) - F.lit(0.5)))


def confidence_sql(p: str) -> str:
    return f"least({D(0.95)}, {D(0.7)} + abs({p} - {D(0.5)}))"


def clamp01(p) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), _c(p)))


def confidence_binary(p) -> Column:
    """struct(probability clamped to [0,1], is_fraud = p >= 0.5, confidence = |p - 0.5| * 2)."""
    q = clamp01(p)
    return F.struct(q.alias("probability"), (q >= 0.5).alias("is_fraud"),
                    (F.abs(q - F.lit(0.5)) * F.lit(2.0)).alias("confidence"))


def fraud_label(prediction, threshold: float = 0.5, exact_one: bool = False) -> Column:
    """FRAUD / NORMAL: ``prediction >= threshold`` (local job) or ``prediction == 1.0`` (cluster job)."""
    cond = (_c(prediction) == 1.0) if exact_one else (_c(prediction) >= threshold)
    return F.when(cond, "FRAUD").otherwise("NORMAL")


def is_large_tx(amount, threshold: float = 1000.0) -> Column:
    """On-demand feature: 1 if amount > threshold else 0 (null amount -> null)."""
    return (_c(amount) > threshold).cast("int")


# ---- request validation --------------------------------------------------------------------------------------

# Field rules of a scoring request (fixed values): name -> (comparison, bound)
REQUEST_RULES = [
    ("customer_id", ">", 0),
    ("terminal_id", ">", 0),
    ("tx_amount", ">", 0),
    ("tx_time_seconds", ">=", 0),
    ("tx_time_days", ">=", 0),
    ("tx_fraud_scenario", ">=", 0),
]


def request_violations(rules=REQUEST_RULES, id_col: str = "transaction_id") -> Column:
    """Array of broken rule names, e.g. ['tx_amount:missing', 'customer_id:gt_0']; empty when the request is valid."""
    items = [F.when(F.col(id_col).isNull(), F.lit(f"{id_col}:missing"))]
    for name, op, bound in rules:
        c = F.col(name)
        ok = (c > bound) if op == ">" else (c >= bound)
        tag = "gt" if op == ">" else "ge"
        items.append(F.when(c.isNull(), F.lit(f"{name}:missing")).when(~ok, F.lit(f"{name}:{tag}_{bound}")))
    return F.array_compact(F.array(*items))


def request_violations_sql(rules=REQUEST_RULES, id_col: str = "transaction_id") -> str:
    """Comma-joined violation names in DuckDB (same order as :func:`request_violations`)."""
    parts = [f"CASE WHEN {id_col} IS NULL THEN '{id_col}:missing' END"]
    for name, op, bound in rules:
        tag = "gt" if op == ">" else "ge"
        parts.append(f"CASE WHEN {name} IS NULL THEN '{name}:missing' WHEN NOT ({name} {op} {bound}) "
                     f"THEN '{name}:{tag}_{bound}' END")
    return f"concat_ws(',', {', '.join(parts)})"

"""Shared pieces of the registered queries.

The stand-in amounts (events.value) span 0.01 to about 560, a tenth of the reference's card amounts, so the
amount thresholds of the rule scorers are passed at a tenth of their reference defaults (1000 -> 100,
500 -> 50, 5000 -> 500).  The operators keep the reference values as defaults.
"""

from ledgerlens.functions.hashing import sql_double as D  # noqa: F401
from ledgerlens.sources.testdata import (ANSWERS_SQL, EVAL_SQL, EVENTS_FEATURES_SQL, LECTURES_SQL, OFFSETS_SQL,
                                         RAW_TX_SQL, TX_SQL, URLS_SQL)

LARGE = 100.0     # reference 1000
MEDIUM = 50.0     # reference 500
HUGE = 500.0      # reference 5000

NUMERIC_RAW = ["transaction_id", "customer_id", "terminal_id", "tx_amount", "tx_time_seconds", "tx_time_days",
               "tx_fraud", "tx_fraud_scenario"]
ALL_RAW = ["transaction_id", "tx_datetime", "customer_id", "terminal_id", "tx_amount", "tx_time_seconds",
           "tx_time_days", "tx_fraud", "tx_fraud_scenario"]



def nonnull_sql(src: str, cols=ALL_RAW) -> str:
    return f"SELECT * FROM ({src}) WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in cols)


def stats_sql(src: str, cols=NUMERIC_RAW) -> str:
    return ("SELECT " + ", ".join([f"avg({c}) AS {c}_mean" for c in cols] +
                                  [f"stddev_samp({c}) AS {c}_std" for c in cols]) + f" FROM ({src})")


def sigma_cond_sql(t: str = "t", s: str = "s", cols=NUMERIC_RAW, k: float = 3.0) -> str:
    return " AND ".join(
        f"({s}.{c}_std IS NULL OR {s}.{c}_std = 0 OR ({t}.{c} >= {s}.{c}_mean - {D(k)} * {s}.{c}_std AND "
        f"{t}.{c} <= {s}.{c}_mean + {D(k)} * {s}.{c}_std))" for c in cols)


RANGE_COND_SQL = ("tx_amount >= 0 AND tx_time_seconds >= 0 AND tx_time_seconds <= 86400 AND customer_id IS NOT NULL "
                  "AND terminal_id IS NOT NULL")


def clean_sql(src: str = RAW_TX_SQL) -> str:
    nn = nonnull_sql(src)
    cols = ", ".join(f"t.{c}" for c in ALL_RAW)
    return (f"SELECT * FROM (SELECT {cols} FROM ({nn}) t, ({stats_sql(nn)}) s WHERE {sigma_cond_sql()}) "
            f"WHERE {RANGE_COND_SQL}")


__all__ = ["ANSWERS_SQL", "EVAL_SQL", "EVENTS_FEATURES_SQL", "LECTURES_SQL", "OFFSETS_SQL", "RAW_TX_SQL", "TX_SQL",
           "URLS_SQL", "D", "LARGE", "MEDIUM", "HUGE", "nonnull_sql", "stats_sql", "sigma_cond_sql",
           "RANGE_COND_SQL", "clean_sql", "NUMERIC_RAW", "ALL_RAW"]

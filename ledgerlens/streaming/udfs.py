"""Vectorised Python scorers (Arrow batches): the pandas-UDF path and the injected external scorer."""

import hashlib
import time

import numpy as np
import pandas as pd

TWO_32 = 4294967296.0


def _unit(keys: pd.Series, salt: str) -> np.ndarray:
    """md5-based uniform draw per key text; computed once per distinct key in the batch."""
    codes, uniq = pd.factorize(keys.astype(str))
    return np.array([int(hashlib.md5(f"{k}:{salt}".encode()).hexdigest()[:8], 16) / TWO_32 for k in uniq], dtype=float)[codes]


def heuristic_udf(large: float = 5000.0, random_rate: float = 0.1, salt: str = "stream"):
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("struct<prediction: double, probability: double>")
    def _score(amount: pd.Series, key: pd.Series) -> pd.DataFrame:
        amt = amount.fillna(0.0).to_numpy(dtype=float)
        is_large = amt > large
        is_random = _unit(key, salt) < random_rate
        pred = np.where(is_large | is_random, 1.0, 0.0)
        prob = np.where(is_large, 0.9, np.where(is_random, 0.8, 0.1))
        return pd.DataFrame({"prediction": pred, "probability": prob})

    return _score


def request_scorer(large: float = 1000.0, medium: float = 500.0, cap: float = 0.95, jitter_salt: str = "jitter"):
    """External scorer stand-in for valid requests (violations are found before, as native expressions): one
    fraud_probability per row, same rules and arithmetic order as the native expression."""

    def score(pdf: pd.DataFrame) -> pd.Series:
        amt = pdf["tx_amount"].to_numpy(dtype=float)
        secs = pdf["tx_time_seconds"].to_numpy(dtype=float)
        cust = pdf["customer_id"]
        a = np.where(amt > large, 0.3, np.where(amt > medium, 0.1, 0.0))
        hour = np.mod(np.floor(secs / 3600), 24)
        b = np.where((hour < 6) | (hour > 22), 0.2, 0.0)
        c = np.where(np.mod(cust.to_numpy(dtype=float), 100) < 5, 0.4, 0.0)
        who, ids = pd.factorize(cust.astype("Int64"), use_na_sentinel=False)
        j = np.floor(_unit(pd.Series(ids), jitter_salt)[who] * 10) / 100.0
        return pd.Series(np.minimum(0.0 + a + b + c + j, cap), index=pdf.index)

    return score


def external_scoring(scorer, id_col: str = "transaction_id", violations: str = "violations"):
    """mapInPandas function: rows with an empty ``violations`` text go to ``scorer``, batch by batch; the others become
    error rows.  If the scorer fails on a batch, its rows are tried one by one, so that only the rows that fail are
    errors.  Gives id, success, fraud_probability, error and the per-row latency of the calls."""

    def run(batches):
        for pdf in batches:
            ok = (pdf[violations] == "").to_numpy()
            prob, error = np.full(len(pdf), np.nan), np.full(len(pdf), None, dtype=object)
            error[~ok] = "invalid request: " + pdf[violations].to_numpy(dtype=object)[~ok]
            t0 = time.perf_counter()
            at = np.flatnonzero(ok)
            if len(at):
                valid = pdf.iloc[at].drop(columns=[violations])
                try:
                    prob[at] = np.asarray(scorer(valid), dtype=float)
                except Exception:
                    for k, i in enumerate(at):
                        try:
                            prob[i] = float(np.asarray(scorer(valid.iloc[k:k + 1]), dtype=float)[0])
                        except Exception as e:
                            error[i] = f"scorer error: {e}"
            dt = (time.perf_counter() - t0) * 1000.0 / max(len(pdf), 1)
            failed = pd.notna(error)
            yield pd.DataFrame({
                id_col: pdf[id_col],
                "success": ~failed,
                "fraud_probability": np.where(failed, np.nan, prob),    # not a number goes to Arrow as null
                "error": error,
                "latency_ms": np.full(len(pdf), dt),
            })

    return run

"""Local twin of the correctness gate: run each registered query in Spark and its oracle SQL in DuckDB on the
same parquet tables, then compare columns, row counts and values (order-insensitive).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
import traceback

import duckdb
import pandas as pd

sys.path.insert(0, ".")

from ledgerlens.sources.testdata import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) is not None:
        return v.replace(tzinfo=None)
    if isinstance(v, (bool,)):
        return v
    if isinstance(v, int):
        return v
    return v


def rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "smallint": "SMALLINT", "date": "DATE"}


def type_mismatches(spark_dtypes: list[tuple[str, str]], con, sql: str) -> list[str]:
    """Columns whose Spark type does not correspond to the DuckDB result type."""
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [f"{c}: spark {t} vs duck {duck_types.get(c)}" for c, t in spark_dtypes
            if SPARK_TO_DUCK.get(t, t) != duck_types.get(c)]


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> tuple[bool, str]:
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return False, f"columns differ: {sorted(spark_pdf.columns)} vs {sorted(duck_pdf.columns)}"
    if len(spark_pdf) != len(duck_pdf):
        return False, f"row count {len(spark_pdf)} vs {len(duck_pdf)}"
    a, b = rows(spark_pdf), rows(duck_pdf)
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return False, f"first diff at sorted row {i}: {x} vs {y}"
    return True, "ok"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    from ledgerlens.session import get_spark
    from ledgerlens.plans.registry import load_all
    spark = get_spark("local[8]", shuffle_partitions=8)
    queries, oracle = load_all()
    con = duck(sf_dir)
    bad = 0
    for name, fn in queries.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            spdf = sdf.toPandas()
        except Exception as e:
            bad += 1
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            traceback.print_exc(limit=2)
            continue
        ts = time.time() - t0
        if name not in oracle:
            print(f"ROWS {name}: {len(spdf)} rows ({ts:.1f}s) [no oracle]")
            continue
        try:
            dpdf = con.execute(oracle[name]).df()
        except Exception as e:
            bad += 1
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            continue
        ok, msg = compare(spdf, dpdf)
        if ok:
            tm = type_mismatches(sdf.dtypes, con, oracle[name])
            ok, msg = (False, "types: " + "; ".join(tm)) if tm else (True, "ok")
        if not ok:
            bad += 1
            print(f"FAIL {name}: {msg}")
            print("   spark types:", dict(sdf.dtypes))
            print("   duck  types:", dict(zip(dpdf.columns, [str(t) for t in dpdf.dtypes])))
        else:
            print(f"OK   {name}: {len(spdf)} rows ({ts:.1f}s)")
    print(f"done; {bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)

"""Run registered queries in Spark and their oracle SQL in DuckDB, compare results.

Usage: python tests/oracle_harness.py [sf_dir] [key ...]
Compares row count, column names, and an order-insensitive hash of the values.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return str(int(v)) if v.is_integer() else repr(round(v, 6))  # a nullable integer column is read as floats
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    try:
        if pd.isna(v):
            return "∅"
    except (TypeError, ValueError):
        pass
    return str(v)


def digest(pdf: pd.DataFrame) -> str:
    cols = sorted(pdf.columns)
    rows = sorted("\x1f".join(_norm(r[c]) for c in cols) for r in pdf.to_dict("records"))
    h = hashlib.sha256()
    for r in rows:
        h.update(r.encode())
        h.update(b"\n")
    return h.hexdigest()[:16]


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> dict:
    return {
        "rows": (len(spark_pdf), len(duck_pdf)),
        "rows_ok": len(spark_pdf) == len(duck_pdf),
        "cols_ok": sorted(spark_pdf.columns) == sorted(duck_pdf.columns),
        "cols": (sorted(spark_pdf.columns), sorted(duck_pdf.columns)),
        "hash_ok": digest(spark_pdf) == digest(duck_pdf),
    }


def run(sf_dir: str, keys: list[str] | None = None) -> dict:
    import __spark_entry__ as entry
    from tasteflow.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8, conf={"spark.driver.memory": "8g"})
    con = duck_connect(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    out = {}
    for name in keys or list(qs):
        t0 = time.time()
        sp = qs[name](spark, sf_dir).toPandas()
        t1 = time.time()
        res = {"spark_sec": round(t1 - t0, 2)}
        if name in sqls:
            dk = con.execute(sqls[name]).df()
            res.update(compare(sp, dk))
            if not res["hash_ok"]:
                res["spark_head"] = sp.sort_values(list(sp.columns)).head(3).to_dict("records")
                res["duck_head"] = dk.sort_values(list(dk.columns)).head(3).to_dict("records")
        else:
            res["rows"] = len(sp)
            res["oracle"] = "none"
        out[name] = res
        print(name, res, flush=True)
    return out


if __name__ == "__main__":
    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    run(sf, args[1:] or None)

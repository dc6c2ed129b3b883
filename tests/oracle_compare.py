"""Run a registered Spark query and its DuckDB twin; compare like the driver
(row count, sorted column names, order-insensitive value hash)."""
from __future__ import annotations

import hashlib
import os
import sys

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or (isinstance(v, float) and v != v):
        return "∅"
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def frame_hash(df: pd.DataFrame) -> str:
    cols = sorted(df.columns)
    rows = sorted("|".join(_norm(r[c]) for c in cols) for _, r in df[cols].astype(object).iterrows())
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    # whole numbers beside nulls stay whole numbers, as DuckDB's frames keep them
    sdf = E.queries()[name](spark, sf_dir).toArrow().to_pandas(integer_object_nulls=True, date_as_object=True)
    res = {"name": name, "spark_rows": len(sdf)}
    sql = E.oracle_sql().get(name)
    if sql is None:
        res["oracle"] = "none"
        return res
    con = con or duck(sf_dir)
    odf = con.execute(sql).df()
    res.update(oracle_rows=len(odf), cols_match=sorted(sdf.columns) == sorted(odf.columns))
    res["hash_match"] = res["cols_match"] and frame_hash(sdf) == frame_hash(odf)
    if not res["hash_match"]:
        res["spark_cols"], res["oracle_cols"] = list(sdf.columns), list(odf.columns)
        res["spark_head"] = sdf.head(5).to_dict("records")
        res["oracle_head"] = odf.head(5).to_dict("records")
    return res


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from sparkguard.session import get_session
    import __spark_entry__ as E
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or list(E.queries())
    con = duck(sf)
    bad = 0
    import time
    for n in names:
        t0 = time.time()
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # report and go on
            r = {"name": n, "error": repr(e)[:800]}
        ok = r.get("hash_match", r.get("oracle") == "none")
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + f"{time.time() - t0:6.2f}s", r if not ok else
              {k: r[k] for k in ("name", "spark_rows") if k in r} | ({"oracle": r["oracle"]} if "oracle" in r else {}),
              flush=True)
    print("failures:", bad)

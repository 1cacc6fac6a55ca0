"""Run catalog queries in Spark and their DuckDB oracles; compare rows, schema, values.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        if v == int(v) and abs(v) < 2**53:
            return str(int(v))
        return repr(v)  # exact: every oracle matches at full float precision
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def digest(df) -> tuple[int, list[str], str]:
    cols = sorted(df.columns)
    rows = sorted("|".join(_norm(r[c]) for c in cols) for r in df[cols].to_dict("records"))
    return len(rows), cols, hashlib.sha256("\n".join(rows).encode()).hexdigest()


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict[str, dict]:
    import __spark_entry__ as ent

    qs = ent.queries()
    sqls = ent.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        rec = {"has_oracle": name in sqls}
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir).toPandas()
            rec["spark_sec"] = round(time.time() - t0, 2)
            rec["rows"] = len(sdf)
            if name in sqls:
                ddf = con.execute(sqls[name]).df()
                a, b = digest(sdf), digest(ddf)
                rec["rows_match"] = a[0] == b[0]
                rec["schema_match"] = a[1] == b[1]
                rec["value_match"] = a[2] == b[2]
                if not (a[1] == b[1]):
                    rec["cols"] = (a[1], b[1])
                if not rec["value_match"]:
                    rec["oracle_rows"] = len(ddf)
                    rec["spark_head"] = sdf.sort_values(list(sdf.columns)).head(3).to_dict("records")
                    rec["duck_head"] = ddf.sort_values(list(ddf.columns)).head(3).to_dict("records")
        except Exception as e:  # noqa: BLE001
            rec["error"] = f"{type(e).__name__}: {str(e)[:800]}"
        out[name] = rec
        if verbose:
            print(name, rec, flush=True)
    return out


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v.get("error") or (v["has_oracle"] and not v.get("value_match"))]
    print("FAILED:", bad)
    print(f"{len(res) - len(bad)}/{len(res)} ok")

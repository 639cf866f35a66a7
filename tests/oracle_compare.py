"""Run a registered query in Spark and its oracle SQL in DuckDB, and compare
row count, column names and an order-insensitive value multiset."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    if not out["cols_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
        out["values_match"] = False
        return out
    a, b = rows_key(s_cols, s_rows), rows_key(d_cols, d_rows)
    out["values_match"] = a == b
    if a != b:
        out["only_spark"] = list((a - b).items())[:3]
        out["only_oracle"] = list((b - a).items())[:3]
    return out


def main(names=None, sf="0.01"):
    import sys
    import time
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E
    from slipway.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8)
    sf_dir = f"/root/testdata/sf{sf}"
    con = duck(sf_dir)
    qs, ora = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in ora:
                r = compare(df, con, ora[name])
            else:
                r = {"spark_rows": df.count(), "oracle": None}
        except Exception as exc:  # report and go on
            r = {"error": repr(exc)[:800]}
        ok = r.get("values_match", r.get("oracle", 0) is None and "error" not in r)
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:24s} {time.time()-t:6.2f}s {r}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    import sys
    args = [a for a in sys.argv[1:] if not a.startswith("--sf=")]
    sf = next((a[5:] for a in sys.argv[1:] if a.startswith("--sf=")), "0.01")
    raise SystemExit(1 if main(args or None, sf) else 0)

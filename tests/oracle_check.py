"""Compare a Spark result with DuckDB running the oracle SQL on the same tables.

Used by the tests and runnable by hand:
``python tests/oracle_check.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return repr(round(v, 6) + 0.0)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, name: str, sf_dir: str, query, sql: str, con=None) -> dict:
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out = {
        "name": name,
        "rows_spark": len(s_rows),
        "rows_oracle": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "hash_match": digest(s_cols, s_rows) == digest(d_cols, d_rows),
    }
    if not out["columns_match"]:
        out["only_spark"] = sorted(set(s_cols) - set(d_cols))
        out["only_oracle"] = sorted(set(d_cols) - set(s_cols))
    out["ok"] = out["columns_match"] and out["hash_match"] and len(s_rows) == len(d_rows)
    if not out["ok"] and out["columns_match"]:
        s_set = {"|".join(_norm(r[s_cols.index(c)]) for c in sorted(s_cols)) for r in s_rows}
        d_set = {"|".join(_norm(r[d_cols.index(c)]) for c in sorted(d_cols)) for r in d_rows}
        out["sample_spark_only"] = sorted(s_set - d_set)[:2]
        out["sample_oracle_only"] = sorted(d_set - s_set)[:2]
        out["header"] = sorted(s_cols)
    return out


def main(argv: list[str]) -> int:
    import __spark_entry__ as E
    from fundtrail.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or sorted(E.oracle_sql())
    spark = build_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names:
        try:
            r = compare(spark, name, sf_dir, qs[name], sqls[name], con)
        except Exception as exc:  # report and go on
            r = {"name": name, "ok": False, "error": f"{type(exc).__name__}: {str(exc)[:400]}"}
        bad += not r["ok"]
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))

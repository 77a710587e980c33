"""Run a registered Spark query and its DuckDB oracle side by side and compare them.

Mirrors the driver's correctness gate: columns sorted by name, rows compared as an
order-insensitive multiset, floats compared after rounding. Usable from pytest and as
a script: ``python tests/oracle_harness.py /root/testdata/sf0.01 [key ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(HERE)
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

EXACT = os.environ.get("ORACLE_EXACT") == "1"  # compare doubles bit for bit
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
                 "smallint": "SMALLINT", "tinyint": "TINYINT", "float": "FLOAT"}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v if EXACT else round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            return v
    return v


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def compare(spark, sf_dir: str, key: str, con=None) -> dict:
    import __spark_entry__ as E

    q = E.queries()[key]
    sql = E.oracle_sql().get(key)
    t0 = time.time()
    sdf = q(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    res = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    res["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"COLUMNS differ: spark={sorted(s_cols)} oracle={sorted(d_cols)}"
        return res
    d_types = {d[0]: str(d[1]) for d in rel.description}
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    bad_types = {c: (s_types[c], d_types[c]) for c in s_cols
                 if SPARK_TO_DUCK.get(s_types[c], s_types[c]) != d_types[c].upper()}
    if bad_types:
        res["type_diff"] = bad_types
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a == b:
        res["status"] = "match"
    else:
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        res["status"] = "VALUES differ"
        res["only_spark"] = diff_a
        res["only_oracle"] = diff_b
        res["cols"] = sorted(s_cols)
    return res


def main(argv):
    from chartmart.session import build_session
    import __spark_entry__ as E

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or list(E.queries())
    spark = build_session()
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, sf_dir, k, con)
        except Exception as e:  # report and continue
            r = {"key": k, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("match", "rows-only") or r.get("type_diff"):
            bad += 1
        print(r, flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)

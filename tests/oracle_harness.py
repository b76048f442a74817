"""Run a registered query on Spark and its SQL on DuckDB; compare the results.

Mirrors the driver's gate: same column names, same row count and the same
multiset of rows (values rendered as text after rounding doubles to 6).
"""

from __future__ import annotations

import math
import sys
from datetime import date, datetime

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6) + 0.0)
    if isinstance(v, datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


# Spark simple type names -> DuckDB type names, for the schema check
TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE"}


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as E
    df = E.queries()[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    out = {"name": name, "spark_rows": len(s_rows)}
    sql = E.oracle_sql().get(name)
    if sql is None:
        out["oracle"] = None
        return out
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    out["duck_rows"] = len(d_rows)
    out["cols_match"] = sorted(s_cols) == sorted(d_cols)
    s_types = {c: TYPE_NAMES.get(t, t) for c, t in df.dtypes}
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    out["types_match"] = s_types == d_types
    if not out["types_match"]:
        out["type_diff"] = {c: (s_types.get(c), d_types.get(c)) for c in set(s_types) | set(d_types)
                            if s_types.get(c) != d_types.get(c)}
    out["values_match"] = out["cols_match"] and rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
    if not out["values_match"]:
        out["spark_cols"], out["duck_cols"] = s_cols, d_cols
        if out["cols_match"]:
            a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
            sa, sb = set(a), set(b)
            out["only_spark"] = [r for r in a if r not in sb][:3]
            out["only_duck"] = [r for r in b if r not in sa][:3]
    return out


if __name__ == "__main__":
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from tidewater.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8,
                        conf={"spark.ui.showConsoleProgress": "false"})
    import __spark_entry__ as E
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(E.queries())
    con = duck(sf)
    import time
    bad = 0
    for n in names:
        t = time.time()
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # report and continue
            r = {"name": n, "error": repr(e)[:600]}
        r["sec"] = round(time.time() - t, 2)
        ok = r.get("values_match", r.get("oracle", 0) is None and "error" not in r)
        bad += not ok
        print("OK  " if ok else "BAD ", r, flush=True)
    print("bad:", bad)

"""Compare every registered query with its DuckDB oracle.

Usage: python tests/oracle_check.py [sf_dir] [key ...]

Checks row count, column names, type families and the multiset of rows
(order-insensitive, columns sorted by name). Prints one line per key and
exits non-zero on any mismatch.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.9g}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (dt.datetime,)):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def _family(t: str) -> str:
    t = t.lower()
    if t in ("bigint", "long", "int64"):
        return "int64"
    if t in ("integer", "int", "int32"):
        return "int32"
    if t in ("double", "float64"):
        return "float64"
    if t.startswith("varchar") or t in ("string",):
        return "string"
    if t in ("date",):
        return "date"
    if t.startswith("timestamp"):
        return "timestamp"
    if t in ("boolean",):
        return "bool"
    return t


def spark_types(df):
    m = {
        "LongType": "int64", "IntegerType": "int32", "DoubleType": "float64", "StringType": "string",
        "DateType": "date", "TimestampNTZType": "timestamp", "TimestampType": "timestamp", "BooleanType": "bool",
    }
    return {f.name: m.get(type(f.dataType).__name__, type(f.dataType).__name__) for f in df.schema.fields}


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    scols = list(sdf.columns)
    stypes = spark_types(sdf)
    rel = con.sql(sql)
    ocols = list(rel.columns)
    otypes = {c: _family(str(t)) for c, t in zip(rel.columns, rel.types)}
    orows = rel.fetchall()
    t2 = time.time()
    problems = []
    if sorted(scols) != sorted(ocols):
        problems.append(f"columns spark={sorted(scols)} oracle={sorted(ocols)}")
    else:
        bad = {c: (stypes[c], otypes[c]) for c in scols if stypes[c] != otypes[c]}
        if bad:
            problems.append(f"types {bad}")
    if len(srows) != len(orows):
        problems.append(f"rows spark={len(srows)} oracle={len(orows)}")
    if not problems:
        order = sorted(scols)
        si = [scols.index(c) for c in order]
        oi = [ocols.index(c) for c in order]
        a = sorted(tuple(_norm(r[i]) for i in si) for r in srows)
        b = sorted(tuple(_norm(r[i]) for i in oi) for r in orows)
        if a != b:
            diff = [x for x in a if x not in set(b)][:3]
            problems.append(f"values differ, e.g. spark-only {diff}")
    status = "OK  " if not problems else "FAIL"
    print(f"{status} {name:28s} rows={len(srows):7d} spark={t1 - t0:6.2f}s duckdb={t2 - t1:6.2f}s {'; '.join(problems)}", flush=True)
    return not problems


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and not argv[1].isidentifier() else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if a.isidentifier()]
    import duckdb
    import __spark_entry__ as entry

    from indicata.session import build_session

    spark = build_session("local[8]", 8, **{"spark.driver.memory": "8g"})
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, oracles = entry.queries(), entry.oracle_sql()
    ok = True
    for name, fn in qs.items():
        if keys and name not in keys:
            continue
        if name not in oracles:
            print(f"SKIP {name} (no oracle)")
            continue
        try:
            ok &= compare(spark, con, name, fn, oracles[name], sf_dir)
        except Exception as e:  # report and continue
            ok = False
            print(f"ERR  {name:28s} {type(e).__name__}: {str(e)[:400]}", flush=True)
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))

"""Run each registered query and its oracle SQL side by side (DuckDB) and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: rows, schema (column names) and value-hash match.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

EXACT = os.environ.get("ORACLE_EXACT", "0") == "1"

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def type_mismatches(df, rel_columns, rel_types) -> dict:
    """Columns whose Spark type does not correspond to the DuckDB result type."""
    duck_types = dict(zip(rel_columns, [str(t) for t in rel_types]))
    out = {}
    for f in df.schema.fields:
        spark_t = f.dataType.simpleString()
        if SPARK_TO_DUCK.get(spark_t, spark_t.upper()) != duck_types.get(f.name):
            out[f.name] = (spark_t, duck_types.get(f.name))
    return out


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return repr(v) if EXACT else repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    if isinstance(v, (dt.datetime,)):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(cols: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def spark_rows(df):
    rows = [tuple(r) for r in df.collect()]
    return df.columns, rows


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    only = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as entry
    from shoppulse.session import build_session

    spark = build_session("local[8]")
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            cols, rows = spark_rows(df)
        except Exception as exc:  # report and continue
            print(f"{name:24s} SPARK ERROR {type(exc).__name__}: {str(exc)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"{name:24s} rows={len(rows):7d} (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(sqls[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as exc:
            print(f"{name:24s} DUCKDB ERROR {str(exc)[:300]}")
            bad += 1
            continue
        ok_rows = len(rows) == len(drows)
        rel = con.sql(sqls[name])
        types_bad = type_mismatches(df, rel.columns, rel.types)
        ok_cols = sorted(cols) == sorted(dcols) and not types_bad
        ok_hash = ok_cols and digest(cols, rows) == digest(dcols, drows)
        flag = "OK " if (ok_rows and ok_cols and ok_hash) else "BAD"
        bad += flag == "BAD"
        print(
            f"{name:24s} {flag} rows={len(rows)}/{len(drows)} cols={ok_cols} hash={ok_hash} {ts:.1f}s"
        )
        if flag == "BAD" and ok_cols:
            order = sorted(range(len(cols)), key=lambda i: cols[i])
            dorder = sorted(range(len(dcols)), key=lambda i: dcols[i])
            a = sorted("|".join(norm(r[i]) for i in order) for r in rows)
            b = sorted("|".join(norm(r[i]) for i in dorder) for r in drows)
            sa, sb = set(a), set(b)
            print("   spark-only:", sorted(sa - sb)[:3])
            print("   duck-only: ", sorted(sb - sa)[:3])
        elif not ok_cols:
            print("   spark cols:", cols, " duck cols:", dcols, " type mismatches:", types_bad)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

"""Run registered queries on Spark and their DuckDB oracle side by side.

Usage: python scripts/check_oracle.py [--sf DIR] [name-prefix ...]

Compares row count, column names and an order-insensitive multiset of rows
(columns sorted by name, floats rounded to 6 places).
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from recspark.plans import load_all  # noqa: E402
from recspark.session import TABLES, get_spark  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


_SIMPLE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
           "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT", "timestamp": "TIMESTAMP WITH TIME ZONE",
           "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def duck_type(spark_type: str) -> str:
    if spark_type.startswith("array<") and spark_type.endswith(">"):
        return duck_type(spark_type[6:-1]) + "[]"
    return _SIMPLE.get(spark_type, spark_type.upper())


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--types", action="store_true", help="also compare column types")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    reg = load_all()
    spark = get_spark()
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{args.sf}/{t}.parquet')")
    bad = 0
    for name, q in reg.items():
        if args.names and not any(name.startswith(p) for p in args.names):
            continue
        t0 = time.time()
        try:
            df = q.run(spark, args.sf)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if q.sql is None:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(q.sql)
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        msg = []
        stypes = {f.name: duck_type(f.dataType.simpleString()) for f in df.schema.fields}
        dtypes = {d[0]: str(d[1]) for d in res.description}
        tdiff = {c: (stypes.get(c), dtypes.get(c)) for c in dtypes if stypes.get(c) != dtypes.get(c)}
        if tdiff and args.types:
            msg.append(f"types differ {tdiff}")
        if sorted(scols) != sorted(dcols):
            msg.append(f"cols spark={sorted(scols)} duck={sorted(dcols)}")
        if len(srows) != len(drows):
            msg.append(f"rows spark={len(srows)} duck={len(drows)}")
        if not msg:
            a, b = _rows(scols, srows), _rows(dcols, drows)
            if a != b:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                msg.append(f"values differ e.g. {diff}")
        if msg:
            bad += 1
            print(f"FAIL {name}: " + "; ".join(msg))
        else:
            print(f"OK   {name}: {len(srows)} rows {ts:.1f}s")
    spark.stop()
    print(f"failures: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())

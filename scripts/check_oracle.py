"""Run each registered query in Spark and its SQL oracle in DuckDB; compare.

Usage: python scripts/check_oracle.py [sf_dir] [name ...]
Compares row count, column names, and the multiset of rows (columns sorted
by name, doubles rounded to 6 places).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from harvestwatch.queries import oracle_sql, queries  # noqa: E402
from harvestwatch.session import get_spark  # noqa: E402
from harvestwatch.sources.driver import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "smallint": "SMALLINT", "float": "FLOAT",
                 "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP"}


def type_diffs(sdf, rel):
    st = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema}
    dt = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    return {c: (st[c], dt.get(c)) for c in st if c in dt and st[c] != dt[c]}


def main():
    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]
    spark = get_spark("local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "12g"})
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"{name:28s} rows={len(srows):6d} (no oracle) {ts:.1f}s")
            continue
        try:
            rel = con.sql(sqls[name])
            dcols = rel.columns
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SQL ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ok_cols = sorted(scols) == sorted(dcols)
        tdiff = type_diffs(sdf, rel) if ok_cols else {}
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        ok = ok_cols and a == b
        status = "OK " if ok else "DIFF"
        if not ok:
            bad += 1
        print(f"{name:28s} {status} rows spark={len(srows)} sql={len(drows)} {ts:.1f}s")
        if tdiff:
            print("   types (spark, duckdb):", tdiff)
        if not ok_cols:
            print("   columns:", sorted(set(scols) ^ set(dcols)))
        elif not ok:
            sa, sb = set(a), set(b)
            print("   spark-only:", list(sa - sb)[:2])
            print("   sql-only:  ", list(sb - sa)[:2])
    print("mismatches:", bad)


if __name__ == "__main__":
    main()

"""Run registered queries on Spark and their oracle SQL on DuckDB; compare results.

Usage: ``python tests/oracle_check.py [sf_dir] [name ...]``.  Comparison is order
insensitive: columns by name, rows sorted after normalising values (floats rounded to
6 places, dates/timestamps as ISO text).
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
from decimal import Decimal

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr), [columns[i] for i in order]


_SPARK_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "boolean": "BOOLEAN",
    "smallint": "SMALLINT", "float": "FLOAT", "tinyint": "TINYINT",
}


def _spark_type(t: str) -> str:
    if t.startswith("decimal"):
        return t.upper()
    return _SPARK_TYPES.get(t, t.upper())


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, name: str, sf_dir: str, con=None) -> tuple[bool, str]:
    import __spark_entry__ as entry

    con = con or duck_connection(sf_dir)
    t0 = time.time()
    sdf = entry.queries()[name](spark, sf_dir)
    s_rows = sdf.collect()
    t1 = time.time()
    oracle = entry.oracle_sql().get(name)
    if oracle is None:
        return True, f"{name}: spark rows={len(s_rows)} (no oracle) {t1 - t0:.2f}s"
    cur = con.execute(oracle)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    s_sorted, s_cols = _rows(sdf.columns, s_rows)
    d_sorted, d_cols = _rows(d_cols, d_rows)
    if s_cols != d_cols:
        return False, f"{name}: columns differ spark={s_cols} oracle={d_cols}"
    s_types = {f.name: _spark_type(f.dataType.simpleString()) for f in sdf.schema.fields}
    d_types = {d[0]: str(d[1]) for d in cur.description}
    bad_types = {c: (s_types[c], d_types[c]) for c in s_types if c in d_types and s_types[c] != d_types[c]}
    if bad_types:
        return False, f"{name}: column types differ (spark, oracle): {bad_types}"
    if len(s_sorted) != len(d_sorted):
        return False, f"{name}: row count spark={len(s_sorted)} oracle={len(d_sorted)}"
    for a, b in zip(s_sorted, d_sorted):
        if a != b:
            return False, f"{name}: first difference\n  spark ={a}\n  oracle={b}"
    return True, f"{name}: OK rows={len(s_sorted)} spark {t1 - t0:.2f}s"


def main(argv):
    from cinemetric.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    import __spark_entry__ as entry

    names = argv[2:] or list(entry.queries())
    con = duck_connection(sf_dir)
    bad = 0
    for n in names:
        try:
            ok, msg = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and continue
            ok, msg = False, f"{n}: ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(("PASS " if ok else "FAIL ") + msg, flush=True)
    print(f"{len(names) - bad}/{len(names)} passed")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

"""Run every ``queries()`` entry against its ``oracle_sql()`` twin in DuckDB.

Mirrors the driver's gate: row count, column names and an order-insensitive
hash of the values (columns sorted by name). Usage::

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return repr(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
                 "timestamp": "TIMESTAMP WITH TIME ZONE", "float": "FLOAT", "smallint": "SMALLINT"}


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and os.path.isdir(argv[1]) else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not os.path.isdir(a)]
    from tests.conftest import make_session
    import __spark_entry__ as E

    spark = make_session()
    con = duck(sf_dir)
    qs, os_ = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        t0 = time.time()
        sdf = qs[name](spark, sf_dir)
        srows = [tuple(r) for r in sdf.collect()]
        scols = sdf.columns
        t1 = time.time()
        if name not in os_:
            print(f"{name:28s} rows-only  spark={len(srows)} ({t1 - t0:.1f}s)")
            continue
        rel = con.sql(os_[name])
        dtypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        stypes = {c: SPARK_TO_DUCK.get(t, t) for c, t in sdf.dtypes}
        type_bad = {c: (stypes[c], dtypes.get(c)) for c in stypes if stypes[c] != dtypes.get(c)}
        dcols = rel.columns
        drows = rel.fetchall()
        hs, ls = digest(scols, srows)
        hd, ld = digest(dcols, drows)
        ok = (sorted(scols) == sorted(dcols) and len(srows) == len(drows) and hs == hd
              and not type_bad)
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} rows {len(srows)}/{len(drows)} "
              f"({t1 - t0:.1f}s)")
        if not ok:
            if type_bad:
                print("   types (spark, duck):", type_bad)
            if sorted(scols) != sorted(dcols):
                print("   cols spark", scols, "\n   cols duck ", dcols)
            only_s = sorted(set(ls) - set(ld))[:5]
            only_d = sorted(set(ld) - set(ls))[:5]
            print("   spark-only:", only_s, "\n   duck-only: ", only_d)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

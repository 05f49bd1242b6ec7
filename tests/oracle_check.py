"""Run registered queries in Spark and their SQL oracles in DuckDB; compare exactly.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
          "boolean": "BOOLEAN", "smallint": "SMALLINT", "float": "FLOAT"}


def type_mismatches(df, cur) -> list[str]:
    """Columns whose Spark type differs from the DuckDB result type."""
    duck = {d[0]: str(d[1]).upper() for d in cur.description}
    bad = []
    for name, typ in df.dtypes:
        want = _TYPES.get(typ, typ.upper())
        if name in duck and duck[name] != want:
            bad.append(f"{name}: spark {typ} vs sql {duck[name]}")
    return bad


def rows_key(rows):
    return sorted((tuple(_norm(v) for v in r) for r in rows), key=repr)


def compare(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as e
    qs, sqls = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        cols = sorted(df.columns)
        got = rows_key([tuple(r[c] for c in cols) for r in df.collect()])
        dt = time.time() - t0
        if name not in sqls:
            results[name] = ("rows-only", len(got))
            if verbose:
                print(f"{name:32s} rows-only {len(got)} rows {dt:.2f}s", flush=True)
            continue
        cur = con.execute(sqls[name])
        ocols = [d[0] for d in cur.description]
        orows = cur.fetchall()
        idx = [ocols.index(c) for c in cols] if sorted(ocols) == cols else None
        if idx is None:
            results[name] = ("columns", cols, sorted(ocols))
            print(f"{name:32s} COLUMN MISMATCH spark={cols} sql={sorted(ocols)}", flush=True)
            continue
        exp = rows_key([tuple(r[i] for i in idx) for r in orows])
        types = type_mismatches(df, cur)
        ok = got == exp and not types
        if types:
            print(f"  {name} type mismatch: {types}")
        results[name] = ("ok" if ok else "diff", len(got), len(exp))
        if verbose:
            print(f"{name:32s} {'OK  ' if ok else 'DIFF'} spark={len(got)} sql={len(exp)} {dt:.2f}s",
                  flush=True)
            if not ok:
                gs, es = set(got), set(exp)
                print("  only spark:", list(gs - es)[:3])
                print("  only sql:  ", list(es - gs)[:3])
    return results


if __name__ == "__main__":
    from ledgerline.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark()
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] not in ("ok", "rows-only")]
    print("FAILED:", bad if bad else "none")

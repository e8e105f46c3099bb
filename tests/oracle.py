"""Side-by-side check of registered queries against their DuckDB oracle text.

Usage: python -m tests.oracle [sf_dir] [name ...]
Prints one line per query: rows, schema and value agreement.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return float(v)
    except Exception:
        pass
    if isinstance(v, bool):
        return int(v)
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srecs = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return dict(name=name, rows=len(srecs), oracle=None, secs=round(t1 - t0, 2))
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drecs = res.fetchall()
    out = dict(name=name, rows=len(srecs), oracle_rows=len(drecs), secs=round(t1 - t0, 2))
    out["schema"] = sorted(scols) == sorted(dcols)
    if not out["schema"]:
        out["detail"] = f"spark={sorted(scols)} duck={sorted(dcols)}"
        return out
    a, b = _rows(scols, srecs), _rows(dcols, drecs)
    out["values"] = a == b
    if not out["values"]:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["detail"] = f"cols={sorted(scols)} first diffs={diff}"
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from fraudspark.session import local_session
    spark = local_session()
    qs, oracle = E.queries(), E.oracle_sql()
    con = duck_connection(sf_dir)
    bad = 0
    for name in (names or list(qs)):
        try:
            r = compare(spark, con, name, qs[name], oracle.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = dict(name=name, error=f"{type(e).__name__}: {str(e)[:600]}")
        ok = r.get("values", r.get("oracle", 1) is None) and "error" not in r
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(names or qs) - bad} ok, {bad} bad")


if __name__ == "__main__":
    main(sys.argv)

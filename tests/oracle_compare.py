"""Run a registered query in Spark and its oracle SQL in DuckDB; compare results.

Usable from pytest and from the command line:
    python -m tests.oracle_compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{round(v, 6):.6f}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "asDict"):
        return _norm(tuple(v))
    if isinstance(v, dict):
        return _norm(tuple(v.values()))
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> tuple[list[str], str, int]:
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return [columns[i].lower() for i in order], h, len(rows)


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    dcols = list(rel.columns)
    drows = rel.fetchall()
    t2 = time.time()
    sc, sh, sn = digest(list(sdf.columns), srows)
    dc, dh, dn = digest(dcols, drows)
    out = {"name": name, "rows_spark": sn, "rows_duck": dn, "cols_ok": sc == dc,
           "hash_ok": sh == dh, "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    if sc != dc:
        out["cols"] = (sc, dc)
    if sh != dh and sn == dn:
        order_s = sorted(range(len(sdf.columns)), key=lambda i: sdf.columns[i].lower())
        order_d = sorted(range(len(dcols)), key=lambda i: dcols[i].lower())
        ls = sorted("|".join(_norm(r[i]) for i in order_s) for r in srows)
        ld = sorted("|".join(_norm(r[i]) for i in order_d) for r in drows)
        diffs = [(a, b) for a, b in zip(ls, ld) if a != b][:3]
        out["diff"] = diffs
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries

    from tastemap.session import get_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = get_session("local[8]", 8)
    qs, os_ = queries(), oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in os_:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print({"name": name, "rows_spark": n, "oracle": None, "spark_s": round(time.time() - t0, 2)})
            continue
        res = compare(spark, name, fn, os_[name], sf_dir, con)
        ok = res["cols_ok"] and res["hash_ok"] and res["rows_spark"] == res["rows_duck"]
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(res), flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))

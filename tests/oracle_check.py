"""Run registered queries in Spark and their DuckDB oracle side by side.

Usage: python tests/oracle_check.py [sf_dir] [name-substring ...]
Prints one line per query: rows, column match, value match.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck_con(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


EXACT = os.environ.get("EXACT") == "1"  # compare doubles bit for bit


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if EXACT else round(v, 6)
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime()
    return v


def rows_of(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as entry

    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck_con(sf_dir)
    results = {}
    for name, fn in qs.items():
        if names and not any(n in name for n in names):
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        sql = sqls.get(name)
        if sql is None:
            results[name] = ("no-oracle", len(s_rows))
            if verbose:
                print(f"{name:45s} rows={len(s_rows):6d} (no oracle) {t1 - t0:.1f}s", flush=True)
            continue
        cur = con.execute(sql)
        d_cols = [c[0] for c in cur.description]
        d_rows = cur.fetchall()
        cols_ok = sorted(s_cols) == sorted(d_cols)
        vals_ok = cols_ok and rows_of(s_rows, s_cols) == rows_of(d_rows, d_cols)
        results[name] = (cols_ok, len(s_rows), len(d_rows), vals_ok)
        if verbose:
            flag = "OK " if (cols_ok and vals_ok and len(s_rows) == len(d_rows)) else "BAD"
            print(f"{flag} {name:45s} spark={len(s_rows):6d} duck={len(d_rows):6d} cols={cols_ok} vals={vals_ok} "
                  f"{t1 - t0:.1f}s", flush=True)
            if not cols_ok:
                print("   spark cols:", s_cols, "\n   duck cols:", d_cols)
            elif not vals_ok:
                a, b = rows_of(s_rows, s_cols), rows_of(d_rows, d_cols)
                diff_a = [r for r in a if r not in set(b)][:3]
                diff_b = [r for r in b if r not in set(a)][:3]
                print("   spark-only:", diff_a, "\n   duck-only:", diff_b)
    return results


if __name__ == "__main__":
    from careledger.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(shuffle_partitions=8)
    compare(spark, sf, sys.argv[2:] or None)

"""Run catalogue queries in Spark and their SQL oracles in DuckDB, compare.

Usage: python tests/oracle_harness.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


EXACT = os.environ.get("ORACLE_EXACT") == "1"


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if EXACT else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) if not isinstance(x, tuple)
                 else (False, "t", str(x)) for x in row)


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    if sorted(spark_cols) != sorted(duck_cols):
        return f"columns differ: {sorted(spark_cols)} vs {sorted(duck_cols)}"
    order = sorted(range(len(spark_cols)), key=lambda i: spark_cols[i])
    dorder = [duck_cols.index(spark_cols[i]) for i in order]
    a = sorted((tuple(_norm(r[i]) for i in order) for r in spark_rows), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in dorder) for r in duck_rows), key=_key)
    if len(a) != len(b):
        return f"row count {len(a)} vs {len(b)}"
    bad = 0
    first = None
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            if isinstance(u, float) and isinstance(v, (float, int)) or isinstance(v, float) and isinstance(u, int):
                if EXACT and u != v:
                    bad += 1
                    first = first or (x, y)
                    break
                # one unit in the 4th place: values rounded on both sides may
                # straddle a rounding tie after last-bit summation differences
                if not math.isclose(u, v, rel_tol=1e-9, abs_tol=1.01e-4):
                    bad += 1
                    first = first or (x, y)
                    break
            elif u != v:
                bad += 1
                first = first or (x, y)
                break
    return None if bad == 0 else f"{bad} rows differ, e.g. {first}"


def run(sf_dir: str, names: list[str] | None = None) -> dict:
    from panelcast.session import get_session
    import __spark_entry__ as E
    spark = get_session("local[8]", shuffle_partitions=8)
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name, fn in sorted(qs.items()):
        if names and not any(n in name for n in names):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(name, results[name], flush=True)
            continue
        ts = time.time() - t0
        if name not in orc:
            results[name] = f"rows-only {len(srows)}"
            print(f"{name}: {results[name]} ({ts:.1f}s)", flush=True)
            continue
        try:
            cur = con.execute(orc[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = f"DUCKDB ERROR {type(e).__name__}: {str(e)[:300]}"
            print(name, results[name], flush=True)
            continue
        diff = compare(srows, scols, drows, dcols)
        results[name] = diff or f"OK {len(srows)}"
        print(f"{name}: {results[name]} ({ts:.1f}s)", flush=True)
    return results


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    res = run(sf, sys.argv[2:] or None)
    ok = sum(1 for v in res.values() if v.startswith("OK") or v.startswith("rows-only"))
    print(f"{ok}/{len(res)} pass")

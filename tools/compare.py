"""Run bound queries and their SQL side by side: python tools/compare.py [folder] [name ...]"""

from __future__ import annotations

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def canonical(rows, names):
    """Rows as a sorted multiset of typed cells, columns in name order."""
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return "null"
        if isinstance(v, bool):
            return f"b{v}"
        if isinstance(v, (int, float)):
            return f"{float(v):.10g}"
        return str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, bound, folder):
    df = bound.run(spark, folder)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    if bound.sql is None:
        return len(got), None, "rows only"
    cursor = con.execute(bound.sql)
    names = [d[0] for d in cursor.description]
    want = canonical(cursor.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return len(got), False, f"columns {sorted(df.columns)} / {sorted(names)}"
    if got != want:
        left, right = [r for r in got if r not in set(want)][:2], [r for r in want if r not in set(got)][:2]
        return len(got), False, f"{len(got)} / {len(want)} rows; spark {left} sql {right}"
    return len(got), True, ""


if __name__ == "__main__":
    from plumbline.catalog import REGISTRY
    from plumbline.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(REGISTRY)
    spark = build_session("local[8]", **{"spark.log.level": "ERROR", "spark.ui.showConsoleProgress": "false"})
    con = connect(folder)
    bad = 0
    for name in chosen:
        start = time.time()
        try:
            n, ok, why = compare(spark, con, REGISTRY[name], folder)
        except Exception as e:  # report and go on
            n, ok, why = 0, False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += ok is False
        print(f"{'ok  ' if ok else 'rows' if ok is None else 'FAIL'} {name:28s} {n:7d} {time.time() - start:6.2f}s {why}", flush=True)
    print("failed:", bad, "of", len(chosen))

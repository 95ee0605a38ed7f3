"""Compare queries with their oracles: ``python tests/oracle_check.py [pattern ...]``."""

from __future__ import annotations

import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from strandframe.plans import REGISTRY  # noqa: E402
from strandframe.plans.fixtures import TABLES  # noqa: E402


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _kind(t: str) -> str:
    t = t.lower()
    if t in ("bigint", "long", "int64"):
        return "long"
    if t in ("int", "integer"):
        return "int"
    if t in ("varchar", "string"):
        return "string"
    return t


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(repr(r[i]) if not isinstance(r[i], float) else repr(r[i] + 0.0) for i in order) for r in rows]
    return sorted(out)


def compare(spark, con, name, sf_dir):
    q = REGISTRY[name]
    t0 = time.time()
    df = q.run(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    spent = time.time() - t0
    if not q.sql:
        return (False, "no oracle", spent)
    cur = con.execute(q.sql)
    names = [d[0] for d in cur.description]
    types = [str(d[1]) for d in cur.description]
    want = cur.fetchall()
    problems = []
    a = {n: _kind(t) for n, t in df.dtypes}
    b = {n: _kind(t) for n, t in zip(names, types)}
    if a != b:
        problems.append("schema " + str({k: (a.get(k), b.get(k)) for k in set(a) | set(b) if a.get(k) != b.get(k)}))
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if not problems or "rows" not in problems[-1] or True:
        x, y = _rows(df.columns, got), _rows(names, want)
        if x != y:
            from collections import Counter

            cx, cy = Counter(x), Counter(y)
            problems.append(f"values: spark only {list((cx - cy).items())[:2]} oracle only {list((cy - cx).items())[:2]}")
    if not want:
        problems.append("oracle is empty")
    return (not problems, "; ".join(problems)[:1500] or f"ok {len(got)} rows", spent)


def main():
    from strandframe.session import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    patterns = sys.argv[1:] or ["."]
    bad = 0
    for name in REGISTRY:
        if not any(re.search(p, name) for p in patterns):
            continue
        try:
            ok, text, spent = compare(spark, con, name, sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, text, spent = False, f"{type(e).__name__}: {str(e)[:900]}", 0
        bad += not ok
        print(f"{'PASS' if ok else 'FAIL'} {name} {spent:.1f}s {text if not ok or 'rows only' in text else text}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()

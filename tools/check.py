"""Local correctness check: Spark query vs DuckDB oracle (row count, columns,
order-insensitive values). Usage: python tools/check.py [sf_dir] [key ...]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from barloom.plans import catalog  # noqa: E402
from barloom.session import local_session  # noqa: E402
from barloom.sources.fixtures import BASE_TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def key_of(row):
    return tuple((0, "") if x is None else (1, str(x)) for x in row)


def main() -> int:
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    catalog.load_all()
    spark = local_session()
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, orc = catalog.queries(), catalog.oracle_sql()
    names = args or list(qs)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            cols = sdf.columns
            srows = [tuple(norm(r[c]) for c in sorted(cols)) for r in sdf.collect()]
            ts = time.time() - t0
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(exc).__name__}: {str(exc)[:400]}")
            bad += 1
            continue
        if name not in orc:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(orc[name])
            dcols = [d[0] for d in res.description]
            drows_raw = res.fetchall()
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(exc)[:400]}")
            bad += 1
            continue
        idx = {c: i for i, c in enumerate(dcols)}
        if sorted(dcols) != sorted(cols):
            print(f"FAIL {name}: columns differ spark={sorted(cols)} duck={sorted(dcols)}")
            bad += 1
            continue
        drows = [tuple(norm(r[idx[c]]) for c in sorted(cols)) for r in drows_raw]
        srows.sort(key=key_of)
        drows.sort(key=key_of)
        if len(srows) != len(drows):
            print(f"FAIL {name}: rows spark={len(srows)} duck={len(drows)}")
            bad += 1
            continue
        diffs = [(a, b) for a, b in zip(srows, drows) if a != b]
        if diffs:
            print(f"FAIL {name}: {len(diffs)} value diffs of {len(srows)}; cols={sorted(cols)}")
            for a, b in diffs[:3]:
                print("   spark", a)
                print("   duck ", b)
            bad += 1
        else:
            print(f"OK   {name}: {len(srows)} rows {ts:.1f}s")
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())

"""Run registered queries on Spark and their SQL oracles on DuckDB, compare.

Usage: python tools/oracle_check.py [sf_dir] [name ...]

Comparison: same row count, same column names, and the same multiset of
rows after sorting columns by name and rounding doubles to 9 significant
digits.  Also reports whether the rows match exactly (no rounding).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _is_missing(x) -> bool:
    if x is None:
        return True
    if isinstance(x, float) and math.isnan(x):
        return False          # NaN is a value, kept as "nan" by _norm
    try:
        import pandas as pd
        return x is pd.NaT or (not hasattr(x, "__len__") and bool(pd.isna(x)))
    except (TypeError, ValueError):
        return False


def _norm(v, digits):
    """Comparable form of one value: timestamps/dates as ISO text, floats
    rounded to ``digits`` significant digits (``None``: exact), containers
    recursively."""
    import datetime as _dt
    if _is_missing(v):
        return None
    if isinstance(v, (_dt.date, _dt.datetime)) or type(v).__name__ == "Timestamp":
        import pandas as pd
        return pd.Timestamp(v).isoformat()
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if digits is None or v == 0 or math.isinf(v):
            return v
        return float(f"{v:.{digits}g}")
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    return v


def _rows(pdf, digits):
    """Rows of a pandas frame with columns sorted by name, values normalised,
    rows sorted."""
    cols = sorted(pdf.columns)
    out = [tuple(_norm(x, digits) for x in rec)
           for rec in pdf[cols].itertuples(index=False, name=None)]
    return sorted(out, key=repr)


def _close(x, y):
    if isinstance(x, tuple) and isinstance(y, tuple):
        return len(x) == len(y) and all(_close(p, q) for p, q in zip(x, y))
    if isinstance(x, float) and isinstance(y, float):
        return math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-12)
    return x == y


def same_rows(sdf, odf) -> tuple[bool, list]:
    """Multiset equality with a relative float tolerance: rows are paired
    after sorting on a coarsely rounded key, then compared exactly except
    for floats."""
    def key(r):
        # exact non-float values first (they pair rows unambiguously when
        # present), then floats coarsely rounded
        exact = tuple(x for x in r if not isinstance(x, float))
        floats = tuple(_norm(x, 6) for x in r if isinstance(x, float))
        return repr(exact) + repr(floats)
    a = sorted(_rows(sdf, None), key=key)
    b = sorted(_rows(odf, None), key=key)
    diff = [(x, y) for x, y in zip(a, b) if not _close(x, y)]
    return not diff, diff[:2]


def main(argv):
    import duckdb
    from squall.plans import oracle_sql, queries
    from squall.session import get_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, oracles = queries(), oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir).toPandas()
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(exc).__name__}: {str(exc)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in oracles:
            print(f"ROWS {name}: {len(sdf)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            odf = con.execute(oracles[name]).df()
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(exc)[:300]}")
            bad += 1
            continue
        if sorted(sdf.columns) != sorted(odf.columns):
            print(f"FAIL {name}: columns spark={sorted(sdf.columns)} oracle={sorted(odf.columns)}")
            bad += 1
            continue
        if len(sdf) != len(odf):
            print(f"FAIL {name}: rows spark={len(sdf)} oracle={len(odf)}")
            bad += 1
            continue
        ok, diff = same_rows(sdf, odf)
        if not ok:
            print(f"FAIL {name}: values differ, e.g. {diff}")
            bad += 1
            continue
        exact = _rows(sdf, None) == _rows(odf, None)
        dtypes = [(c, str(sdf[c].dtype), str(odf[c].dtype)) for c in sorted(sdf.columns)
                  if str(sdf[c].dtype) != str(odf[c].dtype)]
        print(f"OK   {name}: {len(sdf)} rows {ts:.1f}s exact={exact}"
              + (f" dtype-diff={dtypes}" if dtypes else ""))
    print(f"{bad} failures")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)

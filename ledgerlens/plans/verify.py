"""Local oracle check: run a catalogue query in Spark and its SQL in DuckDB,
then compare row count, column names and sorted values."""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

from ledgerlens.plans.registry import boundary, boundary_sql
from ledgerlens.sources.tables import TABLES


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (int, float)):
        return float(v)
    return v


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, name: str, sf_dir: str, tol: float = 1e-6) -> dict:
    from ledgerlens.plans import catalog
    t0 = time.time()
    sdf = boundary(catalog.QUERIES[name](spark, sf_dir), name)
    left = sdf.toPandas()
    t1 = time.time()
    out = {"query": name, "spark_sec": round(t1 - t0, 2), "rows": len(left)}
    sql = boundary_sql(name) if name in catalog.ORACLE else None
    if sql is None:
        out["status"] = "rows-only"
        return out
    right = duck(sf_dir).execute(sql).df()
    out["oracle_rows"] = len(right)
    if sorted(left.columns) != sorted(right.columns):
        out["status"] = "schema"
        out["detail"] = (sorted(set(left.columns) ^ set(right.columns)))
        return out
    a, b = _rows(left), _rows(right)
    if len(a) != len(b):
        out["status"] = "rowcount"
        return out
    exact = a == b
    bad = 0
    first = None
    for ra, rb in zip(a, b):
        for x, y in zip(ra, rb):
            same = (x == y) or (isinstance(x, float) and isinstance(y, (float, int)) and abs(x - y) <= tol * max(1, abs(y)))
            if not same:
                bad += 1
                first = first or (ra, rb)
                break
    out["status"] = "exact" if exact else ("close" if bad == 0 else "mismatch")
    if first:
        out["detail"] = [str(first[0])[:300], str(first[1])[:300], sorted(left.columns)]
    out["bad_rows"] = bad
    return out


def main(argv):
    from ledgerlens.plans import catalog
    from ledgerlens.session import get_spark
    sf_dir = "/root/testdata/sf0.01"
    names = argv or sorted(catalog.QUERIES)
    spark = get_spark(8)
    ok = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir)
        except Exception as e:  # report and continue
            r = {"query": n, "status": "error", "detail": repr(e)[:400]}
        ok += r["status"] in ("exact", "close", "rows-only")
        print(r, flush=True)
    print(f"{ok}/{len(names)} ok")


if __name__ == "__main__":
    main(sys.argv[1:])

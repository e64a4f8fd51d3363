"""Run registered queries against their DuckDB SQL twins and compare.

Usage: python tests/oracle.py [sf_dir] [name ...]
The comparison is order-insensitive, sorts columns by name and rounds
floating values to 6 places (the registered queries already round).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tessera.plans.registry import oracle_sql, queries  # noqa: E402
from tessera.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 5) + 0.0
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _canon(v.item())
        except Exception:
            pass
    if isinstance(v, (list, tuple)) or (hasattr(v, "tolist") and not isinstance(v, str)):
        seq = v.tolist() if hasattr(v, "tolist") else v
        return tuple(_canon(x) for x in seq)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return v
    if hasattr(v, "isoformat"):
        return str(v)[:19]
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_canon(x) for x in rec))
    return cols, sorted(out, key=repr)


def compare(sdf, odf):
    sc, sr = rows_of(sdf)
    oc, orows = rows_of(odf)
    if sc != oc:
        return f"columns differ: spark={sc} oracle={oc}"
    if len(sr) != len(orows):
        return f"row count spark={len(sr)} oracle={len(orows)}"
    for a, b in zip(sr, orows):
        if a != b:
            return f"first diff spark={a} oracle={b}"
    return None


def main(argv):
    sf_dir = "/root/testdata/sf0.01"
    names = []
    for a in argv:
        if a.startswith("/"):
            sf_dir = a
        else:
            names.append(a)
    from tessera.session import get_spark
    spark = get_spark()
    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    names = names or sorted(qs)
    bad = 0
    for n in names:
        t = time.time()
        try:
            sdf = qs[n](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        st = time.time() - t
        if n not in sqls:
            print(f"rows {n}: {len(sdf)} rows (no SQL) {st:.1f}s")
            continue
        try:
            odf = con.execute(sqls[n]).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        msg = compare(sdf, odf)
        if msg:
            bad += 1
            print(f"FAIL {n}: {msg}")
        else:
            print(f"ok   {n}: {len(sdf)} rows {st:.1f}s")
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)

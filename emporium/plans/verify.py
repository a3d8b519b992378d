"""Compare a Spark query with its DuckDB oracle (same rows, any order).

Usage: ``python -m emporium.plans.verify SF_DIR [name ...]``.
"""
from __future__ import annotations

import math
import sys
import time

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_connect(sf_dir: str):
    import duckdb
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
        return float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return str(v).replace("T", " ")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
                 "array<string>": "VARCHAR[]"}


def type_diffs(sdf, con, sql: str) -> list[str]:
    """Columns whose Spark type and DuckDB type differ (schema only, no job)."""
    res = con.execute(f"SELECT * FROM ({sql}) LIMIT 0")
    duck = {d[0]: str(d[1]) for d in res.description}
    out = []
    for f in sdf.schema.fields:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
        if duck.get(f.name) != want:
            out.append(f"{f.name}: spark {f.dataType.simpleString()} duck {duck.get(f.name)}")
    return out


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> tuple[bool, str]:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    if sorted(scols) != sorted(dcols):
        return False, f"columns differ: spark={scols} duck={dcols}"
    a, b = _rows(scols, srows), _rows(dcols, drows)
    if len(a) != len(b):
        return False, f"row count spark={len(a)} duck={len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return False, f"first diff cols={sorted(scols)}\n spark={x}\n duck ={y}"
    return True, f"{len(a)} rows spark {t1 - t0:.1f}s duck {t2 - t1:.1f}s"


def main(argv):
    from emporium.plans import catalog
    from emporium.session import build_session
    types_only = "--types" in argv
    argv = [a for a in argv if a != "--types"]
    sf_dir = argv[0] if argv else "/root/testdata/sf0.001"
    names = argv[1:]
    spark = build_session()
    con = duck_connect(sf_dir)
    qs, orc = catalog.all_queries(), catalog.all_oracles()
    bad = 0
    for name in (names or sorted(qs)):
        if types_only:
            if name in orc:
                diffs = type_diffs(qs[name](spark, sf_dir), con, orc[name])
                bad += bool(diffs)
                print(f"{'TYPE' if diffs else 'ok  '} {name}: {'; '.join(diffs)}", flush=True)
            continue
        if name not in orc:
            n = qs[name](spark, sf_dir).count()
            print(f"-- {name}: no oracle ({n} rows)")
            continue
        try:
            ok, msg = compare(spark, con, name, qs[name], orc[name], sf_dir)
        except Exception as e:  # report and continue
            ok, msg = False, f"error {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name}: {msg}", flush=True)
    print(f"{bad} mismatches")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)

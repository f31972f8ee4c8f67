"""Run each query on Spark and its SQL on DuckDB; compare rows, schema, values.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import hashlib
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _arrow(rel):
    for name in ("to_arrow_table", "fetch_arrow_table", "arrow"):
        if hasattr(rel, name):
            out = getattr(rel, name)()
            if hasattr(out, "read_all"):
                out = out.read_all()
            return out
    raise RuntimeError("no arrow export on relation")


def _canon(v):
    if isinstance(v, float):
        return repr(round(v, 6))
    return repr(v)


def summarize(table) -> tuple[list[str], list[str], int, str]:
    """(sorted names, types in that order, row count, order-insensitive hash)."""
    names = sorted(table.column_names)
    cols = [table.column(n).to_pylist() for n in names]
    types = [str(table.schema.field(n).type) for n in names]
    rows = sorted("|".join(_canon(c[i]) for c in cols) for i in range(table.num_rows))
    h = hashlib.sha256("\n".join(rows).encode()).hexdigest()
    return names, types, table.num_rows, h


def compare(spark, con, sf_dir: str, key: str, fn, sql: str | None) -> dict:
    t0 = time.time()
    sp = fn(spark, sf_dir).toArrow()
    t1 = time.time()
    s_names, s_types, s_rows, s_hash = summarize(sp)
    out = {"key": key, "rows": s_rows, "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    dk = _arrow(con.sql(sql))
    d_names, d_types, d_rows, d_hash = summarize(dk)
    out.update({
        "names": s_names == d_names, "types": s_types == d_types,
        "count": s_rows == d_rows, "values": s_hash == d_hash,
    })
    if not (out["names"] and out["count"] and out["values"]):
        out["detail"] = {"spark": (s_names, s_types, s_rows), "duck": (d_names, d_types, d_rows)}
    elif not out["types"]:
        out["detail"] = {"spark_types": s_types, "duck_types": d_types}
    out["status"] = "ok" if all(out[k] for k in ("names", "types", "count", "values")) else "MISMATCH"
    return out


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from starloom.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for k, fn in qs.items():
        if keys and k not in keys:
            continue
        try:
            r = compare(spark, con, sf_dir, k, fn, sqls.get(k))
        except Exception as e:  # report and continue
            r = {"key": k, "status": "ERROR", "error": f"{type(e).__name__}: {str(e)[:300]}"}
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    print(f"{bad} not ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)

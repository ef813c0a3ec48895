"""Local Spark-vs-DuckDB comparison of named queries.

Mirrors the external check: row count, column names, and an
order-insensitive hash of the values (floats rounded to 9 significant
digits, timestamps as naive ISO text).
"""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.9g}" if v != 0 else "0"
    if isinstance(v, decimal.Decimal):
        return _norm(float(v))
    if isinstance(v, _dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def rows_hash(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict:
    from siglake.plans.catalog import all_oracles, all_queries
    qs, sqls = all_queries(), all_oracles()
    con = duckdb_connection(sf_dir)
    report = {}
    for name in names or list(qs):
        entry = {"oracle": name in sqls}
        try:
            df = qs[name](spark, sf_dir)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
            entry["rows"] = len(srows)
            if name in sqls:
                cur = con.execute(sqls[name])
                dcols = [d[0] for d in cur.description]
                drows = cur.fetchall()
                entry["oracle_rows"] = len(drows)
                entry["schema_ok"] = sorted(scols) == sorted(dcols)
                entry["hash_ok"] = rows_hash(scols, srows) == rows_hash(dcols, drows)
                entry["ok"] = entry["schema_ok"] and entry["hash_ok"] and len(srows) == len(drows)
                if not entry["ok"]:
                    entry["spark_cols"], entry["oracle_cols"] = scols, dcols
                    s_only = set(map(lambda r: "|".join(_norm(x) for x in r), srows))
                    d_only = set(map(lambda r: "|".join(_norm(x) for x in r), drows))
                    entry["spark_sample"] = sorted(s_only - d_only)[:3]
                    entry["oracle_sample"] = sorted(d_only - s_only)[:3]
            else:
                entry["ok"] = True
        except Exception as e:  # report, keep going
            entry["ok"] = False
            entry["error"] = f"{type(e).__name__}: {str(e)[:400]}"
        report[name] = entry
        if verbose:
            print(name, entry, flush=True)
    return report

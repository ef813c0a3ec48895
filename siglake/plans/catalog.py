"""Named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (whole tables, whole texts) and runs the
library's operators on them; ``siglake.plans.oracle`` holds the matching SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siglake.plans import serving

QueryFn = Callable[[SparkSession, str], DataFrame]

# Columns each panel kind reads from its serving table.
_PANEL_COLUMNS = {
    "total": ["event_timestamp"],
    "by_severity": ["severity_clean"],
    "hourly": ["event_timestamp"],
}


def _panel_query(table: str, kind: str, dim: str | None = None) -> QueryFn:
    spec = serving.PANELS[table]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if kind == "recent":
            cols = list(spec.recent_cols)
        elif kind == "by_dim":
            cols = [dim]
        else:
            cols = _PANEL_COLUMNS[kind]
        t = serving.serving_table(spark, sf_dir, table, columns=cols)
        if kind == "total":
            return serving.panel_total(t, spec)
        if kind == "by_severity":
            return serving.panel_by_severity(t, spec)
        if kind == "by_dim":
            return serving.panel_by_dim(t, spec, dim)
        if kind == "hourly":
            return serving.panel_hourly(t, spec)
        return serving.panel_recent(t, spec)

    run.__name__ = f"{table}_{kind}"
    return run


def panel_queries() -> dict[str, QueryFn]:
    out: dict[str, QueryFn] = {}
    for table, spec in serving.PANELS.items():
        out[f"total_{table}"] = _panel_query(table, "total")
        out[f"{table}_by_severity"] = _panel_query(table, "by_severity")
        for dim, alias in spec.dims.items():
            out[f"{table}_by_{alias}"] = _panel_query(table, "by_dim", dim)
        out[f"{table}_hourly"] = _panel_query(table, "hourly")
        out[f"recent_{table}"] = _panel_query(table, "recent")
    return out


def in_utc(fn: QueryFn) -> QueryFn:
    """Declare the query with the session zone pinned to UTC.

    Time-zone-aware expressions (casts between TIMESTAMP and TIMESTAMP_NTZ,
    hour truncation, date formatting) bind the session zone when the plan is
    analysed, so a plan declared here gives UTC results even when the
    caller's session uses another zone; the caller's setting is restored.
    """
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = "spark.sql.session.timeZone"
        prev = spark.conf.get(key)
        if prev == "UTC":                    # the usual case: nothing to pin
            return fn(spark, sf_dir)
        spark.conf.set(key, "UTC")
        try:
            df = fn(spark, sf_dir)
            df._jdf.queryExecution().analyzed()
            return df
        finally:
            spark.conf.set(key, prev)

    run.__name__ = getattr(fn, "__name__", "query")
    return run


def all_queries() -> dict[str, QueryFn]:
    from siglake.plans import queries as q
    out = panel_queries()
    out.update(q.operator_queries())
    return {k: in_utc(v) for k, v in out.items()}


def all_oracles() -> dict[str, str]:
    from siglake.plans import oracle, oracle_ops
    out = oracle.panel_sql()
    out.update(oracle_ops.operator_sql())
    return out

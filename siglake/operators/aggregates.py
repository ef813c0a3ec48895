"""Dashboard aggregates and top-k.

Each is one hash aggregate (partial + final; the partial step runs inside
every scan task) or one ``TakeOrderedAndProject`` (per-task top-k, then a
bounded merge), so none of them moves more than a handful of rows per task
through the shuffle whatever the table size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siglake.functions.timeparse import hour_bucket, wall_clock


def time_slice(df: DataFrame, since=None, until=None, ts_col: str = "event_timestamp",
               date_col: str = "event_date") -> DataFrame:
    """Optional [since, until) window. The ``event_date`` predicate lets a
    date-partitioned table prune whole directories; the timestamp predicate
    keeps the bound exact."""
    out = df
    if since is not None:
        out = out.where(F.col(ts_col) >= F.lit(since).cast("timestamp"))
        if date_col in df.columns:
            out = out.where(F.col(date_col) >= F.date_format(F.lit(since).cast("timestamp"), "yyyy-MM-dd"))
    if until is not None:
        out = out.where(F.col(ts_col) < F.lit(until).cast("timestamp"))
        if date_col in df.columns:
            out = out.where(F.col(date_col) <= F.date_format(F.lit(until).cast("timestamp"), "yyyy-MM-dd"))
    return out


def total_count(df: DataFrame, alias: str) -> DataFrame:
    """``COALESCE(COUNT(*), 0)`` - a global count is never NULL."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def count_by(df: DataFrame, col: str | Column, alias: str, count_alias: str = "count") -> DataFrame:
    """Rows per value; NULL is its own group."""
    c = F.col(col) if isinstance(col, str) else col
    return df.groupBy(c.alias(alias)).agg(F.count(F.lit(1)).alias(count_alias))


def hourly_counts(df: DataFrame, count_alias: str, ts_col: str = "event_timestamp",
                  time_alias: str = "time") -> DataFrame:
    """Rows per hour, ordered by hour (NULL event times form one group)."""
    h = wall_clock(hour_bucket(ts_col)).alias(time_alias)
    return df.groupBy(h).agg(F.count(F.lit(1)).alias(count_alias)).orderBy(time_alias)


def recent(df: DataFrame, columns: dict[str, str], n: int = 50,
           ts_col: str = "event_timestamp", tie_col: str = "event_id") -> DataFrame:
    """G1: the ``n`` newest rows, newest first, ``tie_col`` ascending breaks ties.

    ``columns`` maps source column -> output alias; timestamps are emitted as
    TIMESTAMP_NTZ wall-clock values.
    """
    ordered = df.orderBy(F.col(ts_col).desc_nulls_last(), F.col(tie_col).asc_nulls_last()).limit(n)
    sel = []
    for src, alias in columns.items():
        c = F.col(src)
        if src == ts_col:
            c = wall_clock(c)
        sel.append(c.alias(alias))
    return ordered.select(*sel)


def long_form_counts(df: DataFrame, dims: list[str], total_label: str = "total") -> DataFrame:
    """``(dimension, value, n)`` for several dimensions in one pass.

    Uses GROUPING SETS, so the table is scanned once and partially aggregated
    per dimension in the same stage (an ``Expand`` node), instead of one scan
    per dimension unioned together.
    """
    sets = [[F.col(d)] for d in dims] + [[]]
    g = df.groupingSets(sets, *[F.col(d) for d in dims]).agg(
        F.count(F.lit(1)).alias("n"), *[F.grouping(d).alias(f"__g_{d}") for d in dims])
    dim_expr = None
    val_expr = None
    for d in dims:
        cond = F.col(f"__g_{d}") == 0
        dim_expr = F.when(cond, F.lit(d)) if dim_expr is None else dim_expr.when(cond, F.lit(d))
        val_expr = F.when(cond, F.col(d).cast("string")) if val_expr is None \
            else val_expr.when(cond, F.col(d).cast("string"))
    dim_expr = dim_expr.otherwise(F.lit(total_label))
    return g.select(dim_expr.alias("dimension"), val_expr.alias("value"), F.col("n"))

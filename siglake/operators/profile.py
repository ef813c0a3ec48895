"""Dataset profile (E11): row count, schema, per-column null counts, sample.

All column statistics come from ONE aggregation (a ``count(col)`` per column
next to ``count(*)``), unpivoted afterwards, instead of one job per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_profile(df: DataFrame) -> DataFrame:
    """``(column_name, non_null, nulls, rows)`` for every column, one pass."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count(F.col(f"`{c}`")).alias(f"__nn_{i}") for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    stacked = wide.select(
        F.col("__rows").alias("rows"),
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(f"__nn_{i}").alias("non_null"))
            for i, c in enumerate(cols)])).alias("s"))
    return stacked.select(
        F.col("s.column_name").alias("column_name"),
        F.col("s.non_null").alias("non_null"),
        (F.col("rows") - F.col("s.non_null")).alias("nulls"),
        F.col("rows"))


def profile(df: DataFrame, sample_rows: int = 20) -> dict:
    """Driver-side summary for a human: schema JSON, row count, a bounded sample.

    Only aggregates and ``sample_rows`` rows reach the driver.
    """
    stats = column_profile(df).collect()
    return {
        "rows": stats[0]["rows"] if stats else df.count(),
        "schema": df.schema.json(),
        "columns": [r.asDict() for r in stats],
        "sample": [r.asDict() for r in df.limit(sample_rows).collect()],
    }

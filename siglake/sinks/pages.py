"""Deep pages (G3): a table in page order, with the rank at which each of its parts starts.

    <index>/rows/__part=<k>/part-*.parquet     range partitions of the page order, newest first
    <index>/parts/                             (part, first, n): a row for each part

Page k reads only the parts that its ranks fall into, so no task holds ``offset + n``
rows, whatever the offset. An index is a snapshot; build a new one as the table grows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siglake.sinks import fs

ROWS_PER_PART = 1_000_000
_PART = "__part"


def _page_order(df: DataFrame, order_ts: str, tie: str) -> list[Column]:
    """Newest first, id descending; rows equal in both by a hash of all their columns, so ranges can split them."""
    rest = [f.name for f in df.schema.fields if f.name != _PART and not isinstance(f.dataType, T.MapType)]
    return [F.col(order_ts).desc_nulls_last(), F.col(tie).desc_nulls_last(), F.xxhash64(*sorted(rest)).asc()]


def build_page_index(df: DataFrame, path: str, order_ts: str = "created_at", tie: str = "id",
                     rows_per_part: int = ROWS_PER_PART) -> int:
    """Write the page index of ``df`` to the new folder ``path``; returns the number of rows.

    Rows without a time come last. ``df`` is read three times (count, ranges, rows):
    give a stored table, and only the columns that pages show. Rows equal in every
    column share a part. An empty table gives an index without rows.
    """
    spark, total = df.sparkSession, df.count()
    order = _page_order(df, order_ts, tie)
    ranged = df.repartitionByRange(max(1, -(-total // rows_per_part)), *order)
    staging = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    rows = ranged.withColumn(_PART, F.spark_partition_id())
    if total:
        rows.write.partitionBy(_PART).parquet(f"{staging}/rows")
    else:
        df.limit(0).withColumn(_PART, F.lit(0)).coalesce(1).write.parquet(f"{staging}/rows")
    sizes = spark.read.parquet(f"{staging}/rows").groupBy(F.col(_PART).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    # one task, a row for each part
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    (sizes.select("part", F.coalesce(before, F.lit(0)).cast("long").alias("first"), "n")
     .coalesce(1).write.parquet(f"{staging}/parts"))
    if not fs.publish(spark, staging, path):
        fs.delete(spark, staging)
        raise FileExistsError(path)
    return total


def read_page(spark: SparkSession, path: str, n: int, offset: int = 0, order_ts: str = "created_at",
              tie: str = "id") -> DataFrame:
    """Rows ``offset`` to ``offset + n`` of the page order (fewer at the end, none beyond it)."""
    rows = spark.read.parquet(f"{path.rstrip('/')}/rows")
    hit = (spark.read.parquet(f"{path.rstrip('/')}/parts")
           .where((F.col("first") < offset + n) & (F.col("first") + F.col("n") > offset))
           .collect())                                     # the parts of one page
    if not hit:
        return rows.limit(0).drop(_PART)
    rows = rows.where(F.col(_PART).isin([r["part"] for r in hit]))
    skip = offset - min(r["first"] for r in hit)
    return rows.orderBy(*_page_order(rows, order_ts, tie)).offset(skip).limit(n).drop(_PART)

"""Operational summaries.

Each summary is one aggregation pass (often GROUPING SETS or conditional
counts in a single ``agg``) or a bounded top-k; none collects rows to the
driver. Numbers the platform hard-coded (job history, top regions, fallback
ingestion counts) are computed from data instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siglake.functions.files import health_score
from siglake.functions.timeparse import event_date, wall_clock
from siglake.operators.aggregates import long_form_counts
from siglake.operators.reshape import fan_in
from siglake.schemas import SEVERITY_LEVELS, UPLOAD_TYPES


def audit_counts(audit: DataFrame) -> DataFrame:
    """E5: audit rows per source_type."""
    return audit.groupBy("source_type").agg(F.count(F.lit(1)).alias("count"))


def recent_rows(df: DataFrame, n: int, order_ts: str = "created_at", tie: str = "id",
                offset: int = 0, columns: list[str] | None = None, before: tuple | None = None) -> DataFrame:
    """Newest first, id descending as tie-break, optional page offset.

    An offset keeps ``offset + n`` rows in the last task; for deep pages pass
    ``before``, the (time, id) of the last row of the page before, instead.
    """
    if before is not None:
        when, last = F.lit(before[0]), F.lit(before[1])
        df = df.where((F.col(order_ts) < when) | ((F.col(order_ts) == when) & (F.col(tie) < last))
                      | F.col(order_ts).isNull())
    out = df.orderBy(F.col(order_ts).desc_nulls_last(), F.col(tie).desc_nulls_last())
    if offset:
        out = out.offset(offset)
    out = out.limit(n)
    return out.select(*columns) if columns else out


def severity_breakdown(t: DataFrame, extra_dims: dict[str, str] | None = None) -> DataFrame:
    """``(dimension, value, n)``: total, severity zero-filled over the five
    levels, and any extra dimensions (vendor for alarms).

    One GROUPING SETS pass produces every count; the zero rows come from a
    five-row literal unioned in and summed, so no join is needed.
    """
    dims = {"severity_clean": "severity", **(extra_dims or {"vendor": "vendor"})}
    lf = long_form_counts(t, list(dims))
    label = F.coalesce(
        F.create_map(*[F.lit(x) for kv in dims.items() for x in kv])[F.col("dimension")],
        F.col("dimension"))
    lf = lf.select(label.alias("dimension"), "value", "n")
    spark = t.sparkSession
    zeros = spark.createDataFrame([("severity", lvl, 0) for lvl in SEVERITY_LEVELS],
                                  "dimension string, value string, n long")
    return (lf.unionByName(zeros)
            .groupBy("dimension", "value").agg(F.sum("n").cast("long").alias("n")))


def ticket_breakdown(tickets: DataFrame) -> DataFrame:
    """Tickets by priority and by state (plus the total) in one pass."""
    return long_form_counts(tickets, ["priority", "state"])


def uploads_rollup(history: DataFrame) -> DataFrame:
    """Totals over the whole upload history, counts zero-filled per type.

    The per-type counts are conditional counts in the same ``agg``, so every
    type column exists even when zero. For the platform's newest-100 form, pass
    ``recent_rows(history, 100)``.
    """
    aggs = [
        F.count(F.lit(1)).alias("total_uploaded_files"),
        F.coalesce(F.sum(F.coalesce("file_size_bytes", F.lit(0))), F.lit(0)).cast("long")
        .alias("total_bytes_processed"),
        F.coalesce(F.sum(F.coalesce("records_count", F.lit(0))), F.lit(0)).cast("long")
        .alias("total_records_parsed"),
    ]
    aggs += [F.count(F.when(F.lower("file_type") == t, 1)).alias(f"uploads_{t}") for t in UPLOAD_TYPES]
    return history.agg(*aggs)


def performance_averages(perf: DataFrame) -> DataFrame:
    """Node count and rounded averages (Spark rounds HALF_UP)."""
    return perf.agg(
        F.count(F.lit(1)).alias("monitored_nodes_count"),
        F.round(F.avg("latency_ms"), 2).alias("average_latency_ms"),
        F.round(F.avg("packet_loss_pct"), 3).alias("average_packet_loss_pct"),
        F.round(F.avg("throughput_mbps"), 2).alias("average_throughput_mbps"),
    )


def with_health_score(perf: DataFrame) -> DataFrame:
    return perf.withColumn("health_score", health_score("packet_loss_pct", "latency_ms"))


def top_regions(perf: DataFrame, k: int = 2) -> DataFrame:
    """The ``k`` regions with the best average health score."""
    scored = with_health_score(perf)
    g = scored.groupBy("region").agg(F.avg("health_score").alias("__avg"))
    return (g.orderBy(F.col("__avg").desc(), F.col("region").asc_nulls_last()).limit(k)
            .select("region", F.round("__avg", 2).alias("avg_health_score")))


def ingestion_summary(channels: list[DataFrame]) -> DataFrame:
    """Rows ingested per channel plus the total (ROLLUP), one shuffle.

    Each input frame must carry a ``channel`` column; only that column is
    read, so the scans are pruned to nothing but row counts.
    """
    u = fan_in([c.select("channel") for c in channels])
    return (u.rollup("channel").agg(F.count(F.lit(1)).alias("events"))
            .select(F.coalesce("channel", F.lit("total")).alias("channel"), "events"))


def run_log(messages: DataFrame, job_name: str = "landing-clean") -> DataFrame:
    """Run log (I5 shape) derived from data: one run per (category, event_date)
    batch, FAILED when the batch contained rejected messages."""
    ts = F.col("event_timestamp")
    g = messages.groupBy("category", event_date(ts).alias("batch_date")).agg(
        F.min(ts).alias("started"), F.max(ts).alias("finished"),
        F.count(F.when(F.col("accepted"), 1)).alias("records_processed"),
        F.max(F.when(~F.col("accepted"), 1).otherwise(0)).alias("__failed"))
    return g.select(
        F.concat_ws("-", F.lit(job_name), "category", "batch_date").alias("run_id"),
        F.lit(job_name).alias("job_name"),
        F.when(F.col("__failed") == 1, F.lit("FAILED")).otherwise(F.lit("COMPLETED")).alias("status"),
        F.col("started").alias("started_at"),
        F.col("finished").alias("completed_at"),
        F.col("records_processed").cast("long").alias("records_processed"),
    )


def job_summary(runs: DataFrame, as_of=None) -> DataFrame:
    """Runs by status, active runs, the last 24 hours, records, average duration, last run.

    A run without an end is active. ``as_of`` (default: the newest end in the
    log) closes the 24-hour range.
    """
    dur = (F.unix_micros("completed_at") - F.unix_micros("started_at")) / F.lit(1_000_000.0)
    end = F.lit(as_of) if as_of is not None else runs.agg(F.max("completed_at")).scalar()
    runs = runs.withColumn("__day", F.col("completed_at") > end - F.expr("INTERVAL 24 HOURS"))

    def count(cond):
        return F.count(F.when(cond, 1))

    return runs.agg(
        F.count(F.lit(1)).alias("total_runs"),
        count(F.col("status") == "COMPLETED").alias("completed_runs"),
        count(F.col("status") == "FAILED").alias("failed_runs"),
        F.coalesce(F.sum("records_processed"), F.lit(0)).cast("long").alias("records_processed"),
        F.round(F.avg(dur), 2).alias("avg_duration_seconds"),
        wall_clock(F.max("completed_at")).alias("last_completed_at"),
        count(F.col("completed_at").isNull()).alias("active_runs"),
        count(F.col("__day") & (F.col("status") == "COMPLETED")).alias("completed_24h"),
        count(F.col("__day") & (F.col("status") == "FAILED")).alias("failed_24h"),
        F.max_by("status", F.when(F.col("completed_at").isNotNull(), F.struct("completed_at", "run_id")))
        .alias("last_status"),
    )


def with_sample(summary: DataFrame, rows: DataFrame, n: int = 10, order_ts: str = "event_timestamp",
                tie: str = "event_id", columns: list[str] | None = None) -> DataFrame:
    """A one-row summary with ``sample``, its ``n`` newest rows as an array of structs.

    The sample is a top-k, so only ``n`` rows meet in one task.
    """
    top = recent_rows(rows, n, order_ts=order_ts, tie=tie, columns=columns)
    sample = top.agg(F.collect_list(F.struct(*top.columns)).alias("sample"))
    return summary.withColumn("sample", sample.scalar())


def service_counters(messages: DataFrame, uploads: DataFrame) -> DataFrame:
    """E13 (re-aimed): ``(counter, value)`` - events processed, REST records
    collected, files uploaded - from the message and upload tables instead
    of process-global counters. One scan of each input: every message row
    emits the counters it contributes to, then one grouped count.
    """
    ok = F.col("source").isNotNull() & F.col("node_id").isNotNull()
    tags = F.array_compact(F.array(
        F.when(ok, F.lit("events_processed")),
        F.when(ok & (F.col("channel") == "rest"), F.lit("rest_records_collected"))))
    m = messages.select(F.explode(tags).alias("counter"))
    u = uploads.where(F.col("status") == "SUCCESS").select(F.lit("files_uploaded").alias("counter"))
    return fan_in([m, u]).groupBy("counter").agg(F.count(F.lit(1)).alias("value"))

"""Named operator queries over the driver tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame; the
matching SQL lives in ``siglake.plans.oracle_ops``. Every query reads whole
tables (and whole document texts); the only limits are the operators' own
(top-k panels, a cap per group that a caller asks for, a history page).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siglake.functions.files import content_type_of, file_type_of, health_score, sha256_hex, source_slug
from siglake.functions.routing import category_route
from siglake.functions.severity import connector_severity, lake_severity
from siglake.functions.timeparse import wall_clock
from siglake.operators import summaries
from siglake.operators.aggregates import count_by
from siglake.operators.dedup import dedup_latest
from siglake.operators.normalize import apply_event_defaults, clean_events, resolve_lenient, upload_events
from siglake.operators.profile import column_profile
from siglake.operators.reshape import fan_in
from siglake.operators.validate import accepted, cap_per_group, lookup_by_id, quarantine, validate_events
from siglake.plans import serving
from siglake.sources import driver
from siglake.sources.kafka import decode_messages

LOOKUP_ID = 42
CAP_EXAMPLE = 500      # the platform's own bound on records per upload; no job applies one by itself
UPLOADS_PAGE_OFFSET = 50
UPLOADS_DEEP_OFFSET = 150
UPLOADS_PAGE_SIZE = 50
RECENT_AUDIT_ROWS = 50


def _raw_severities(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = driver.producer_events(spark, sf_dir).select(F.col("severity").alias("raw_severity"))
    t = driver.ticket_records(spark, sf_dir).select(F.col("priority").alias("raw_severity"))
    return fan_in([p, t])


def q_severity_clean(spark, sf_dir):
    """C1 over every raw severity label; grouped first, rule applied per group."""
    g = _raw_severities(spark, sf_dir).groupBy("raw_severity").agg(F.count(F.lit(1)).alias("n"))
    return g.select("raw_severity", lake_severity("raw_severity").alias("severity_clean"), "n")


def q_severity_connector(spark, sf_dir):
    """C2 over the same labels (distinct from C1 on CRIT/MAJ/MIN/WARN fragments)."""
    g = _raw_severities(spark, sf_dir).groupBy("raw_severity").agg(F.count(F.lit(1)).alias("n"))
    return g.select("raw_severity", connector_severity("raw_severity").alias("severity"), "n")


def q_event_time_resolve(spark, sf_dir):
    """ISO-8601 text stamps (producer) and typed created_at (tickets)."""
    p = driver.producer_events(spark, sf_dir)
    iso = p.select("event_id", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
                   .alias("timestamp"))
    tickets = driver.ticket_records(spark, sf_dir).select(
        F.col("ticket_id").alias("event_id"), "created_at")
    a = clean_events(iso, bindings={}).select("event_id", "event_timestamp")
    b = clean_events(tickets, bindings={}).select("event_id", "event_timestamp")
    return fan_in([a, b]).select("event_id", wall_clock("event_timestamp").alias("event_timestamp"))


def q_event_date(spark, sf_dir):
    """C4: messages per event_date."""
    c = clean_events(driver.kafka_messages(spark, sf_dir), bindings={})
    return count_by(c, "event_date", "event_date", "n")


def q_payload_json_extract(spark, sf_dir):
    """Attributes bound from the JSON payload of producer messages."""
    c = clean_events(driver.producer_events(spark, sf_dir))
    return c.groupBy("vendor", "site_name", "device_name", "ticket_id").agg(F.count(F.lit(1)).alias("n"))


def q_connector_normalize(spark, sf_dir):
    """REST tickets and metrics in the unified shape."""
    m = driver.connector_messages(spark, sf_dir)
    return m.select("event_id", "source", "event_type", "severity", "node_id", "region",
                    wall_clock("timestamp").alias("event_timestamp"))


def q_category_route(spark, sf_dir):
    """Accepted messages per (channel, topic, category)."""
    r = serving.routed_messages(driver.kafka_messages(spark, sf_dir))
    return r.groupBy("channel", "topic", "category").agg(F.count(F.lit(1)).alias("n"))


def q_source_slug(spark, sf_dir):
    """Source slugs of every message."""
    m = driver.kafka_messages(spark, sf_dir)
    g = m.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return g.select("source", source_slug("source").alias("source_slug"), "n")


def q_sha256(spark, sf_dir):
    """C17: SHA-256 of every whole document text."""
    d = driver.table(spark, sf_dir, "documents")
    return d.select("doc_id", sha256_hex("text").alias("sha256"))


def _url_file_names(spark, sf_dir) -> DataFrame:
    pages = driver.table(spark, sf_dir, "pages")
    return pages.select(F.regexp_extract("url", r"/([^/?#]*)([?#].*)?$", 1).alias("filename"))


def q_file_type_classify(spark, sf_dir):
    """Upload file names plus file names taken from page URLs."""
    uploads = driver.uploaded_files(spark, sf_dir).select("filename")
    names = fan_in([uploads, _url_file_names(spark, sf_dir)])
    typed = names.select(file_type_of("filename").alias("file_type"))
    g = typed.groupBy("file_type").agg(F.count(F.lit(1)).alias("n"))
    return g.select("file_type", content_type_of("file_type").alias("content_type"), "n")


def q_health_score(spark, sf_dir):
    """Distribution of the node health score."""
    perf = driver.performance_records(spark, sf_dir)
    return count_by(perf.select(health_score("packet_loss_pct", "latency_ms").alias("health_score")),
                    "health_score", "health_score", "n")


def q_validate_events(spark, sf_dir):
    """D1 (+C23 domains): strict / lenient / accepted counts."""
    v = validate_events(driver.kafka_messages(spark, sf_dir))
    return v.groupBy("channel", "source", "is_strict", "is_lenient", "accepted") \
        .agg(F.count(F.lit(1)).alias("n"))


def q_quarantine_events(spark, sf_dir):
    """Rejected messages with their reasons."""
    q = quarantine(driver.kafka_messages(spark, sf_dir))
    return q.select("event_id", "topic", "reject_reason")


def q_cap_per_group(spark, sf_dir):
    """At most 500 published records per uploaded file (dense index -> filter)."""
    recs = driver.upload_records(spark, sf_dir)
    capped = cap_per_group(recs, ["id"], "row_idx", CAP_EXAMPLE, dense_index=True)
    return capped.select("id", "row_idx", "record")


def q_lookup_by_id(spark, sf_dir):
    """One upload-history row by id."""
    return lookup_by_id(driver.upload_history(spark, sf_dir), "id", LOOKUP_ID)


def q_audit_counts(spark, sf_dir):
    return summaries.audit_counts(driver.audit_log(spark, sf_dir))


def q_severity_zero_filled(spark, sf_dir):
    """Alarm breakdown - total, severity zero-filled, vendor."""
    t = serving.serving_table(spark, sf_dir, "alarms", columns=["severity_clean", "vendor"])
    return summaries.severity_breakdown(t)


def q_tickets_breakdown(spark, sf_dir):
    """Polled tickets by priority and by state."""
    return summaries.ticket_breakdown(driver.ticket_records(spark, sf_dir))


def q_uploads_rollup(spark, sf_dir):
    return summaries.uploads_rollup(driver.upload_history(spark, sf_dir))


def q_performance_avgs(spark, sf_dir):
    return summaries.performance_averages(driver.performance_records(spark, sf_dir))


def q_ingestion_summary(spark, sf_dir):
    """Messages per channel (kafka, rest) and uploaded files, with the total."""
    files = driver.upload_history(spark, sf_dir).select(F.lit("file").alias("channel"))
    return summaries.ingestion_summary([driver.producer_events(spark, sf_dir),
                                        driver.connector_messages(spark, sf_dir), files])


def q_profile(spark, sf_dir):
    """Per-column null profile of the landed events table."""
    return column_profile(driver.table(spark, sf_dir, "events"))


def q_job_summary(spark, sf_dir):
    """Job summary over the run log derived from every received message."""
    m = validate_events(driver.kafka_messages(spark, sf_dir))
    m = m.withColumns({
        "category": category_route(topic="topic"),
        "event_timestamp": F.col("timestamp"),
    })
    return summaries.job_summary(summaries.run_log(m))


def q_service_counters(spark, sf_dir):
    """Service counters from the message and upload tables."""
    return summaries.service_counters(driver.kafka_messages(spark, sf_dir),
                                      driver.upload_history(spark, sf_dir))


def q_top_regions(spark, sf_dir):
    return summaries.top_regions(driver.performance_records(spark, sf_dir))


def q_dedup_latest(spark, sf_dir):
    """newest record per metric id over the metric feed (real repeats)."""
    perf = driver.performance_records(spark, sf_dir).select(
        "metric_id", "device_id", "region", "timestamp", "latency_ms", "throughput_mbps")
    d = dedup_latest(perf, key="metric_id", order_by=("timestamp",))
    return d.select("metric_id", "device_id", "region", "timestamp", "latency_ms", "throughput_mbps")


def legacy_alarm_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed whose id column varies per row: alarm_id for click/error,
    ticket_id for signup, no id at all for the rest."""
    p = driver.producer_events(spark, sf_dir)
    return p.select(
        F.when(F.col("event_type").isin("click", "error"),
               F.concat(F.lit("ALM-"), F.col("node_id"))).alias("alarm_id"),
        F.when(F.col("event_type") == "signup",
               F.concat(F.lit("INC"), F.col("event_id"))).alias("ticket_id"),
        "timestamp", "severity", "node_id")


def q_dedup_null_safe(spark, sf_dir):
    """per-row id choice; rows without any id are all kept."""
    c = clean_events(legacy_alarm_feed(spark, sf_dir), bindings={})
    c = c.select("alarm_id", "ticket_id", "node_id", "severity_clean", "event_timestamp")
    d = dedup_latest(c)
    return d.select("alarm_id", "ticket_id", "node_id", "severity_clean",
                    wall_clock("event_timestamp").alias("event_timestamp"))


def upload_event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C14: upload events for every record of every parsed file."""
    recs = driver.upload_records(spark, sf_dir)
    recs = recs.withColumn("line", F.col("record"))
    return upload_events(recs, F.col("file_type"), F.col("sha256"), F.col("created_at"),
                         F.col("filename"), F.col("row_idx"), ["line"])


def q_upload_events(spark, sf_dir):
    """C14: the id, source and file of every upload event."""
    return upload_event_feed(spark, sf_dir).select("event_id", "source", "severity", "filename", "payload")


def q_lenient_messages(spark, sf_dir):
    """A7 + C3 + C9 + C23: messages with fields outside the unified eight keep id, time and vendor."""
    raw = driver.lenient_records(spark, sf_dir)
    ok = resolve_lenient(accepted(decode_messages(raw)))
    c = clean_events(apply_event_defaults(ok, now=F.lit("1970-01-01T00:00:00Z").cast("timestamp")))
    return c.select("event_id", "source", "node_id", "vendor", "severity_clean",
                    wall_clock("event_timestamp").alias("event_timestamp"))


def q_fan_in_union(spark, sf_dir):
    """producer messages and upload events unioned by name (missing -> NULL)."""
    u = fan_in([driver.producer_events(spark, sf_dir), upload_event_feed(spark, sf_dir)])
    return u.groupBy("source", "event_type", "topic").agg(F.count(F.lit(1)).alias("n"))


def q_recent_audit(spark, sf_dir):
    cols = ["id", "source_type", "source_name", "status", "payload_size_bytes", "records_count",
            "created_at"]
    docs = driver.newest_documents(spark, sf_dir, RECENT_AUDIT_ROWS)
    return summaries.recent_rows(driver.audit_log(spark, sf_dir, docs), RECENT_AUDIT_ROWS, columns=cols)


def q_uploads_page(spark, sf_dir):
    cols = ["id", "filename", "file_type", "file_size_bytes", "minio_path", "kafka_topic",
            "records_count", "status", "created_at"]
    docs = driver.newest_documents(spark, sf_dir, UPLOADS_PAGE_SIZE, UPLOADS_PAGE_OFFSET)
    return summaries.recent_rows(driver.upload_history(spark, sf_dir, docs), UPLOADS_PAGE_SIZE, columns=cols)


def q_uploads_deep_page(spark, sf_dir):
    """A page further down the history, by the page index of its ids."""
    cols = ["id", "filename", "file_type", "file_size_bytes", "minio_path", "kafka_topic",
            "records_count", "status", "created_at"]
    docs = driver.deep_documents(spark, sf_dir, UPLOADS_PAGE_SIZE, UPLOADS_DEEP_OFFSET)
    return summaries.recent_rows(driver.upload_history(spark, sf_dir, docs), UPLOADS_PAGE_SIZE, columns=cols)


def operator_queries():
    return {
        "severity_clean": q_severity_clean,
        "severity_connector": q_severity_connector,
        "event_time_resolve": q_event_time_resolve,
        "event_date": q_event_date,
        "payload_json_extract": q_payload_json_extract,
        "connector_normalize": q_connector_normalize,
        "category_route": q_category_route,
        "source_slug": q_source_slug,
        "sha256": q_sha256,
        "file_type_classify": q_file_type_classify,
        "health_score": q_health_score,
        "validate_events": q_validate_events,
        "quarantine_events": q_quarantine_events,
        "cap_per_group": q_cap_per_group,
        "lookup_by_id": q_lookup_by_id,
        "audit_counts": q_audit_counts,
        "severity_zero_filled": q_severity_zero_filled,
        "tickets_breakdown": q_tickets_breakdown,
        "uploads_rollup": q_uploads_rollup,
        "performance_avgs": q_performance_avgs,
        "ingestion_summary": q_ingestion_summary,
        "profile": q_profile,
        "job_summary": q_job_summary,
        "service_counters": q_service_counters,
        "top_regions": q_top_regions,
        "dedup_latest": q_dedup_latest,
        "dedup_null_safe": q_dedup_null_safe,
        "upload_events": q_upload_events,
        "lenient_messages": q_lenient_messages,
        "fan_in_union": q_fan_in_union,
        "recent_audit": q_recent_audit,
        "uploads_page": q_uploads_page,
        "uploads_deep_page": q_uploads_deep_page,
    }

"""Explicit schemas and fixed value domains.

Every reader is given one of these schemas; nothing is inferred at stream
start, so an empty or missing directory cannot change a table's shape.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the platform's domains for identical results)
# ---------------------------------------------------------------------------
SEVERITY_LEVELS = ["CRITICAL", "MAJOR", "MINOR", "WARNING", "INFO"]
SOURCE_DOMAIN = ["Comarch OSS", "Alarm Events", "Ticket Events"]
UPLOAD_TYPES = ["csv", "excel", "json", "pdf"]
FILE_EXTENSIONS = {".csv": "csv", ".json": "json", ".xlsx": "excel", ".xls": "excel", ".pdf": "pdf"}
CONTENT_TYPES = {
    "csv": "text/csv",
    "json": "application/json",
    "excel": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "pdf": "application/pdf",
}
TIMESTAMP_CANDIDATES = ["timestamp", "created_at", "event_time", "time"]
ID_CANDIDATES = ["event_id", "alarm_id", "ticket_id", "metric_id"]
PAYLOAD_BINDINGS = {
    "vendor": ["vendor", "vendor_name", "vendorName", "manufacturer"],
    "site_name": ["site_name", "siteName", "site_id", "siteId"],
    "device_name": ["device_name", "deviceName", "device_id", "deviceId", "node_name"],
    "ticket_id": ["ticket_id", "ticketId", "inc_id", "incident_id"],
}
# Kafka topic -> landing category (the catch-all topic "telecom-events" is not mapped).
TOPIC_CATEGORIES = {
    "telecom-alarms": "alarms",
    "tickets": "tickets",
    "network-events": "network",
    "security-events": "security",
    "performance": "performance",
}
# Landing category -> serving table.
CATEGORY_TABLES = {
    "alarms": "alarms",
    "tickets": "tickets",
    "network": "network_events",
    "security": "security_events",
    "performance": "performance_metrics",
}
# Connector endpoint category -> topic it publishes to.
CONNECTOR_TOPICS = {
    "alarm": "telecom-alarms",
    "ticket": "tickets",
    "network": "network-events",
    "security": "security-events",
    "performance": "performance",
}
UNROUTED_CATEGORY = "unrouted"
CONNECTOR_DEFAULT_REGION = "SA-RIYADH"
CONNECTOR_DEFAULT_NODE = "NODE-GENERIC"

# ---------------------------------------------------------------------------
# Record schemas
# ---------------------------------------------------------------------------
S = T.StringType()

UNIFIED_EVENT = T.StructType([
    T.StructField("event_id", S),
    T.StructField("source", S),
    T.StructField("event_type", S),
    T.StructField("timestamp", S),
    T.StructField("severity", S),
    T.StructField("node_id", S),
    T.StructField("region", S),
    T.StructField("payload", S),  # raw JSON text: the reader keeps nested objects as text
])

REST_ENVELOPE = T.StructType([
    T.StructField("target_system", S),
    T.StructField("url", S),
    T.StructField("pages_fetched", T.IntegerType()),
    T.StructField("total_records", T.IntegerType()),
    T.StructField("collected_at_utc", S),
    T.StructField("data", T.ArrayType(S)),
])

CANONICAL_EVENT = T.StructType([
    T.StructField("event_id", S),
    T.StructField("source", S),
    T.StructField("event_type", S),
    T.StructField("severity", S),
    T.StructField("node_id", S),
    T.StructField("region", S),
    T.StructField("filename", S),
    T.StructField("payload", S),
    T.StructField("severity_clean", S),
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("event_date", S),
    T.StructField("vendor", S),
    T.StructField("site_name", S),
    T.StructField("device_name", S),
    T.StructField("ticket_id", S),
    T.StructField("category", S),
    T.StructField("ingest_file", S),
])

RUN_LOG = T.StructType([
    T.StructField("run_id", S),
    T.StructField("job_name", S),
    T.StructField("status", S),
    T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("completed_at", T.TimestampNTZType()),
    T.StructField("records_processed", T.LongType()),
    T.StructField("error", S),
])


def canonical_columns() -> list[str]:
    return [f.name for f in CANONICAL_EVENT.fields]

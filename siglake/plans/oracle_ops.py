"""Reference SQL (DuckDB) for the operator queries in ``siglake.plans.queries``."""

from __future__ import annotations

from siglake.plans.oracle import (BASE, MESSAGES, PERF_RECORDS, PRODUCER, REST_PERF, REST_TICKETS,
                                  ROUTED_ALL, connector_sev, lake_sev, table_cte)

SEVERITY_DOMAIN = "('CRITICAL', 'MAJOR', 'MINOR', 'WARNING', 'INFO')"
SOURCE_DOMAIN = "('Comarch OSS', 'Alarm Events', 'Ticket Events')"

MSG = ",".join([PRODUCER, REST_TICKETS, PERF_RECORDS, REST_PERF, MESSAGES])

FILES = """
files AS (
  SELECT doc_id AS id,
         'doc_' || CAST(doc_id AS VARCHAR) ||
           CASE lang WHEN 'en' THEN '.csv' WHEN 'fr' THEN '.json' WHEN 'de' THEN '.xlsx'
                     WHEN 'es' THEN '.pdf' ELSE '.txt' END AS filename,
         CASE lang WHEN 'en' THEN 'csv' WHEN 'fr' THEN 'json' WHEN 'de' THEN 'excel'
                   WHEN 'es' THEN 'pdf' END AS file_type,
         CAST(strlen(text) AS BIGINT) AS file_size_bytes,
         text AS content, source, lang,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) AS created_at
  FROM documents
)"""

HISTORY = """
hist0 AS (
  SELECT *,
         (file_type IS NOT NULL AND file_size_bytes > 0) AS ok,
         CASE WHEN file_type IN ('csv', 'json', 'excel')
                THEN coalesce(len(string_split(content, chr(10))), 0)
              WHEN file_type = 'pdf' THEN 1 ELSE 0 END AS recs
  FROM files
),
hist AS (
  SELECT id, filename,
         coalesce(file_type, 'unsupported') AS file_type,
         file_size_bytes,
         'raw/uploads/' || coalesce(file_type, 'rejected') || '/' || filename AS minio_path,
         CASE WHEN ok AND file_type IN ('csv', 'json', 'excel') AND recs > 0
              THEN 'network-events' END AS kafka_topic,
         CAST(CASE WHEN ok THEN recs ELSE 0 END AS BIGINT) AS records_count,
         CASE WHEN ok THEN 'SUCCESS' ELSE 'FAILED' END AS status,
         CASE WHEN NOT coalesce(ok, false) THEN 'unsupported or empty file' END AS error_message,
         json_object('sha256_hash', sha256(content), 'lang', lang, 'source', source)::VARCHAR
           AS metadata_json,
         created_at
  FROM hist0
)"""

AUDIT = """
audit AS (
  SELECT doc_id AS id, source AS source_type, 'doc_' || CAST(doc_id AS VARCHAR) AS source_name,
         CASE WHEN n_chars > 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
         CAST(n_chars AS BIGINT) AS payload_size_bytes,
         CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS records_count,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) AS created_at
  FROM documents
)"""

LINES = """
recs AS (
  SELECT id, filename, file_type, created_at, sha256(content) AS sha256,
         string_split(content, chr(10)) AS parts
  FROM files WHERE file_type IN ('csv', 'json', 'excel')
),
lines AS (
  SELECT id, filename, file_type, created_at, sha256,
         CAST(i - 1 AS INTEGER) AS row_idx, parts[i] AS record
  FROM recs, range(1, len(parts) + 1) r(i)
)"""

HEALTH = "GREATEST(0, LEAST(100, CAST(trunc(100.0 - packet_loss_pct * 15 - latency_ms / 5) AS INTEGER)))"


def _w(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def operator_sql() -> dict[str, str]:
    raw_sev = ("raw AS (SELECT severity AS raw_severity FROM producer "
               "UNION ALL SELECT o_orderpriority FROM orders)")
    file_type_case = (
        "CASE WHEN contains(filename, '.') THEN "
        "CASE '.' || lower(regexp_extract(filename, '\\.([^.]*)$', 1)) "
        "WHEN '.csv' THEN 'csv' WHEN '.json' THEN 'json' WHEN '.xlsx' THEN 'excel' "
        "WHEN '.xls' THEN 'excel' WHEN '.pdf' THEN 'pdf' END END")
    content_type_case = (
        "CASE file_type WHEN 'csv' THEN 'text/csv' WHEN 'json' THEN 'application/json' "
        "WHEN 'excel' THEN 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet' "
        "WHEN 'pdf' THEN 'application/pdf' ELSE 'application/octet-stream' END")
    strict = (f"(event_id IS NOT NULL AND source IS NOT NULL AND event_type IS NOT NULL "
              f"AND node_id IS NOT NULL AND source IN {SOURCE_DOMAIN} "
              f"AND (severity IS NULL OR severity IN {SEVERITY_DOMAIN}))")
    lenient = "(source IS NOT NULL AND node_id IS NOT NULL)"
    legacy = f"""
feed AS (
  SELECT CASE WHEN event_type IN ('click', 'error') THEN 'ALM-' || node_id END AS alarm_id,
         CASE WHEN event_type = 'signup' THEN 'INC' || event_id END AS ticket_id,
         node_id, {lake_sev('severity')} AS severity_clean, ts AS event_timestamp
  FROM producer
),
keyed AS (SELECT *, coalesce(nullif(alarm_id, ''), nullif(ticket_id, '')) AS k FROM feed)"""

    return {
        "severity_clean": _w(PRODUCER, raw_sev) + (
            f"SELECT raw_severity, {lake_sev('raw_severity')} AS severity_clean, COUNT(*) AS n "
            "FROM raw GROUP BY 1, 2"),
        "severity_connector": _w(PRODUCER, raw_sev) + (
            f"SELECT raw_severity, {connector_sev('raw_severity')} AS severity, COUNT(*) AS n "
            "FROM raw GROUP BY 1, 2"),
        "event_time_resolve": (
            "SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS event_timestamp FROM events "
            "UNION ALL SELECT 'INC' || CAST(o_orderkey AS VARCHAR), o_orderdate FROM orders"),
        "event_date": _w(MSG) + (
            "SELECT strftime(ts, '%Y-%m-%d') AS event_date, COUNT(*) AS n FROM messages GROUP BY 1"),
        "payload_json_extract": _w(PRODUCER) + (
            "SELECT vendor, site_name, device_name, ticket_id, COUNT(*) AS n FROM producer "
            "GROUP BY 1, 2, 3, 4"),
        "connector_normalize": _w(REST_TICKETS, PERF_RECORDS, REST_PERF) + (
            "SELECT event_id, source, event_type, severity, node_id, region, ts AS event_timestamp "
            "FROM rest_tickets UNION ALL "
            "SELECT event_id, source, event_type, severity, node_id, region, ts FROM rest_perf"),
        "category_route": "WITH " + BASE + (
            "\nSELECT channel, topic, category, COUNT(*) AS n FROM routed GROUP BY 1, 2, 3"),
        "source_slug": _w(MSG) + (
            "SELECT source, lower(replace(source, ' ', '_')) AS source_slug, COUNT(*) AS n "
            "FROM messages GROUP BY 1, 2"),
        "sha256": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
        "file_type_classify": (
            "WITH names AS ("
            "SELECT 'doc_' || CAST(doc_id AS VARCHAR) || CASE lang WHEN 'en' THEN '.csv' "
            "WHEN 'fr' THEN '.json' WHEN 'de' THEN '.xlsx' WHEN 'es' THEN '.pdf' ELSE '.txt' END "
            "AS filename FROM documents "
            "UNION ALL SELECT regexp_extract(url, '/([^/?#]*)([?#].*)?$', 1) FROM pages), "
            f"typed AS (SELECT {file_type_case} AS file_type FROM names) "
            f"SELECT file_type, {content_type_case} AS content_type, COUNT(*) AS n "
            "FROM typed GROUP BY 1, 2"),
        "health_score": _w(PERF_RECORDS) + (
            f"SELECT {HEALTH} AS health_score, COUNT(*) AS n FROM perf_records GROUP BY 1"),
        "validate_events": _w(MSG) + (
            f"SELECT channel, source, {strict} AS is_strict, {lenient} AS is_lenient, "
            f"({strict} OR {lenient}) AS accepted, COUNT(*) AS n FROM messages GROUP BY 1, 2, 3, 4, 5"),
        "quarantine_events": _w(MSG) + (
            "SELECT event_id, topic, concat_ws('; ', "
            "CASE WHEN event_id IS NULL THEN 'missing event_id' END, "
            "CASE WHEN source IS NULL THEN 'missing source' END, "
            "CASE WHEN event_type IS NULL THEN 'missing event_type' END, "
            "CASE WHEN node_id IS NULL THEN 'missing node_id' END, "
            f"CASE WHEN source IS NOT NULL AND source NOT IN {SOURCE_DOMAIN} "
            "THEN 'source not in domain' END, "
            f"CASE WHEN severity IS NOT NULL AND severity NOT IN {SEVERITY_DOMAIN} "
            "THEN 'severity not in domain' END) AS reject_reason "
            f"FROM messages WHERE NOT ({strict} OR {lenient})"),
        "cap_per_group": _w(FILES, LINES) + "SELECT id, row_idx, record FROM lines WHERE row_idx < 500",
        "lookup_by_id": _w(FILES, HISTORY) + "SELECT * FROM hist WHERE id = 42",
        "audit_counts": _w(AUDIT) + "SELECT source_type, COUNT(*) AS count FROM audit GROUP BY 1",
        "severity_zero_filled": "WITH " + BASE + "," + table_cte("t", "alarms") + """
SELECT 'total' AS dimension, CAST(NULL AS VARCHAR) AS value, COUNT(*) AS n FROM t
UNION ALL
SELECT 'severity', l.level, coalesce(c.n, 0)
FROM (VALUES ('CRITICAL'), ('MAJOR'), ('MINOR'), ('WARNING'), ('INFO')) l(level)
LEFT JOIN (SELECT severity_clean, COUNT(*) AS n FROM t GROUP BY 1) c ON c.severity_clean = l.level
UNION ALL
SELECT 'vendor', vendor, COUNT(*) FROM t GROUP BY vendor""",
        "tickets_breakdown": (
            "SELECT 'priority' AS dimension, o_orderpriority AS value, COUNT(*) AS n "
            "FROM orders GROUP BY 2 "
            "UNION ALL SELECT 'state', o_orderstatus, COUNT(*) FROM orders GROUP BY 2 "
            "UNION ALL SELECT 'total', NULL, COUNT(*) FROM orders"),
        "uploads_rollup": _w(FILES, HISTORY) + """
SELECT COUNT(*) AS total_uploaded_files,
       CAST(coalesce(sum(coalesce(file_size_bytes, 0)), 0) AS BIGINT) AS total_bytes_processed,
       CAST(coalesce(sum(coalesce(records_count, 0)), 0) AS BIGINT) AS total_records_parsed,
       count_if(lower(file_type) = 'csv') AS uploads_csv,
       count_if(lower(file_type) = 'excel') AS uploads_excel,
       count_if(lower(file_type) = 'json') AS uploads_json,
       count_if(lower(file_type) = 'pdf') AS uploads_pdf
FROM hist""",
        "performance_avgs": _w(PERF_RECORDS) + (
            "SELECT COUNT(*) AS monitored_nodes_count, "
            "round(avg(latency_ms), 2) AS average_latency_ms, "
            "round(avg(packet_loss_pct), 3) AS average_packet_loss_pct, "
            "round(avg(throughput_mbps), 2) AS average_throughput_mbps FROM perf_records"),
        "ingestion_summary": (
            "WITH c AS (SELECT 'kafka' AS channel FROM events "
            "UNION ALL SELECT 'rest' FROM orders UNION ALL SELECT 'rest' FROM lineitem "
            "UNION ALL SELECT 'file' FROM documents) "
            "SELECT channel, COUNT(*) AS events FROM c GROUP BY 1 "
            "UNION ALL SELECT 'total', COUNT(*) FROM c"),
        "profile": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, COUNT({c}) AS non_null, COUNT(*) - COUNT({c}) AS nulls, "
            f"COUNT(*) AS rows FROM events"
            for c in ["event_id", "ts", "user_id", "event_type", "value", "props"]),
        "job_summary": _w(MSG, ROUTED_ALL) + """
, runs AS (
  SELECT category, strftime(ts, '%Y-%m-%d') AS batch_date,
         min(ts) AS started, max(ts) AS finished,
         count_if(accepted) AS recs,
         max(CASE WHEN NOT accepted THEN 1 ELSE 0 END) AS failed
  FROM routed_all GROUP BY 1, 2
)
SELECT COUNT(*) AS total_runs,
       count_if(failed = 0) AS completed_runs,
       count_if(failed = 1) AS failed_runs,
       CAST(coalesce(sum(recs), 0) AS BIGINT) AS records_processed,
       round(avg(CAST(epoch_us(finished) - epoch_us(started) AS DOUBLE) / 1000000.0), 2)
         AS avg_duration_seconds,
       max(finished) AS last_completed_at,
       0 AS active_runs,
       count_if(failed = 0 AND finished > (SELECT max(finished) FROM runs) - INTERVAL 24 HOURS) AS completed_24h,
       count_if(failed = 1 AND finished > (SELECT max(finished) FROM runs) - INTERVAL 24 HOURS) AS failed_24h,
       arg_max(CASE WHEN failed = 1 THEN 'FAILED' ELSE 'COMPLETED' END,
               (finished, 'landing-clean-' || category || '-' || batch_date)) AS last_status
FROM runs""",
        "service_counters": _w(MSG, FILES, HISTORY) + """
SELECT 'events_processed' AS counter, COUNT(*) AS value FROM messages
  WHERE source IS NOT NULL AND node_id IS NOT NULL
UNION ALL
SELECT 'rest_records_collected', COUNT(*) FROM messages
  WHERE source IS NOT NULL AND node_id IS NOT NULL AND channel = 'rest'
UNION ALL
SELECT 'files_uploaded', COUNT(*) FROM hist WHERE status = 'SUCCESS'""",
        "top_regions": _w(PERF_RECORDS) + (
            f"SELECT region, round(avg(h), 2) AS avg_health_score FROM "
            f"(SELECT region, {HEALTH} AS h FROM perf_records) GROUP BY region "
            "ORDER BY avg(h) DESC, region ASC NULLS LAST LIMIT 2"),
        "dedup_latest": _w(PERF_RECORDS) + (
            "SELECT metric_id, device_id, region, ts AS timestamp, latency_ms, throughput_mbps "
            "FROM perf_records QUALIFY row_number() OVER (PARTITION BY metric_id ORDER BY "
            "ts DESC NULLS LAST, metric_id DESC NULLS LAST, device_id DESC NULLS LAST, "
            "region DESC NULLS LAST, latency_ms DESC NULLS LAST, throughput_mbps DESC NULLS LAST) = 1"),
        "dedup_null_safe": _w(PRODUCER, legacy) + """
(SELECT alarm_id, ticket_id, node_id, severity_clean, event_timestamp FROM keyed
 WHERE k IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY k ORDER BY event_timestamp DESC NULLS LAST,
   alarm_id DESC NULLS LAST, ticket_id DESC NULLS LAST, node_id DESC NULLS LAST,
   severity_clean DESC NULLS LAST) = 1)
UNION ALL
(SELECT alarm_id, ticket_id, node_id, severity_clean, event_timestamp FROM keyed WHERE k IS NULL)""",
        "upload_events": _w(FILES, LINES) + """
SELECT 'UPLOAD-' || sha256(sha256 || chr(10) || filename) || '-' || CAST(row_idx AS VARCHAR) AS event_id,
       'UPLOAD_' || upper(file_type) AS source, 'INFO' AS severity, filename,
       json_object('line', record)::VARCHAR AS payload
FROM lines""",
        "lenient_messages": _w(PRODUCER) + f"""
SELECT CASE WHEN CAST(event_id AS BIGINT) % 3 = 0 THEN 'ALM-' || event_id ELSE event_id END AS event_id,
       source, node_id, vendor,
       CASE WHEN CAST(event_id AS BIGINT) % 3 = 0 THEN 'INFO' ELSE {lake_sev('severity')} END AS severity_clean,
       ts AS event_timestamp
FROM producer WHERE source IS NOT NULL AND node_id IS NOT NULL""",
        "fan_in_union": _w(PRODUCER, FILES, LINES) + """
, u AS (
  SELECT source, event_type, topic FROM producer
  UNION ALL
  SELECT 'UPLOAD_' || upper(file_type), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
  FROM lines
)
SELECT source, event_type, topic, COUNT(*) AS n FROM u GROUP BY 1, 2, 3""",
        "recent_audit": _w(AUDIT) + (
            "SELECT id, source_type, source_name, status, payload_size_bytes, records_count, "
            "created_at FROM audit ORDER BY created_at DESC NULLS LAST, id DESC NULLS LAST LIMIT 50"),
        "uploads_page": _w(FILES, HISTORY) + (
            "SELECT id, filename, file_type, file_size_bytes, minio_path, kafka_topic, records_count, "
            "status, created_at FROM hist ORDER BY created_at DESC NULLS LAST, id DESC NULLS LAST "
            "LIMIT 50 OFFSET 50"),
        "uploads_deep_page": _w(FILES, HISTORY) + (
            "SELECT id, filename, file_type, file_size_bytes, minio_path, kafka_topic, records_count, "
            "status, created_at FROM hist ORDER BY created_at DESC NULLS LAST, id DESC NULLS LAST "
            "LIMIT 50 OFFSET 150"),
    }

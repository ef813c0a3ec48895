"""Reference SQL (DuckDB dialect) for every named query.

Written independently of the Spark code: the same rules expressed as plain
SQL CTEs over the driver's tables, so the check compares two separate
implementations. Timestamps stay naive (UTC wall clock) on both sides.
"""

from __future__ import annotations


def lake_sev(x: str) -> str:
    """Landing-zone severity rule (first match wins, NULL -> INFO)."""
    u = f"upper({x})"
    return (
        f"CASE WHEN contains({u}, 'CRIT') OR contains({u}, 'P1') THEN 'CRITICAL' "
        f"WHEN contains({u}, 'MAJ') OR contains({u}, 'HIGH') OR contains({u}, 'P2') THEN 'MAJOR' "
        f"WHEN contains({u}, 'MIN') OR contains({u}, 'MED') OR contains({u}, 'P3') THEN 'MINOR' "
        f"WHEN contains({u}, 'WARN') THEN 'WARNING' ELSE 'INFO' END"
    )


def connector_sev(x: str) -> str:
    """Connector severity rule on the first non-empty value (default INFO)."""
    u = f"upper(coalesce(nullif({x}, ''), 'INFO'))"
    return (
        f"CASE WHEN contains({u}, 'CRITICAL') OR contains({u}, 'P1') THEN 'CRITICAL' "
        f"WHEN contains({u}, 'MAJOR') OR contains({u}, 'HIGH') OR contains({u}, 'P2') THEN 'MAJOR' "
        f"WHEN contains({u}, 'MINOR') OR contains({u}, 'MEDIUM') OR contains({u}, 'P3') THEN 'MINOR' "
        f"WHEN contains({u}, 'WARNING') THEN 'WARNING' ELSE 'INFO' END"
    )


# --- inputs -----------------------------------------------------------------
PRODUCER = """
producer AS (
  SELECT CAST(e.event_id AS VARCHAR) AS event_id,
         CASE e.user_id % 4 WHEN 0 THEN 'Comarch OSS' WHEN 1 THEN 'Alarm Events'
                            WHEN 2 THEN 'Ticket Events' END AS source,
         e.event_type AS event_type,
         e.ts AS ts,
         CASE e.event_id % 5 WHEN 0 THEN 'Critical' WHEN 1 THEN 'Major' WHEN 2 THEN 'minor'
                             WHEN 3 THEN 'WARN' ELSE 'low' END AS severity,
         CAST(e.user_id AS VARCHAR) AS node_id,
         r.r_name AS region,
         'V' || CAST(CAST(json_extract_string(e.props, '$.k') AS BIGINT) % 4 AS VARCHAR) AS vendor,
         'SITE-' || CAST(e.user_id % 50 AS VARCHAR) AS site_name,
         CAST(NULL AS VARCHAR) AS device_name,
         CAST(NULL AS VARCHAR) AS ticket_id,
         CASE e.event_type WHEN 'click' THEN 'telecom-alarms' WHEN 'error' THEN 'network-events'
                           WHEN 'signup' THEN 'security-events' WHEN 'purchase' THEN 'performance'
                           ELSE 'telecom-events' END AS topic,
         'kafka' AS channel
  FROM events e LEFT JOIN region r ON r.r_regionkey = e.user_id % 5
)"""

REST_TICKETS = f"""
rest_tickets AS (
  SELECT 'INC' || CAST(o_orderkey AS VARCHAR) AS event_id,
         'REST_TICKET' AS source,
         'REST_ticket' AS event_type,
         o_orderdate AS ts,
         {connector_sev('o_orderpriority')} AS severity,
         'NODE-GENERIC' AS node_id,
         'SA-RIYADH' AS region,
         CAST(NULL AS VARCHAR) AS vendor,
         CAST(NULL AS VARCHAR) AS site_name,
         CAST(NULL AS VARCHAR) AS device_name,
         'INC' || CAST(o_orderkey AS VARCHAR) AS ticket_id,
         'tickets' AS topic,
         'rest' AS channel
  FROM orders
)"""

PERF_RECORDS = """
perf_records AS (
  SELECT 'MET-' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS metric_id,
         'DEV-' || CAST(l.l_suppkey AS VARCHAR) AS device_id,
         r.r_name AS region,
         l.l_shipdate AS ts,
         l.l_quantity AS latency_ms,
         l.l_discount * 10 AS packet_loss_pct,
         l.l_extendedprice AS throughput_mbps
  FROM lineitem l LEFT JOIN region r ON r.r_regionkey = l.l_suppkey % 5
)"""

REST_PERF = """
rest_perf AS (
  SELECT metric_id AS event_id,
         'REST_PERFORMANCE' AS source,
         'REST_performance' AS event_type,
         ts,
         'INFO' AS severity,
         device_id AS node_id,
         coalesce(nullif(region, ''), 'SA-RIYADH') AS region,
         CAST(NULL AS VARCHAR) AS vendor,
         CAST(NULL AS VARCHAR) AS site_name,
         device_id AS device_name,
         CAST(NULL AS VARCHAR) AS ticket_id,
         'performance' AS topic,
         'rest' AS channel
  FROM perf_records
)"""

MESSAGES = """
messages AS (
  SELECT * FROM producer
  UNION ALL SELECT * FROM rest_tickets
  UNION ALL SELECT * FROM rest_perf
)"""

ROUTE_CASE = """
    CASE
      WHEN topic = 'telecom-alarms' THEN 'alarms'
      WHEN topic = 'tickets' THEN 'tickets'
      WHEN topic = 'network-events' THEN 'network'
      WHEN topic = 'security-events' THEN 'security'
      WHEN topic = 'performance' THEN 'performance'
      WHEN contains(lower(coalesce(event_type, '')), 'alarm')
        OR contains(lower(coalesce(source, '')), 'alarm') THEN 'alarms'
      WHEN contains(lower(coalesce(event_type, '')), 'ticket')
        OR contains(lower(coalesce(source, '')), 'ticket')
        OR contains(lower(coalesce(event_id, '')), 'inc') THEN 'tickets'
      WHEN contains(lower(coalesce(event_type, '')), 'net')
        OR contains(lower(coalesce(source, '')), 'network')
        OR contains(lower(coalesce(event_type, '')), 'cell') THEN 'network'
      WHEN contains(lower(coalesce(event_type, '')), 'sec')
        OR contains(lower(coalesce(source, '')), 'security')
        OR contains(lower(coalesce(event_type, '')), 'threat') THEN 'security'
      WHEN contains(lower(coalesce(event_type, '')), 'prf')
        OR contains(lower(coalesce(source, '')), 'perf')
        OR contains(lower(coalesce(event_type, '')), 'metric') THEN 'performance'
      ELSE 'unrouted'
    END"""

ROUTED = f"""
routed AS (
  SELECT *, {ROUTE_CASE} AS category
  FROM messages
  WHERE source IS NOT NULL AND node_id IS NOT NULL
)"""

ROUTED_ALL = f"""
routed_all AS (
  SELECT *, {ROUTE_CASE} AS category,
         (source IS NOT NULL AND node_id IS NOT NULL) AS accepted
  FROM messages
)"""

BASE = ",".join([PRODUCER, REST_TICKETS, PERF_RECORDS, REST_PERF, MESSAGES, ROUTED])


def table_cte(name: str, category: str) -> str:
    """A serving table: cleaned rows of one category, newest row per id."""
    return f"""
{name} AS (
  SELECT * FROM (
    SELECT event_id, source, event_type, severity, node_id, region,
           {lake_sev('severity')} AS severity_clean,
           ts AS event_timestamp,
           strftime(ts, '%Y-%m-%d') AS event_date,
           vendor, site_name, device_name, ticket_id, channel
    FROM routed WHERE category = '{category}'
  )
  QUALIFY coalesce(nullif(event_id, ''), nullif(ticket_id, '')) IS NULL   -- no id: kept
    OR row_number() OVER (
    PARTITION BY coalesce(nullif(event_id, ''), nullif(ticket_id, ''))
    ORDER BY event_timestamp DESC NULLS LAST, source DESC NULLS LAST, event_type DESC NULLS LAST,
             severity DESC NULLS LAST, node_id DESC NULLS LAST, region DESC NULLS LAST,
             channel DESC NULLS LAST) = 1
)"""


TABLE_CATEGORY = {
    "alarms": "alarms", "tickets": "tickets", "network_events": "network",
    "security_events": "security", "performance_metrics": "performance",
}


def with_table(table: str, body: str) -> str:
    return f"WITH {BASE}, {table_cte('t', TABLE_CATEGORY[table])}\n{body}"


def with_base(body: str, *extra: str) -> str:
    parts = [BASE, *extra]
    return "WITH " + ",".join(parts) + "\n" + body


# --- dashboard panels ---------------------------------------------------------
PANEL_SQL = {
    "alarms": {
        "total": "SELECT COUNT(*) AS total_alarms FROM t",
        "by_severity": "SELECT severity_clean AS severity, COUNT(*) AS count FROM t GROUP BY 1",
        "by_vendor": "SELECT vendor, COUNT(*) AS count FROM t GROUP BY 1",
        "by_region": "SELECT region, COUNT(*) AS count FROM t GROUP BY 1",
        "hourly": ("SELECT date_trunc('hour', event_timestamp) AS time, COUNT(*) AS alarms_count "
                   "FROM t GROUP BY 1 ORDER BY 1"),
        "recent": ('SELECT event_id AS "Event ID", node_id AS "Node ID", region AS "Region", '
                   'vendor AS "Vendor", severity_clean AS "Severity", event_timestamp AS "Event Timestamp" '
                   "FROM t ORDER BY event_timestamp DESC NULLS LAST, event_id ASC LIMIT 50"),
    },
    "network_events": {
        "total": "SELECT COUNT(*) AS total_events FROM t",
        "by_severity": "SELECT severity_clean AS severity, COUNT(*) AS count FROM t GROUP BY 1",
        "by_region": "SELECT region, COUNT(*) AS count FROM t GROUP BY 1",
        "hourly": ("SELECT date_trunc('hour', event_timestamp) AS time, COUNT(*) AS events_count "
                   "FROM t GROUP BY 1 ORDER BY 1"),
        "recent": ('SELECT event_id AS "Event ID", node_id AS "Node ID", region AS "Region", '
                   'severity_clean AS "Severity", event_timestamp AS "Event Timestamp" '
                   "FROM t ORDER BY event_timestamp DESC NULLS LAST, event_id ASC LIMIT 50"),
    },
    "performance_metrics": {
        "total": "SELECT COUNT(*) AS total_metrics FROM t",
        "by_severity": "SELECT severity_clean AS severity, COUNT(*) AS count FROM t GROUP BY 1",
        "by_region": "SELECT region, COUNT(*) AS count FROM t GROUP BY 1",
        "hourly": ("SELECT date_trunc('hour', event_timestamp) AS time, COUNT(*) AS metric_count "
                   "FROM t GROUP BY 1 ORDER BY 1"),
        "recent": ('SELECT event_id AS "Event ID", node_id AS "Node ID", region AS "Region", '
                   'severity_clean AS "Severity", event_timestamp AS "Event Timestamp" '
                   "FROM t ORDER BY event_timestamp DESC NULLS LAST, event_id ASC LIMIT 50"),
    },
    "security_events": {
        "total": "SELECT COUNT(*) AS total_threats FROM t",
        "by_severity": "SELECT severity_clean AS threat_level, COUNT(*) AS count FROM t GROUP BY 1",
        "by_region": "SELECT region, COUNT(*) AS count FROM t GROUP BY 1",
        "hourly": ("SELECT date_trunc('hour', event_timestamp) AS time, COUNT(*) AS threat_count "
                   "FROM t GROUP BY 1 ORDER BY 1"),
        "recent": ('SELECT event_id AS "Event ID", node_id AS "Node ID", region AS "Region", '
                   'severity_clean AS "Threat Level", event_timestamp AS "Event Timestamp" '
                   "FROM t ORDER BY event_timestamp DESC NULLS LAST, event_id ASC LIMIT 50"),
    },
    "tickets": {
        "total": "SELECT COUNT(*) AS total_tickets FROM t",
        "by_severity": "SELECT severity_clean AS priority, COUNT(*) AS count FROM t GROUP BY 1",
        "by_assigned_group": "SELECT source AS assigned_group, COUNT(*) AS count FROM t GROUP BY 1",
        "hourly": ("SELECT date_trunc('hour', event_timestamp) AS time, COUNT(*) AS tickets_count "
                   "FROM t GROUP BY 1 ORDER BY 1"),
        "recent": ('SELECT event_id AS "Ticket ID", source AS "Assigned Group", '
                   'severity_clean AS "Priority", event_timestamp AS "Created Timestamp" '
                   "FROM t ORDER BY event_timestamp DESC NULLS LAST, event_id ASC LIMIT 50"),
    },
}


def panel_sql() -> dict[str, str]:
    out = {}
    for table, panels in PANEL_SQL.items():
        for kind, body in panels.items():
            if kind == "total":
                key = f"total_{table}"
            elif kind == "recent":
                key = f"recent_{table}"
            else:
                key = f"{table}_{kind}"
            out[key] = with_table(table, body)
    return out

"""Serving tables and dashboard panels.

Flow for every table (the batch form of the streaming job):

  Kafka messages --validate (D1)--> accepted --route (C13)--> category slice
      --clean (C1, C3, C4, C9)--> canonical columns --dedup (F1, F3)--> table

Panels (E1-E4, G1) are small aggregates or top-k over one table. ``since`` /
``until`` bound a panel in time; on a date-partitioned table the
``event_date`` predicate prunes directories.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siglake.functions.routing import category_route
from siglake.operators.aggregates import count_by, hourly_counts, recent, time_slice, total_count
from siglake.operators.dedup import newest_events
from siglake.operators.normalize import clean_events, to_canonical
from siglake.operators.validate import accepted
from siglake.schemas import CATEGORY_TABLES
from siglake.sinks.tables import BASE
from siglake.sources import driver

TABLE_CATEGORIES = {t: c for c, t in CATEGORY_TABLES.items()}


@dataclass(frozen=True)
class PanelSpec:
    """The five dashboard panels of one serving table."""
    table: str
    total_alias: str
    severity_alias: str
    dims: dict[str, str]            # source column -> output alias (E3)
    hourly_alias: str
    recent_cols: dict[str, str] = field(default_factory=dict)


# Panel titles/aliases of the five dashboards.
PANELS = {
    "alarms": PanelSpec(
        "alarms", "total_alarms", "severity", {"vendor": "vendor", "region": "region"}, "alarms_count",
        {"event_id": "Event ID", "node_id": "Node ID", "region": "Region", "vendor": "Vendor",
         "severity_clean": "Severity", "event_timestamp": "Event Timestamp"}),
    "network_events": PanelSpec(
        "network_events", "total_events", "severity", {"region": "region"}, "events_count",
        {"event_id": "Event ID", "node_id": "Node ID", "region": "Region",
         "severity_clean": "Severity", "event_timestamp": "Event Timestamp"}),
    "performance_metrics": PanelSpec(
        "performance_metrics", "total_metrics", "severity", {"region": "region"}, "metric_count",
        {"event_id": "Event ID", "node_id": "Node ID", "region": "Region",
         "severity_clean": "Severity", "event_timestamp": "Event Timestamp"}),
    "security_events": PanelSpec(
        "security_events", "total_threats", "threat_level", {"region": "region"}, "threat_count",
        {"event_id": "Event ID", "node_id": "Node ID", "region": "Region",
         "severity_clean": "Threat Level", "event_timestamp": "Event Timestamp"}),
    "tickets": PanelSpec(
        "tickets", "total_tickets", "priority", {"source": "assigned_group"}, "tickets_count",
        {"event_id": "Ticket ID", "source": "Assigned Group", "severity_clean": "Priority",
         "event_timestamp": "Created Timestamp"}),
}


def routed_messages(messages: DataFrame) -> DataFrame:
    """Accepted messages with their landing ``category``."""
    ok = accepted(messages)
    topic = "topic" if "topic" in ok.columns else None
    return ok.withColumn("category", category_route(topic=topic))


def build_table(routed: DataFrame, category: str, columns: list[str] | None = None) -> DataFrame:
    """Clean + canonicalise + de-duplicate one category slice.

    ``columns`` restricts the result to what a caller reads; the newest row per
    id wins (see ``operators.dedup.newest_events``).
    """
    slice_ = routed.where(F.col("category") == F.lit(category))
    ingest = F.col("channel") if "channel" in slice_.columns else None
    canon = to_canonical(clean_events(slice_), category=F.lit(category), ingest_file=ingest)
    return newest_events(canon, columns)


def routed_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted, routed Kafka messages built from the driver inputs."""
    return routed_messages(driver.kafka_messages(spark, sf_dir))


def serving_table(spark: SparkSession, sf_dir: str, table: str,
                  columns: list[str] | None = None) -> DataFrame:
    """One of the five serving tables, built from the driver inputs."""
    return build_table(routed_inputs(spark, sf_dir), TABLE_CATEGORIES[table], columns)


def build_all(routed: DataFrame, tables: list[str] | None = None) -> DataFrame:
    """Every serving table at once: clean + canonical + newest row per
    ``(category, id)`` in a single shuffle (the five tables differ only in
    their category)."""
    ingest = F.col("channel") if "channel" in routed.columns else None
    cats = [TABLE_CATEGORIES[t] for t in (tables or list(TABLE_CATEGORIES))]
    served = routed.where(F.col("category").isin(*cats))
    canon = to_canonical(clean_events(served), category=F.col("category"), ingest_file=ingest)
    return newest_events(canon, within=["category"])


def materialize(spark: SparkSession, sf_dir: str, out_dir: str,
                tables: list[str] | None = None) -> list[str]:
    """Write the serving tables in the layout of ``sinks.tables``; return their names.

    One clean/de-duplicate pass and one write job (REBALANCE by the partition
    columns, so a hot day is split across tasks). The job reads the inputs
    once; a lost executor recomputes only its own tasks from the inputs and
    shuffle files. The batch ``base`` of each table is replaced.
    """
    names = list(tables or TABLE_CATEGORIES)
    table = F.element_at(F.create_map(*[F.lit(x) for t in names for x in (TABLE_CATEGORIES[t], t)]), F.col("category"))
    rows = build_all(routed_inputs(spark, sf_dir), names).withColumns({"table": table, "batch": F.lit(BASE)})
    (rows.hint("rebalance", "table", "event_date")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("table", "batch", "event_date").parquet(out_dir.rstrip("/")))
    return names


# ---------------------------------------------------------------------------
# Panels over any frame with the canonical columns
# ---------------------------------------------------------------------------
def panel_total(t: DataFrame, spec: PanelSpec, since=None, until=None) -> DataFrame:
    return total_count(time_slice(t, since, until), spec.total_alias)


def panel_by_severity(t: DataFrame, spec: PanelSpec, since=None, until=None) -> DataFrame:
    return count_by(time_slice(t, since, until), "severity_clean", spec.severity_alias)


def panel_by_dim(t: DataFrame, spec: PanelSpec, dim: str, since=None, until=None) -> DataFrame:
    return count_by(time_slice(t, since, until), dim, spec.dims[dim])


def panel_hourly(t: DataFrame, spec: PanelSpec, since=None, until=None) -> DataFrame:
    return hourly_counts(time_slice(t, since, until), spec.hourly_alias)


def panel_recent(t: DataFrame, spec: PanelSpec, n: int = 50, since=None, until=None) -> DataFrame:
    return recent(time_slice(t, since, until), spec.recent_cols, n=n)

"""Adapters from the driver's parquet tables to telemetry inputs.

The driver tables carry no telecom columns, so each adapter maps one table
onto one of the platform's input shapes, deterministically and for every
row (no sampling, no id subsets):

* ``events``   -> producer messages on Kafka (unified 8-key events + topic)
* ``orders``   -> ServiceNow-style ticket records polled over REST
* ``lineitem`` -> performance metric records polled over REST
* ``documents``-> uploaded files (upload history, audit log, upload records)
* ``region``   -> the region-name dimension (5 rows)

The mapping constants below are fixture design, stated once. Everything
downstream (validation, routing, cleaning, de-duplication, panels) is the
library's own operators applied to these frames.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siglake.functions.files import file_type_of, sha256_hex
from siglake.operators.normalize import connector_normalize
from siglake.operators.reshape import fan_in
from siglake.operators.summaries import recent_rows
from siglake.session import shared_path
from siglake.sinks import fs
from siglake.sinks.pages import build_page_index, read_page

# ---------------------------------------------------------------------------
# Fixed values (fixture mapping)
# ---------------------------------------------------------------------------
# producer "source" by user_id mod 4 (the last slot is a producer that omits it)
PRODUCER_SOURCES = ["Comarch OSS", "Alarm Events", "Ticket Events", None]
# producer severity by event_id mod 5: mixed casing and a non-level word
PRODUCER_SEVERITIES = ["Critical", "Major", "minor", "WARN", "low"]
# producer topic by event type; other types go to the catch-all topic
EVENT_TYPE_TOPICS = {
    "click": "telecom-alarms",
    "error": "network-events",
    "signup": "security-events",
    "purchase": "performance",
}
CATCH_ALL_TOPIC = "telecom-events"
VENDOR_COUNT = 4      # vendorName = "V" || (props.k mod 4)
SITE_COUNT = 50       # siteId = "SITE-" || (user_id mod 50)
REGION_COUNT = 5      # region = r_name of (key mod 5)
# uploaded file extension by document language
LANG_EXTENSIONS = {"en": ".csv", "fr": ".json", "de": ".xlsx", "es": ".pdf"}
UNKNOWN_EXTENSION = ".txt"
UPLOAD_EPOCH = "2024-01-01 00:00:00"  # created_at = epoch + doc_id minutes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, listed anew on each call, so files added in between are seen."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values: list, index: Column) -> Column:
    """values[index] for a 0-based index column (NULL index -> NULL)."""
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(arr, (index + F.lit(1)).cast("int"))


def region_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(r_regionkey, r_name)``; Spark broadcasts it by its size in bytes."""
    return table(spark, sf_dir, "region").select("r_regionkey", "r_name")


def _with_region(df: DataFrame, spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    reg = region_dim(spark, sf_dir)
    return df.join(reg, F.pmod(F.col(key), F.lit(REGION_COUNT)) == reg["r_regionkey"], "left")


def producer_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka producer messages: unified event columns plus ``topic`` and ``channel``."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    ev = _with_region(ev, spark, sf_dir, "user_id")
    k = F.get_json_object("props", "$.k").try_cast("long")
    payload = F.to_json(F.struct(
        F.concat(F.lit("V"), F.pmod(k, F.lit(VENDOR_COUNT)).cast("string")).alias("vendorName"),
        F.concat(F.lit("SITE-"), F.pmod("user_id", F.lit(SITE_COUNT)).cast("string")).alias("siteId"),
    ))
    topic = None
    for et, tp in EVENT_TYPE_TOPICS.items():
        cond = F.col("event_type") == F.lit(et)
        topic = F.when(cond, F.lit(tp)) if topic is None else topic.when(cond, F.lit(tp))
    topic = topic.otherwise(F.lit(CATCH_ALL_TOPIC))
    return ev.select(
        F.col("event_id").cast("string").alias("event_id"),
        _pick(PRODUCER_SOURCES, F.pmod("user_id", F.lit(len(PRODUCER_SOURCES)))).alias("source"),
        F.col("event_type"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        _pick(PRODUCER_SEVERITIES, F.pmod("event_id", F.lit(len(PRODUCER_SEVERITIES)))).alias("severity"),
        F.col("user_id").cast("string").alias("node_id"),
        F.col("r_name").alias("region"),
        payload.alias("payload"),
        topic.alias("topic"),
        F.lit("kafka").alias("channel"),
    )


def lenient_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(topic, value)`` records, every third one with other fields than the unified eight
    (``alarm_id``, ``vendor``, ``created_at`` at top level, no event id, severity or payload)."""
    p = producer_events(spark, sf_dir)
    when = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    other = F.to_json(F.struct(
        "source", "node_id", F.concat(F.lit("ALM-"), "event_id").alias("alarm_id"),
        F.get_json_object("payload", "$.vendorName").alias("vendor"), when.alias("created_at")))
    unified = F.to_json(F.struct("event_id", "source", "event_type", when.alias("timestamp"), "severity", "node_id",
                                 "region", "payload"))
    lenient = F.pmod(F.col("event_id").cast("long"), F.lit(3)) == 0
    return p.select("topic", F.when(lenient, other).otherwise(unified).cast("binary").alias("value"))


def ticket_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REST ticket records (ticket_id, priority, state, created_at)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("INC"), F.col("o_orderkey").cast("string")).alias("ticket_id"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("state"),
        F.col("o_orderdate").alias("created_at"),
    )


def performance_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REST performance metric records.

    ``metric_id`` is ``MET-<orderkey>-<linenumber>``; that pair is not unique
    in the driver table, so the metric feed carries genuine repeats.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_discount", "l_extendedprice", "l_shipdate")
    li = _with_region(li, spark, sf_dir, "l_suppkey")
    return li.select(
        F.concat(F.lit("MET-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("metric_id"),
        F.concat(F.lit("DEV-"), F.col("l_suppkey").cast("string")).alias("device_id"),
        F.col("r_name").alias("region"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_quantity").alias("latency_ms"),
        (F.col("l_discount") * F.lit(10)).alias("packet_loss_pct"),
        F.col("l_extendedprice").alias("throughput_mbps"),
    )


def connector_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REST records normalised by the connector and published to their topics."""
    tickets = connector_normalize(ticket_records(spark, sf_dir), "ticket")
    perf = connector_normalize(performance_records(spark, sf_dir), "performance")
    return fan_in([tickets, perf]).withColumn("channel", F.lit("rest"))


def kafka_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that arrives on the Kafka topics: producers plus the connector."""
    return fan_in([producer_events(spark, sf_dir), connector_messages(spark, sf_dir)])


# ---------------------------------------------------------------------------
# Uploaded files (documents)
# ---------------------------------------------------------------------------
def _created_at(doc_id: Column) -> Column:
    return F.timestamp_add("MINUTE", doc_id, F.lit(UPLOAD_EPOCH).cast("timestamp_ntz"))


def newest_documents(spark: SparkSession, sf_dir: str, n: int, offset: int = 0) -> DataFrame:
    """The documents of one page: a top-k of the ids alone, then the rows of those ids.

    No text reaches the task that orders the ids, and only the page's texts are worked on.
    """
    d = table(spark, sf_dir, "documents")
    keys = d.select("doc_id", _created_at(F.col("doc_id")).alias("created_at"))
    page = recent_rows(keys, n, tie="doc_id", offset=offset).select("doc_id")
    return d.join(F.broadcast(page), "doc_id", "left_semi")      # n ids


def deep_documents(spark: SparkSession, sf_dir: str, n: int, offset: int) -> DataFrame:
    """The documents of a page far down, through a page index of the ids; no task orders ``offset`` rows."""
    path = shared_path(spark, "pages", uuid.uuid4().hex)
    d = table(spark, sf_dir, "documents")
    build_page_index(d.select("doc_id", _created_at(F.col("doc_id")).alias("created_at")), path, tie="doc_id")
    ids = [r["doc_id"] for r in read_page(spark, path, n, offset, tie="doc_id").select("doc_id").collect()]   # n at most
    fs.delete(spark, path)
    return d.where(F.col("doc_id").isin(ids))


def uploaded_files(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """One row per uploaded file: id, filename, file_type, size, content, created_at."""
    d = table(spark, sf_dir, "documents") if docs is None else docs
    ext_map = F.create_map(*[F.lit(x) for kv in LANG_EXTENSIONS.items() for x in kv])
    ext = F.coalesce(F.try_element_at(ext_map, F.col("lang")), F.lit(UNKNOWN_EXTENSION))
    filename = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), ext)
    return d.select(
        F.col("doc_id").alias("id"),
        filename.alias("filename"),
        file_type_of(filename).alias("file_type"),
        F.octet_length("text").cast("long").alias("file_size_bytes"),
        F.col("text").alias("content"),
        F.col("source").alias("source"),
        F.col("lang").alias("lang"),
        _created_at(F.col("doc_id")).alias("created_at"),
    )


def _line_count(text: Column) -> Column:
    return F.coalesce(F.size(F.split(text, "\n", -1)), F.lit(0))


def upload_history(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """Upload history rows (B8 output) for every uploaded document, or for ``docs``."""
    f = uploaded_files(spark, sf_dir, docs)
    parsed = F.col("file_type").isin("csv", "json", "excel")
    records = (F.when(parsed, _line_count(F.col("content")))
               .when(F.col("file_type") == "pdf", F.lit(1))
               .otherwise(F.lit(0))).cast("long")
    ok = F.col("file_type").isNotNull() & (F.col("file_size_bytes") > 0)
    return f.select(
        "id", "filename",
        F.coalesce(F.col("file_type"), F.lit("unsupported")).alias("file_type"),
        "file_size_bytes",
        F.concat(F.lit("raw/uploads/"), F.coalesce(F.col("file_type"), F.lit("rejected")),
                 F.lit("/"), F.col("filename")).alias("minio_path"),
        F.when(ok & parsed & (records > 0), F.lit("network-events")).alias("kafka_topic"),
        F.when(ok, records).otherwise(F.lit(0).cast("long")).alias("records_count"),
        F.when(ok, F.lit("SUCCESS")).otherwise(F.lit("FAILED")).alias("status"),
        F.when(~ok, F.lit("unsupported or empty file")).alias("error_message"),
        F.to_json(F.struct(sha256_hex(F.col("content")).alias("sha256_hash"),
                           F.col("lang"), F.col("source"))).alias("metadata_json"),
        "created_at",
    )


def audit_log(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """Ingestion audit rows: one per uploaded document (or of ``docs``), typed by its source system."""
    d = table(spark, sf_dir, "documents") if docs is None else docs
    ok = F.col("n_chars") > 0
    return d.select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("source_type"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("source_name"),
        F.when(ok, F.lit("SUCCESS")).otherwise(F.lit("FAILED")).alias("status"),
        F.concat(F.lit("raw/"), F.col("source"), F.lit("/doc_"), F.col("doc_id").cast("string")).alias("minio_path"),
        F.col("n_chars").cast("long").alias("payload_size_bytes"),
        _line_count(F.col("text")).cast("long").alias("records_count"),
        F.lit(None).cast("double").alias("processing_time_ms"),
        F.when(~ok, F.lit("empty payload")).alias("error_message"),
        F.lit(None).cast("string").alias("metadata_json"),
        _created_at(F.col("doc_id")).alias("created_at"),
    )


def upload_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed records of every uploaded file: one row per line, with its index."""
    f = uploaded_files(spark, sf_dir).where(F.col("file_type").isin("csv", "json", "excel"))
    return f.select(
        "id", "filename", "file_type", "created_at",
        sha256_hex(F.col("content")).alias("sha256"),
        F.posexplode(F.split(F.col("content"), "\n", -1)).alias("row_idx", "record"),
    )


"""Message ingestion (the consumer side): decode -> validate -> route -> land.

One DataFrame plan per micro-batch replaces the per-message consumer loop:
Kafka records (or any ``(topic, value)`` frame) are decoded against the
unified schema, rejected messages are written to a quarantine table with
their reasons, and accepted ones, with all their other fields and the event
defaults, land under
``<landing_root>/category=<c>/ingest_date=<d>/batch=<query id>--<n>/`` as JSON
lines. With ``landing_root = <root>/raw/kafka`` that is exactly the layout the
landing-zone job's source registry (``sources.files.SOURCES``) reads.

A batch is staged first and its folders are then moved to their places. A
retried batch finds the folders of its first attempt and leaves them, so a
landed file never changes its name and the next stream reads it once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siglake.functions.routing import category_route
from siglake.operators.normalize import apply_event_defaults, resolve_lenient
from siglake.operators.validate import accepted, quarantine
from siglake.sinks import fs
from siglake.sinks.tables import append_rows
from siglake.sources.kafka import decode_messages
from siglake.streaming.job import query_id

UNDATED = "undated"


def route_messages(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split decoded messages into (accepted with ``category``, rejected with reasons).

    The time default (C23) is the broker's stamp of the message; without one the
    message stays without a time, and the landing job gives it its file's.
    """
    ok = resolve_lenient(accepted(decoded))
    stamp = F.col("kafka_timestamp") if "kafka_timestamp" in decoded.columns else F.lit(None).cast("timestamp")
    ok = apply_event_defaults(ok, now=stamp)
    return ok.withColumn("category", category_route(topic="topic")), quarantine(decoded.drop("extra"))


def land_batch(routed: DataFrame, landing_root: str, batch: str) -> list[str]:
    """Routed messages -> JSON lines under category/ingest_date/batch; the folders that are new.

    The date is the message's own, so a retry after midnight finds the same place.
    """
    spark, root = routed.sparkSession, landing_root.rstrip("/")
    staging = f"{root}/_staging/{batch}"
    day = F.coalesce(F.date_format(F.try_to_timestamp("timestamp"), "yyyy-MM-dd"), F.lit(UNDATED))
    (routed.withColumn("ingest_date", day).hint("rebalance", "category", "ingest_date")
     .write.mode("overwrite").partitionBy("category", "ingest_date").json(staging))
    new = []
    for category in fs.folders(spark, staging):
        for date in fs.folders(spark, f"{staging}/{category}"):
            target = f"{root}/{category}/{date}/batch={batch}"
            if fs.publish(spark, f"{staging}/{category}/{date}", target):
                new.append(target)
    fs.delete(spark, staging)
    return new


def make_ingest_handler(landing_root: str, quarantine_root: str, checkpoint: str):
    """``foreachBatch`` callback: decode, validate, route, land, quarantine."""
    def handle(batch_df: DataFrame, batch_id: int) -> None:
        rows = batch_df.persist()
        try:
            if rows.isEmpty():
                return
            batch = f"{query_id(rows.sparkSession, checkpoint)}--{batch_id}"
            ok, bad = route_messages(decode_messages(rows))
            land_batch(ok, landing_root, batch)
            append_rows(bad, quarantine_root, batch)
        finally:
            rows.unpersist()
    return handle


def start_ingest(records: DataFrame, landing_root: str, quarantine_root: str, checkpoint: str,
                 trigger_seconds: int | None = 15, name: str = "ingest_messages") -> StreamingQuery:
    """Start the ingestion stream over a ``(topic, value)`` streaming frame."""
    w = (records.writeStream.queryName(name)
         .foreachBatch(make_ingest_handler(landing_root, quarantine_root, checkpoint))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if trigger_seconds is None \
        else w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()


def json_record_stream(spark: SparkSession, path: str, max_files: int = 50) -> DataFrame:
    """A file-backed ``(topic, value)`` stream (JSON lines), e.g. a Kafka export."""
    return (spark.readStream.schema("topic string, value string")
            .option("maxFilesPerTrigger", max_files).json(path)
            .withColumn("value", F.col("value").cast("binary")))

"""The landing-zone streaming job.

One Structured Streaming query per registry source (A3). Each micro-batch is
cleaned with the batch transforms and written to a folder of its own, named by
source, query id and batch id, so a retry finds its own output. The query's
id lives in its checkpoint, whose place is the same in every application; a
query that would start anew beside the output of an older one is refused.

Repeats in later batches (F2) are stored and folded on reading, by the same
newest-wins rule as in batch (``sinks.tables.read_serving``), so no late row is
lost and no state grows; ``compact`` folds them for good.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siglake.functions.timeparse import resolve_event_time
from siglake.operators.dedup import newest_events
from siglake.operators.normalize import clean_events, connector_normalize_json, to_canonical
from siglake.operators.reshape import explode_envelope
from siglake.operators.uploads import UPLOAD_TOPIC, Uploads
from siglake.schemas import REST_ENVELOPE, UNIFIED_EVENT
from siglake.session import stable_checkpoint_root
from siglake.sinks import fs
from siglake.sinks.landing import encode_messages
from siglake.sinks.tables import append_rows, register_batch, table_path, write_batch
from siglake.sources.files import CORRUPT, SourceSpec, open_source, stream_binary
from siglake.streaming.repeats import drop_repeats


@dataclass
class StreamConfig:
    landing_root: str
    output_root: str
    checkpoint_root: str | None = None     # default: "streams" under spark.checkpoint.dir
    trigger_seconds: int | None = 15       # None -> availableNow (drain and stop)
    max_files_per_trigger: int = 50
    table_prefix: str | None = None        # e.g. "ops." to also expose catalog tables
    json_multiline: bool | None = None     # override the per-source JSON mode
    # gets the (key, topic, value) messages of upload and REST events from the outbox (``follow.start_outbox``, B6)
    publish: Callable[[DataFrame], None] | None = None
    # drop equal events that arrive again within this delay, e.g. "2 days"; set it from a source's first start on
    drop_repeats: str | None = None
    hourly: bool = False                   # keep hourly counts of each table (``follow.start_hourly``)


def clean_batch(df: DataFrame, category: str) -> DataFrame:
    """The per-batch transform: clean, canonical columns, newest row per id.

    A row without a time of its own takes its file's modification time, so a
    replay reproduces the same stamps (instead of ``now``).
    """
    fallback = F.col("file_modified_at") if "file_modified_at" in df.columns else None
    body = df.drop(CORRUPT) if CORRUPT in df.columns else df
    return newest_events(to_canonical(clean_events(body, fallback_time=fallback), category=F.lit(category)))


def checkpoint_location(spark: SparkSession, cfg: StreamConfig, spec: SourceSpec) -> str:
    """One checkpoint per source, at the same place in every application."""
    return f"{_checkpoints(spark, cfg)}/{spec.category}"


def follower_checkpoint(spark: SparkSession, cfg: StreamConfig, name: str) -> str:
    """The checkpoint of a query that follows the stored batches, beside those of the sources."""
    return f"{_checkpoints(spark, cfg)}/_follow/{name}"


def _checkpoints(spark: SparkSession, cfg: StreamConfig) -> str:
    root = cfg.checkpoint_root
    if root is None:
        shared = stable_checkpoint_root(spark)
        if not shared:
            raise ValueError("name a checkpoint folder, or set spark.checkpoint.dir to a shared one")
        root = f"{shared.rstrip('/')}/streams"
    return root.rstrip("/")


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps in its checkpoint for good."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def refuse_second_start(spark: SparkSession, cfg: StreamConfig, spec: SourceSpec) -> None:
    """A new checkpoint beside stored batches of the source would read and store all input again."""
    if fs.exists(spark, f"{checkpoint_location(spark, cfg, spec)}/metadata"):
        return
    stored = [b for b in fs.folders(spark, table_path(cfg.output_root, spec.table))
              if b.startswith(f"batch={spec.category}--")]
    if stored or fs.exists(spark, source_mark(cfg, spec)):
        raise RuntimeError(f"{spec.category}: the output holds batches of it but the checkpoint is new; "
                           "name the checkpoint they were written with, or another output")


def source_mark(cfg: StreamConfig, spec: SourceSpec) -> str:
    """A folder that says that the output holds rows of a source, also after its batches were compacted."""
    return f"{cfg.output_root.rstrip('/')}/_sources/{spec.category}"


def outbox_path(output: str) -> str:
    return f"{output.rstrip('/')}/outbox"


def put_in_outbox(events: DataFrame, output: str, batch: str) -> None:
    """The batch's messages, staged and moved to their place once: a retry sends nothing again."""
    spark = events.sparkSession
    staging = f"{output.rstrip('/')}/_staging/{uuid.uuid4().hex}"
    encode_messages(events).write.parquet(staging)
    if not fs.publish(spark, staging, f"{outbox_path(output)}/batch={batch}"):
        fs.delete(spark, staging)


def audit_row(spark: SparkSession, spec: SourceSpec, batch: str, path: str, began: float, records: int | None,
              payload_bytes: int | None, error: str | None = None) -> DataFrame:
    """One row for a batch: what was observed while it was written, or why it failed."""
    rows = [(batch, spec.category, f"query_{spec.category}", "FAILED" if error else "SUCCESS", path, payload_bytes, records,
             (time.time() - began) * 1000, error, json.dumps({"table": spec.table}))]
    return spark.createDataFrame(
        rows, "id string, source_type string, source_name string, status string, minio_path string, "
              "payload_size_bytes bigint, records_count bigint, processing_time_ms double, error_message string, "
              "metadata_json string").withColumn("created_at", F.current_timestamp().cast("timestamp_ntz"))


def observed(seen: Observation) -> dict:
    """What a finished write observed; nothing where its plan turned out to be empty, since Spark then drops the metrics."""
    try:
        return seen.get
    except (Py4JError, PySparkException):
        return {}


def make_batch_handler(spec: SourceSpec, cfg: StreamConfig, checkpoint: str):
    """The ``foreachBatch`` callback for one source.

    Writes the batch's serving rows, its catalog partitions, its audit row, the
    messages to publish and, for uploads, the files' metadata and history rows, each
    in a folder of the batch, so a retry writes nothing twice.
    """
    out = cfg.output_root.rstrip("/")

    def store(spark: SparkSession, events: DataFrame, batch: str) -> None:
        began = time.time()
        fs.make(spark, source_mark(cfg, spec))
        seen = Observation()
        rows = clean_batch(events, spec.category).observe(
            seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("payload")), F.lit(0)).alias("bytes"))
        path = write_batch(rows, out, spec.table, batch)                                 # B1, exactly once
        if cfg.table_prefix:                                                             # B2 over the same files
            register_batch(spark, f"{cfg.table_prefix}{spec.table}", out, spec.table, batch)
        got = observed(seen)
        append_rows(audit_row(spark, spec, batch, path, began, got.get("n", 0), got.get("bytes", 0)), f"{out}/audit_log", batch)

    def handle(batch_df: DataFrame, batch_id: int) -> None:
        spark, began = batch_df.sparkSession, time.time()
        try:
            work(batch_df, batch_id)
        except Exception as e:
            batch = f"{spec.category}--{query_id(spark, checkpoint)}--{batch_id}"
            path = f"{table_path(out, spec.table)}/batch={batch}"
            # beside the row of a later success, which does not undo it
            append_rows(audit_row(spark, spec, batch, path, began, None, None, f"{type(e).__name__}: {e}"[:4000]),
                        f"{out}/audit_log", f"{batch}--failed")
            raise

    def work(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", spec.category)  # I4
        batch = f"{spec.category}--{query_id(spark, checkpoint)}--{batch_id}"
        rows = batch_df.persist()           # read the source once, not four times
        try:
            if rows.isEmpty():              # D3: idle trigger
                return
            if spec.kind == "uploads":
                files = Uploads(spark.read.format("binaryFile").load([r["path"] for r in rows.select("path").collect()]))
                events = files.events().persist()
                try:
                    store(spark, events.withColumn("file_modified_at", F.try_to_timestamp("timestamp")), batch)
                    append_rows(files.metadata(), f"{out}/upload_files", batch)
                    stored = spark.read.parquet(f"{out}/upload_files/batch={batch}")
                    append_rows(files.history(metadata=stored), f"{out}/upload_history", batch)
                    if cfg.publish:
                        put_in_outbox(events.withColumn("topic", F.lit(UPLOAD_TOPIC)), out, batch)
                finally:
                    events.unpersist()
            else:
                events = envelope_events(rows) if spec.kind == "envelopes" else rows
                store(spark, events, batch)
                if cfg.publish and spec.kind == "envelopes":
                    put_in_outbox(events.drop("file_modified_at", "ingest_file"), out, batch)
        finally:
            rows.unpersist()

    return handle


def envelope_events(env: DataFrame) -> DataFrame:
    """A8 + F6 + C10-C12: REST envelopes -> one unified event per record.

    The platform streamed envelopes unexploded, so a whole collection became
    one row. Here each record is exploded (empty ``data`` gives no rows) and
    normalised by the connector rules, with the envelope's target system as
    the category and its collection time as the fallback event time.
    """
    rows = explode_envelope(env, keep=["target_system", "collected_at_utc", "ingest_file",
                                       "file_modified_at"])
    category = F.regexp_replace(F.lower(F.coalesce("target_system", F.lit("rest"))), " ", "_")
    out = connector_normalize_json(rows.withColumn("__cat", category), "record", F.col("__cat"),
                                   fallback_time=F.coalesce(F.try_to_timestamp("collected_at_utc"),
                                                            F.col("file_modified_at")))
    return out.withColumn("topic", F.lit(UPLOAD_TOPIC))


def source_frame(spark: SparkSession, spec: SourceSpec, cfg: StreamConfig, schema=UNIFIED_EVENT) -> DataFrame:
    """The stream of one source: events, REST envelopes, or the files of an upload folder (without their content)."""
    path = f"{cfg.landing_root.rstrip('/')}/{spec.path}"
    if spec.kind == "uploads":
        # every file of the folder, so that one of another type leaves a row that says so
        return stream_binary(spark, path, None, cfg.max_files_per_trigger).drop("content")
    schema = REST_ENVELOPE if spec.kind == "envelopes" else schema
    return open_source(spark, spec, cfg.landing_root, schema, streaming=True,
                       max_files=cfg.max_files_per_trigger, multiline=cfg.json_multiline)


def start_source(spark: SparkSession, spec: SourceSpec, cfg: StreamConfig,
                 schema=UNIFIED_EVENT) -> StreamingQuery:
    """A1/A2 + I1-I4: start one named query with its checkpoint and trigger."""
    checkpoint = checkpoint_location(spark, cfg, spec)
    refuse_second_start(spark, cfg, spec)
    rows = source_frame(spark, spec, cfg, schema)
    if cfg.drop_repeats and spec.kind == "events":
        rows = drop_repeats(rows, cfg.drop_repeats)
    w = (rows.writeStream
         .queryName(f"query_{spec.category}")
         .foreachBatch(make_batch_handler(spec, cfg, checkpoint))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if cfg.trigger_seconds is None \
        else w.trigger(processingTime=f"{cfg.trigger_seconds} seconds")
    return w.start()


def start_all(spark: SparkSession, specs, cfg: StreamConfig, schemas: dict | None = None
              ) -> tuple[list[StreamingQuery], list[SourceSpec]]:
    """Start every source whose folder is there: (queries, sources that wait for theirs).

    Any other failure raises. Call it again with the waiting sources later. Each
    query's batches run in the scheduler pool named after its category; build
    the session with ``spark.scheduler.mode=FAIR`` (a static setting) for the
    pools to share the cluster fairly.
    """
    started, waiting = [], []
    for s in specs:
        if not fs.exists(spark, f"{cfg.landing_root.rstrip('/')}/{s.path}"):
            waiting.append(s)
            continue
        try:
            started.append(start_source(spark, s, cfg, (schemas or {}).get(s.category, UNIFIED_EVENT)))
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):     # the folder went in between
                raise
            waiting.append(s)
    return started, waiting


def stop_all(queries: list[StreamingQuery]) -> None:
    """Graceful stop (each query finishes its current batch)."""
    for q in queries:
        if q.isActive:
            q.stop()


# ---------------------------------------------------------------------------
# Windows (I7)
# ---------------------------------------------------------------------------
def event_time_column(df: DataFrame) -> Column:
    """TIMESTAMP event time for a stream (TIMESTAMP_NTZ is cast; strings parsed)."""
    return resolve_event_time(df, F.col("file_modified_at") if "file_modified_at" in df.columns else None)


def hourly_window_counts(df: DataFrame, delay: str = "1 hour", by: list[str] | None = None) -> DataFrame:
    """I7 / E4 as a stream: tumbling 1-hour windows with a watermark.

    In append mode a window is emitted once the watermark passes its end;
    rows later than the watermark are dropped by Spark (bounded state).
    """
    ts = event_time_column(df)
    g = (df.withColumn("__event_ts", ts).withWatermark("__event_ts", delay)
         .groupBy(F.window("__event_ts", "1 hour").alias("w"), *(by or [])))
    return g.agg(F.count(F.lit(1)).alias("events")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *(by or []), "events")

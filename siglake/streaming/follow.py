"""Queries that follow what the landing-zone job has stored: live hourly panels (E4, I7) and the outbox.

Batches are staged and moved to their places once (``sinks.tables.write_batch``),
so their files keep their names and a file stream over them sees each one once,
however often the batch that wrote it is retried. Every follower has a checkpoint
of its own, so a slow one delays nobody.

Hourly panels are kept by signed changes. The newest time of every event is state
(RocksDB in ``python -m siglake stream``); a newer version that falls into another
hour takes one from the old hour and adds one to the new. A batch costs what it
holds, whatever the age of the table. Rows of one id are reduced to one in each
Arrow batch before the shuffle, so an id that holds a third of all rows sends a
row for each batch of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from siglake.functions.timeparse import wall_clock
from siglake.operators.dedup import event_key
from siglake.sinks import fs
from siglake.sinks.landing import MESSAGE
from siglake.sinks.tables import FOLDED, append_rows, has_table, stream_stored
from siglake.streaming.job import StreamConfig, follower_checkpoint, outbox_path, query_id

HOUR = 3_600_000_000          # microseconds
NO_TIME = -(2 ** 63)          # the time of a row without one: older than any, an hour of its own
NO_ID = "\x00"                # such keys are groups of rows without an id; they keep no state
SPREAD = 256                  # groups that rows without an id are spread over
_SEEN = "key string, slot long, at long, n long"


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each key (and hour, where there is no id) of an Arrow batch."""
    for b in batches:
        t = pa.Table.from_batches([b]).group_by(["key", "slot"]).aggregate([("at", "max"), ("n", "sum")])
        t = t.rename_columns({"at_max": "at", "n_sum": "n"}).select(["key", "slot", "at", "n"])
        yield from t.combine_chunks().to_batches()


def _changes(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The signed changes that the rows of one key make: (hour, change)."""
    if key[0].startswith(NO_ID):                      # each row is an event of its own
        for f in frames:
            yield f.groupby("slot", as_index=False)["n"].sum().rename(columns={"slot": "hour", "n": "change"})
        return
    old = state.get[0] if state.exists else None
    new = max(int(f["at"].max()) for f in frames)
    if old is not None and new <= old:
        return
    state.update((new,))
    hours = [(_hour(new), 1)] if old is None else [(_hour(old), -1), (_hour(new), 1)]
    if len(hours) == 1 or hours[0][0] != hours[1][0]:
        yield pd.DataFrame(hours, columns=["hour", "change"])


def _hour(at: int) -> int:
    return at if at == NO_TIME else at - at % HOUR


def hourly_changes(stored: DataFrame) -> DataFrame:
    """Stored rows (a stream, with their ``batch``) -> (hour in microseconds, change).

    The newest time of an id counts, as in ``newest_events``. A compaction writes
    rows again: known ids change nothing, and rows without an id count only from the
    batch that brought them.
    """
    at = F.coalesce(F.unix_micros("event_timestamp"), F.lit(NO_TIME))
    seen = stored.select("batch", event_key(stored).alias("id"), at.alias("at"), "ingest_file")
    seen = seen.where(F.col("id").isNotNull() | ~F.col("batch").startswith(FOLDED))
    hour = F.when(F.col("at") == NO_TIME, F.col("at")).otherwise(F.col("at") - F.pmod("at", F.lit(HOUR)))
    group = F.concat(F.lit(NO_ID), F.pmod(F.xxhash64("batch", "ingest_file", "at"), F.lit(SPREAD)).cast("string"))
    rows = seen.select(F.coalesce("id", group).alias("key"), F.when(F.col("id").isNull(), hour).otherwise(0).alias("slot"),
                       "at", F.lit(1).cast("long").alias("n"))
    return (rows.mapInArrow(_reduced, _SEEN).groupBy("key")
            .applyInPandasWithState(_changes, "hour long, change long", "at long", "update", GroupStateTimeout.NoTimeout))


def hourly_path(output: str, table: str) -> str:
    return f"{output.rstrip('/')}/hourly/table={table}"


def _start(cfg: StreamConfig, df: DataFrame, name: str, checkpoint: str, handler, mode: str) -> StreamingQuery:
    w = df.writeStream.queryName(name).outputMode(mode).foreachBatch(handler).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if cfg.trigger_seconds is None \
        else w.trigger(processingTime=f"{cfg.trigger_seconds} seconds")
    return w.start()


def start_hourly(spark: SparkSession, cfg: StreamConfig, table: str) -> StreamingQuery:
    """Keep the hourly counts of one table. A retried batch replaces the changes it wrote.

    Run it before ``compact`` where rows come without an id: those of a batch that
    was folded unseen are not counted.
    """
    checkpoint = follower_checkpoint(spark, cfg, f"hourly_{table}")

    def keep(changes: DataFrame, batch_id: int) -> None:
        s = changes.sparkSession
        net = changes.groupBy("hour").agg(F.sum("change").alias("change")).where("change <> 0")
        append_rows(net, hourly_path(cfg.output_root, table), f"{query_id(s, checkpoint)}--{batch_id}")

    stored = stream_stored(spark, cfg.output_root, table, cfg.max_files_per_trigger)
    return _start(cfg, hourly_changes(stored), f"hourly_{table}", checkpoint, keep, "update")


def read_hourly(spark: SparkSession, output: str, table: str, count_alias: str = "count") -> DataFrame:
    """E4 from the kept changes: events per hour, ordered; the rows of ``panel_hourly``."""
    kept = spark.read.schema("hour long, change long").parquet(hourly_path(output, table))
    at = wall_clock(F.when(F.col("hour") != NO_TIME, F.timestamp_micros("hour")))
    return (kept.groupBy("hour").agg(F.sum("change").alias(count_alias)).where(F.col(count_alias) != 0)
            .select(at.alias("time"), count_alias).orderBy("time"))


def start_outbox(spark: SparkSession, cfg: StreamConfig) -> StreamingQuery:
    """Publish the messages of committed batches, each batch once however often it is retried.

    A failure while messages are being sent repeats this query's own batch: the keys
    are the event ids, by which consumers can tell.
    """
    messages = (spark.readStream.schema(MESSAGE).option("maxFileAge", "36500d")
                .option("maxFilesPerTrigger", cfg.max_files_per_trigger).parquet(outbox_path(cfg.output_root)))
    return _start(cfg, messages, "outbox", follower_checkpoint(spark, cfg, "outbox"),
                  lambda df, _: cfg.publish(df.select("key", "topic", "value")), "append")


def start_followers(spark: SparkSession, cfg: StreamConfig, tables, running=()) -> list[StreamingQuery]:
    """Start the followers that the configuration asks for, have something to follow and do not run yet."""
    names = {q.name for q in running if q.isActive}
    out = []
    if cfg.hourly:
        out += [start_hourly(spark, cfg, t) for t in dict.fromkeys(tables)
                if f"hourly_{t}" not in names and has_table(spark, cfg.output_root, t)]
    if cfg.publish and "outbox" not in names and fs.exists(spark, outbox_path(cfg.output_root)):
        out.append(start_outbox(spark, cfg))
    return out

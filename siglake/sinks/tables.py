"""Table sinks.

Serving tables have one layout, whoever writes them:

    <output>/table=<table>/batch=<batch>/event_date=<yyyy-MM-dd>/part-*.parquet

``materialize`` writes the batch ``base``; a stream writes one batch per
micro-batch, named by its source, its query's id and the batch id, so a retry
finds its own folder and a new query never writes into an old one's.
``read_serving`` gives a table with the newest row of each id over all batches;
``compact`` folds the dates that new batches touch, and leaves the others as they are.

Writes raise on failure (the platform logged and swallowed them, which lost
rows while the stream checkpoint advanced).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siglake.operators.aggregates import time_slice
from siglake.operators.dedup import event_key, newest_events
from siglake.schemas import CANONICAL_EVENT
from siglake.sinks import fs

BASE = "base"            # the batch that ``materialize`` writes
FOLDED = "folded-"       # batches that ``compact`` writes; together they hold each id once
_REPLACES = "_replaces"  # in such a batch: what it stands for and is still to be removed
NULL_DATE = "__HIVE_DEFAULT_PARTITION__"
# Point lookups (D6): a Parquet Bloom filter of the ids in each row group, no larger than they need.
_BLOOM = {"parquet.bloom.filter.adaptive.enabled": "true"}
_STORED = T.StructType([*CANONICAL_EVENT.fields, T.StructField("batch", T.StringType())])


def table_path(output: str, table: str) -> str:
    return f"{output.rstrip('/')}/table={table}"


def id_options(df: DataFrame, id_col: str) -> dict[str, str]:
    """Write options that index ``id_col`` for point lookups; none if there is no such column."""
    return {**_BLOOM, f"parquet.bloom.filter.enabled#{id_col}": "true"} if id_col in df.columns else {}


def write_partitioned(df: DataFrame, path: str, mode: str = "append",
                      partition_col: str = "event_date", id_col: str = "event_id") -> None:
    """B1: parquet partitioned by ``event_date``.

    Rows are clustered by the partition column first so each task writes
    few, large files per date instead of one small file per (task, date).
    The REBALANCE hint (not a plain hash repartition) lets AQE split a date
    that holds a large share of the rows across several tasks.

    The sort that partitioned writes need anyway goes on to the id, so row groups hold
    narrow ranges of ids; with their Bloom filters a lookup skips nearly all of them.
    """
    rows = df.hint("rebalance", partition_col)
    if id_col in df.columns:
        rows = rows.sortWithinPartitions(partition_col, id_col)
    rows.write.mode(mode).partitionBy(partition_col).options(**id_options(df, id_col)).parquet(path)


def write_batch(df: DataFrame, output: str, table: str, batch: str) -> str:
    """Exactly-once form of B1: ``df`` is staged and moved to the folder of ``batch`` once. Returns it.

    A retry leaves what is there, so files that others follow never change their names.
    """
    spark, path = df.sparkSession, f"{table_path(output, table)}/batch={batch}"
    staging = f"{output.rstrip('/')}/_staging/{uuid.uuid4().hex}"
    write_partitioned(df, staging, mode="overwrite")
    if not fs.publish(spark, staging, path):
        fs.delete(spark, staging)
    return path


def stream_stored(spark: SparkSession, output: str, table: str, max_files: int) -> DataFrame:
    """The stored rows of a table as a stream, repeats included.

    A file that a compaction took away since it was listed is passed over: its rows
    come with the folded batch.
    """
    return (spark.readStream.schema(_STORED).option("maxFilesPerTrigger", max_files).option("maxFileAge", "36500d")
            .option("ignoreMissingFiles", True).parquet(table_path(output, table)))


def read_stored(spark: SparkSession, output: str, table: str) -> DataFrame:
    """All stored rows of a table with their ``batch``, repeats of later batches included.

    The canonical schema is given, so ``event_date`` stays a ``yyyy-MM-dd``
    string; filters on it prune folders.
    """
    path = table_path(output, table)
    return spark.read.schema(_STORED).option("basePath", path).parquet(path)


def _folded(spark: SparkSession, path: str, names: list[str]) -> bool:
    """Whether the batches hold each id once: a single one, or those of finished compactions."""
    if len(names) == 1:
        return not fs.exists(spark, f"{path}/{names[0]}/{_REPLACES}")
    return all(n.startswith(f"batch={FOLDED}") and not fs.exists(spark, f"{path}/{n}/{_REPLACES}") for n in names)


def read_serving(spark: SparkSession, output: str, table: str, columns: list[str] | None = None,
                 since=None, until=None) -> DataFrame:
    """A serving table: the newest row of each id over all batches, by the same rule as in batch.

    With ``since`` / ``until`` only events of that time are returned, and only ids
    that some batch holds within these dates are folded: the ids come from a scan of
    the dates' folders and reduce the scan of all batches by a semi-join. Batches
    that hold each id once are read as they are, the dates' folders alone.
    """
    path = table_path(output, table)
    stored = read_stored(spark, output, table).drop("batch")
    wanted = CANONICAL_EVENT.fieldNames() if columns is None else list(columns)
    bounded = since is not None or until is not None
    if _folded(spark, path, fs.folders(spark, path)):
        return time_slice(stored, since, until).select(*wanted)
    if not bounded:
        return newest_events(stored, wanted)
    key = "__id"
    keyed = stored.withColumn(key, event_key(stored))
    asked = time_slice(keyed, since, until)
    ids = asked.where(F.col(key).isNotNull()).select(key).distinct()
    keep = list(dict.fromkeys([*wanted, "event_timestamp", "event_date"]))
    folded = newest_events(keyed.join(ids, key, "left_semi").drop(key), keep)
    # a row without an id is an event of its own
    alone = asked.where(F.col(key).isNull()).select(*keep)
    return time_slice(folded, since, until).unionByName(alone).select(*wanted)


def stored_with_id(spark: SparkSession, output: str, table: str, value: str) -> DataFrame:
    """The stored rows of one event, all versions.

    Two scans, each with a filter that Parquet can test by row group: rows of that
    ``event_id`` (ranges, Bloom filters), and rows without one (null counts) whose
    payload names the id. As one OR neither index could rule a row group out.
    """
    stored = read_stored(spark, output, table)
    named = (F.col("event_id") == F.lit(value)) & (F.col("event_id") != "")
    unnamed = (F.col("event_id").isNull() | (F.col("event_id") == "")) & (event_key(stored) == F.lit(value))
    return stored.where(named).unionByName(stored.where(unnamed))


def lookup_event(spark: SparkSession, output: str, table: str, value: str,
                 columns: list[str] | None = None) -> DataFrame:
    """D6 on a serving table: the newest version of one event, or no row ("not found")."""
    wanted = CANONICAL_EVENT.fieldNames() if columns is None else list(columns)
    return newest_events(stored_with_id(spark, output, table, value).drop("batch"), wanted)


def has_table(spark: SparkSession, output: str, table: str) -> bool:
    return bool(fs.folders(spark, table_path(output, table)))


def compact(spark: SparkSession, output: str, table: str, name: str | None = None) -> int:
    """Fold the dates that new batches touch; returns how many new batches there were.

    Touched are the dates of the new batches and those where earlier compactions
    keep an older row of an id that occurs in them; the files of other dates stay.
    Run it while no stream writes the table. The folded dates are staged and
    published as one batch, with a list of the folders that it stands for; these go
    only then, so a reader in between sees repeats (which ``read_serving`` folds)
    and never misses rows, and a rerun after a crash first finishes the list.

    ``name``: the catalog table over these folders (``register_batch``). It gets the
    new partitions before it loses the old ones.
    """
    path = table_path(output, table)
    for done in [n for n in fs.folders(spark, path) if fs.exists(spark, f"{path}/{n}/{_REPLACES}")]:
        _settle(spark, output, table, done, name)
    names = fs.folders(spark, path)
    new = [n for n in names if not n.startswith(f"batch={FOLDED}")]
    if not new or len(names) == 1:
        return len(new)
    stored = read_stored(spark, output, table)
    fresh = F.col("batch").isin([n.split("=", 1)[1] for n in new])
    dates = {r[0] for r in stored.where(fresh).select("event_date").distinct().collect()}
    if len(new) < len(names):
        key = "__id"
        keyed = stored.select("batch", "event_date", event_key(stored).alias(key))
        ids = keyed.where(fresh & F.col(key).isNotNull()).select(key).distinct()
        older = keyed.where(~fresh).join(ids, key, "left_semi").select("event_date").distinct()
        dates |= {r[0] for r in older.collect()}                     # a row for each date
    days = sorted(d for d in dates if d is not None)
    touched = F.col("event_date").isin(days) | (F.col("event_date").isNull() if None in dates else F.lit(False))
    rows = newest_events(stored.drop("batch").where(touched), CANONICAL_EVENT.fieldNames())
    staging = f"{output.rstrip('/')}/_staging/{uuid.uuid4().hex}"
    write_partitioned(rows, staging, mode="overwrite")
    gone = list(new)
    folders = {f"event_date={d}" for d in days} | ({f"event_date={NULL_DATE}"} if None in dates else set())
    for n in names:
        if n not in new:
            gone += [f"{n}/{d}" for d in fs.folders(spark, f"{path}/{n}") if d in folders]
    spark.createDataFrame([(g,) for g in gone], "value string").coalesce(1).write.text(f"{staging}/{_REPLACES}")
    batch = f"batch={FOLDED}{uuid.uuid4().hex}"
    fs.publish(spark, staging, f"{path}/{batch}")
    _settle(spark, output, table, batch, name)
    return len(new)


def _settle(spark: SparkSession, output: str, table: str, batch: str, name: str | None) -> None:
    """Register a published compaction and remove what it stands for."""
    path = table_path(output, table)
    listed = f"{path}/{batch}/{_REPLACES}"
    gone = [r["value"] for r in spark.read.text(listed).collect()]   # a row for each folder
    if name is not None:
        register_batch(spark, name, output, table, batch.split("=", 1)[1])
        old = [g if "/" in g else f"{g}/{d}" for g in gone for d in ([""] if "/" in g else fs.folders(spark, f"{path}/{g}"))]
        for part in sorted({g for g in old if "/event_date=" in g}):
            held, date = part.split("/", 1)
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (batch='{held.split('=', 1)[1]}', {_date_spec(date)})")
    for g in gone:
        fs.delete(spark, f"{path}/{g}")
    for held in sorted({g.split("/", 1)[0] for g in gone if "/" in g}):
        if not fs.folders(spark, f"{path}/{held}"):
            fs.delete(spark, f"{path}/{held}")
    fs.delete(spark, listed)


def _date_spec(folder: str) -> str:
    date = folder.split("=", 1)[1]
    return "event_date=NULL" if date == NULL_DATE else f"event_date='{date}'"


def ensure_namespace(spark: SparkSession, namespace: str) -> None:
    """``CREATE NAMESPACE IF NOT EXISTS``."""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")


def create_table(spark: SparkSession, name: str, schema=CANONICAL_EVENT,
                 partition_col: str | None = "event_date", location: str | None = None) -> None:
    """B2: create the serving table once, up front, with the canonical schema.

    No per-batch existence check and no create-on-first-write race: the
    schema never depends on which batch arrived first.
    """
    if spark.catalog.tableExists(name):
        return
    empty = spark.createDataFrame([], schema)
    w = empty.write.format("parquet")
    if partition_col:
        w = w.partitionBy(partition_col)
    if location:
        w = w.option("path", location)
    w.saveAsTable(name)


def append_table(df: DataFrame, name: str, v2: bool = False) -> None:
    """B2: append by column name into an existing table.

    ``v2=True`` uses the DataFrameWriterV2 API (``writeTo(name).append()``),
    the path for v2 catalogs such as an Iceberg catalog; Spark refuses it for
    v1 tables of the built-in session catalog.
    """
    cols = df.sparkSession.table(name).columns
    if v2:
        df.select(*cols).writeTo(name).append()
    else:
        df.select(*cols).write.insertInto(name)


def register_batch(spark: SparkSession, name: str, output: str, table: str, batch: str) -> None:
    """B2: the catalog table over a serving folder, created once, with the partitions of one batch added.

    The rows stay where ``write_batch`` put them (repeats of later batches
    included). Only the written batch's folder is listed, so the cost of a batch
    does not grow with the table's age, and a retry adds nothing twice.
    """
    path = table_path(output, table)
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _STORED.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
              f"PARTITIONED BY (batch, event_date) LOCATION '{path}'")
    dates = [d for d in fs.folders(spark, f"{path}/batch={batch}") if d.startswith("event_date=")]
    if dates:
        spec = " ".join(f"PARTITION (batch='{batch}', {_date_spec(d)})" for d in dates)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {spec}")


def append_rows(df: DataFrame, path: str, batch: str | None = None, id_col: str = "id") -> None:
    """History rows (audit log, upload history) as parquet, their ids indexed for lookups.

    With ``batch`` they go to a folder of their own, which a retry replaces.
    """
    options = id_options(df, id_col)
    if batch is None:
        df.write.mode("append").options(**options).parquet(path)
    else:
        df.write.mode("overwrite").options(**options).parquet(f"{path.rstrip('/')}/batch={batch}")


def delete_by_id(spark: SparkSession, path: str, tombstone_path: str, ids: list,
                 id_col: str = "id") -> int:
    """Delete history rows by id on plain parquet.

    Parquet cannot delete in place, so a tombstone row is appended and
    ``read_live`` hides tombstoned ids with a ``left_anti`` join. Returns how
    many of the ids existed (0 means "not found").
    """
    hist = spark.read.parquet(path)
    found = hist.where(F.col(id_col).isin(ids)).select(id_col).distinct()
    n = found.count()
    if n:
        found.write.mode("append").parquet(tombstone_path)
    return n


def read_live(spark: SparkSession, path: str, tombstone_path: str, id_col: str = "id") -> DataFrame:
    """History rows minus tombstoned ids (the anti-join side is id-only; none once ``settle_deletes`` has run)."""
    hist = spark.read.parquet(path)
    if not fs.files(spark, tombstone_path):
        return hist
    return hist.join(spark.read.parquet(tombstone_path).select(id_col), id_col, "left_anti")

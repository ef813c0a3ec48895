"""Deletes that are settled (B9): the files that hold deleted history rows are written anew.

``delete_by_id`` appends tombstones and ``read_live`` hides their ids with an anti-join
on every read. ``settle_deletes`` takes the tombstoned rows out of the files that hold
them, so that a settled history is read as it is.

    <history>/_settling/rows/__home=<i>/part-*.parquet    what such files keep, by their folder
    <history>/_settling/journal/                          the files that go, their folders, the tombstones read

Both are staged and published by one rename. From then on the work is decided: a rerun
after a crash carries it out. Run it while nothing else deletes or settles the same
history. Appends may go on. A reader between two steps may see a kept row of these
files twice; it never misses one, and never sees a deleted one (tombstones go last).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siglake.sinks import fs
from siglake.sinks.tables import id_options

_FILE, _HOME = "__file", "__home"
_JOURNAL = "kind string, path string, home int"


def _plain(url: str, spark: SparkSession) -> str:
    """A file's path as readers take it; Spark names files by URL."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(url)).toString()


def _folder(path: str) -> str:
    return path.rsplit("/", 1)[0]


def settle_deletes(spark: SparkSession, path: str, tombstone_path: str, id_col: str = "id") -> int:
    """Take the tombstoned rows out of a history; returns how many files were written anew.

    Found by ``_metadata.file_path`` in a scan of the ids alone; files without a
    tombstoned row are not touched. Rows without an id stay.
    """
    root = path.rstrip("/")
    _finish(spark, root, tombstone_path)
    if not fs.files(spark, tombstone_path):
        return 0
    dead_files = [_plain(f, spark) for f in spark.read.parquet(tombstone_path).inputFiles()]
    dead = spark.read.parquet(*dead_files).select(id_col).distinct()
    hist = spark.read.parquet(root)
    held = (hist.select(id_col, F.col("_metadata.file_path").alias(_FILE))
            .join(dead, id_col, "left_semi").select(_FILE).distinct())
    urls = sorted(r[_FILE] for r in held.collect())                    # a row for each file to be written anew
    gone = [_plain(u, spark) for u in urls]
    homes = sorted({_folder(g) for g in gone})
    work = f"{root}/_settling-{uuid.uuid4().hex}"
    if gone:
        every = {_plain(f, spark) for f in hist.inputFiles()}
        _write_kept(spark, gone, urls, homes, dead, f"{work}/rows", id_col, last=every == set(gone))
    journal = ([("file", g, homes.index(_folder(g))) for g in gone] + [("home", h, i) for i, h in enumerate(homes)]
               + [("tombstones", t, None) for t in dead_files])
    spark.createDataFrame(journal, _JOURNAL).coalesce(1).write.json(f"{work}/journal")
    if not fs.publish(spark, work, f"{root}/_settling"):
        fs.delete(spark, work)
        raise RuntimeError(f"{root} is being settled by another job")
    _finish(spark, root, tombstone_path)
    return len(gone)


def _write_kept(spark: SparkSession, gone: list[str], urls: list[str], homes: list[str], dead: DataFrame,
                target: str, id_col: str, last: bool) -> None:
    # files only, so that no column comes from a folder's name; every column that any of them has
    rows = spark.read.option("mergeSchema", True).parquet(*gone)
    where = spark.createDataFrame([(u, homes.index(_folder(g))) for u, g in zip(urls, gone)], f"{_FILE} string, {_HOME} int")
    kept = (rows.select("*", F.col("_metadata.file_path").alias(_FILE)).join(where, _FILE).drop(_FILE)
            .join(dead, id_col, "left_anti").select(*rows.columns, _HOME))
    options = id_options(rows, id_col)
    kept.hint("rebalance", _HOME).write.partitionBy(_HOME).options(**options).parquet(target)
    if last and not fs.folders(spark, target):
        # nothing is left of the history but its columns
        rows.limit(0).coalesce(1).write.parquet(f"{target}/{_HOME}=0")


def _finish(spark: SparkSession, root: str, tombstone_path: str) -> None:
    """Carry out what is published under ``_settling``, wherever an earlier run stopped."""
    place = f"{root}/_settling"
    if not fs.exists(spark, place):
        return
    todo = spark.read.schema(_JOURNAL).json(f"{place}/journal").collect()   # a row for each file
    for home in (r for r in todo if r["kind"] == "home"):
        staged = f"{place}/rows/{_HOME}={home['home']}"
        for name in fs.files(spark, staged):
            fs.move(spark, f"{staged}/{name}", f"{home['path']}/{name}")
    for kind in ("file", "tombstones"):
        for r in todo:
            if r["kind"] == kind:
                fs.delete(spark, r["path"])
    if not fs.files(spark, tombstone_path):
        fs.delete(spark, tombstone_path)
    fs.delete(spark, place)

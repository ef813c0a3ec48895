"""Point lookups, deep pages and settled deletes on stored tables."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from siglake.schemas import CANONICAL_EVENT
from siglake.sinks import fs, history
from siglake.sinks.pages import build_page_index, read_page
from siglake.sinks.tables import (append_rows, delete_by_id, lookup_event, read_live, read_stored, stored_with_id,
                                  table_path, write_batch)


def canonical(spark, rows):
    """Canonical rows of (event_id, payload, time, node); every other column NULL."""
    df = spark.createDataFrame(rows, "event_id string, payload string, t string, node_id string")
    known = {"event_id": F.col("event_id"), "payload": F.col("payload"), "node_id": F.col("node_id"),
             "event_timestamp": F.to_timestamp("t"), "event_date": F.substring("t", 1, 10)}
    return df.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CANONICAL_EVENT.fields])


def rows_scanned(df):
    """(rows, row counts of the file scans) of a frame whose plan has no exchange."""
    out, counts = df.collect(), []

    def walk(plan):
        if "FileScan" in plan.simpleString(25):
            counts.append(plan.metrics().apply("numOutputRows").value())
        for i in range(plan.children().size()):
            walk(plan.children().apply(i))
    walk(df._jdf.queryExecution().executedPlan())
    return out, counts


def test_a_lookup_reads_the_row_groups_of_one_file(spark, scratch):
    files, each = 100, 40
    rows = (spark.range(files * each).select(
        F.concat(F.lit("E"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("event_id"),
        (F.col("id") % files).cast("int").alias("k")))
    # ids are dealt over all files, so ranges of ids rule no file out: the Bloom filters do
    folder = os.path.join(scratch, "hist")
    append_rows(rows.repartition(files, "k").select(F.col("event_id").alias("id"), "k"), folder)
    found, scanned = rows_scanned(spark.read.parquet(folder).where("id = 'E001234'"))
    held = spark.read.parquet(folder).where("id = 'E001234'").select("_metadata.file_path").first()[0]
    one_file = spark.read.parquet(folder).where(F.col("_metadata.file_path") == held).count()
    assert [r["id"] for r in found] == ["E001234"]
    assert len(spark.read.parquet(folder).inputFiles()) > 40
    assert sum(scanned) <= 2 * one_file < files * each       # a Bloom filter may err for one more
    missing, scanned = rows_scanned(spark.read.parquet(folder).where("id = 'E9'"))
    assert missing == [] and sum(scanned) <= one_file


def test_lookup_of_an_event_over_batches(spark, scratch):
    ids = [(f"E{i:04d}", None, "2024-01-01 00:00:00", f"n{i}") for i in range(300)]
    write_batch(canonical(spark, ids), scratch, "alarms", "a")
    late = [("E0007", None, "2024-01-03 00:00:00", "newer"), (None, '{"ticket_id": "T1"}', "2024-01-03 00:00:00", "by ticket"),
            ("", '{"ticket_id": "T1"}', "2024-01-04 00:00:00", "by ticket, newer"), (None, None, "2024-01-04 00:00:00", "no id")]
    write_batch(canonical(spark, late), scratch, "alarms", "b")
    write_batch(canonical(spark, [("T1", None, "2024-01-02 00:00:00", "named")]), scratch, "alarms", "c")

    def look(value):
        return [r["node_id"] for r in lookup_event(spark, scratch, "alarms", value).collect()]
    assert look("E0007") == ["newer"] and look("E0008") == ["n8"]
    assert look("T1") == ["by ticket, newer"]
    assert look("E9999") == [] and look("") == [] and look(None) == []
    found, scanned = rows_scanned(stored_with_id(spark, scratch, "alarms", "E0150"))
    assert len(found) == 1
    assert sum(scanned) <= 300 + 4                            # its own file; rows without an id are in one other
    assert read_stored(spark, scratch, "alarms").count() == 305


def test_stored_files_are_sorted_by_id_within_a_date(spark, scratch):
    rows = [(f"E{(i * 37) % 200:04d}", None, f"2024-01-0{1 + i % 2} 00:00:00", "n") for i in range(200)]
    write_batch(canonical(spark, rows), scratch, "alarms", "a")
    for f in spark.read.parquet(table_path(scratch, "alarms")).inputFiles():
        ids = [r[0] for r in spark.read.parquet(f).select("event_id").collect()]
        assert ids == sorted(ids)


def test_deep_pages_equal_brute_force(spark, scratch):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, None if i % 3 == 0 else base + dt.timedelta(minutes=i // 10), f"f{i}") for i in range(1000)]
    rows += [(5, base, "twice a"), (5, base, "twice b")]
    df = spark.createDataFrame(rows, "id long, created_at timestamp_ntz, filename string").repartition(7)
    path = os.path.join(scratch, "index")
    assert build_page_index(df, path, rows_per_part=90) == len(rows)
    dated = sorted((r for r in rows if r[1] is not None), key=lambda r: (r[1], r[0]), reverse=True)
    want = dated + sorted((r for r in rows if r[1] is None), key=lambda r: -r[0])
    got = []
    for page in range(0, 1010, 50):
        got += [tuple(r) for r in read_page(spark, path, 50, page).collect()]
    assert [r[:2][::-1] for r in got] == [r[:2][::-1] for r in want]           # every page, ties by id
    assert sorted(got, key=str) == sorted(rows, key=str)
    assert read_page(spark, path, 50, 5000).count() == 0
    parts = spark.read.parquet(f"{path}/parts").collect()
    assert len(parts) > 5 and max(p["n"] for p in parts) < 400
    plan = read_page(spark, path, 10, 500)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [__part" in plan and "TakeOrderedAndProject" in plan
    with pytest.raises(FileExistsError):
        build_page_index(df, path)


def test_page_index_of_an_empty_table(spark, scratch):
    path = os.path.join(scratch, "index")
    df = spark.createDataFrame([], "id long, created_at timestamp_ntz")
    assert build_page_index(df, path) == 0
    assert read_page(spark, path, 10).columns == ["id", "created_at"] and read_page(spark, path, 10, 3).count() == 0


def settled_case(spark, scratch):
    h, t = os.path.join(scratch, "a folder", "h"), os.path.join(scratch, "a folder", "tomb")
    for batch, ids in [("one", [1, 2, None]), ("two", [3, 4]), ("three", [5])]:
        append_rows(spark.createDataFrame([(i, f"{i}.csv") for i in ids], "id long, filename string").coalesce(1), h, batch)
    assert delete_by_id(spark, h, t, [2, 5]) == 2
    return h, t


def contents(spark, h, t):
    return sorted((r["batch"], r["id"] or 0, r["filename"]) for r in read_live(spark, h, t).collect())


def test_settled_deletes_rewrite_only_their_files(spark, scratch):
    h, t = settled_case(spark, scratch)
    before, files = contents(spark, h, t), set(spark.read.parquet(h).inputFiles())
    other = [f for f in files if "batch=two" in f]
    assert history.settle_deletes(spark, h, t) == 2
    assert contents(spark, h, t) == before
    assert not os.path.exists(t)                                        # so no anti-join is left
    assert "LeftAnti" not in read_live(spark, h, t)._jdf.queryExecution().optimizedPlan().toString()
    assert set(spark.read.parquet(h).inputFiles()) & files == set(other)
    assert history.settle_deletes(spark, h, t) == 0
    assert delete_by_id(spark, h, t, [1, 3, 4]) == 3                      # only the row without an id stays
    assert history.settle_deletes(spark, h, t) == 2
    assert contents(spark, h, t) == [("one", 0, "None.csv")]


@pytest.mark.parametrize("stop", range(7))
def test_a_rerun_finishes_what_a_crash_left(spark, scratch, monkeypatch, stop):
    h, t = settled_case(spark, scratch)
    before, steps = contents(spark, h, t), []

    def dying(step):
        def run(*args):
            if len(steps) == stop:
                raise KeyboardInterrupt("lost driver")
            steps.append(args)
            return step(*args)
        return run
    with monkeypatch.context() as m:
        for name in ("publish", "move", "delete"):
            m.setattr(fs, name, dying(getattr(fs, name)))
        with pytest.raises(KeyboardInterrupt):
            history.settle_deletes(spark, h, t)
    seen = contents(spark, h, t)
    assert set(seen) == set(before)                            # none missed, none deleted comes back
    history.settle_deletes(spark, h, t)
    assert contents(spark, h, t) == before and not os.path.exists(t)


def test_a_history_of_which_nothing_stays_keeps_its_columns(spark, scratch):
    h, t = os.path.join(scratch, "h"), os.path.join(scratch, "tomb")
    append_rows(spark.createDataFrame([(1, "a"), (2, "b")], "id long, filename string"), h)
    delete_by_id(spark, h, t, [1, 2])
    history.settle_deletes(spark, h, t)
    assert spark.read.parquet(h).columns == ["id", "filename"] and spark.read.parquet(h).count() == 0

"""Structured Streaming: stream == batch == panels, repeats, restart and retry, windows, uploads."""

import json
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, write_file
from siglake.sources.files import SOURCES, read_json
from siglake.schemas import UNIFIED_EVENT
from siglake.sinks.tables import compact, read_serving, read_stored
from siglake.streaming import follow, job, monitor


def _event(i, ts, sev="MAJOR", vendor="Nokia"):
    return {"event_id": f"ALM-{i}", "source": "Alarm Events", "event_type": "LinkDown",
            "timestamp": ts, "severity": sev, "node_id": f"T-{i % 3}", "region": "R1",
            "payload": {"vendorName": vendor}}


def _land(root, name, events):
    write_file(root, f"raw/kafka/category=alarms/{name}.json", json.dumps(events))


def _cfg(scratch, **kw):
    return job.StreamConfig(landing_root=os.path.join(scratch, "land"),
                            output_root=os.path.join(scratch, "out"),
                            checkpoint_root=os.path.join(scratch, "ckpt"),
                            trigger_seconds=None, max_files_per_trigger=1, **kw)


def _run(spark, cfg, spec=SOURCES[0]):
    q = job.start_source(spark, spec, cfg)
    q.awaitTermination(120)
    assert q.exception() is None
    return q


def _stored(spark, cfg, table="alarms"):
    return read_stored(spark, cfg.output_root, table)


def test_stream_equals_batch(spark, scratch):
    land = os.path.join(scratch, "land")
    _land(land, "f1", [_event(1, "2026-08-06T10:00:00Z"), _event(2, "2026-08-06T11:30:00Z")])
    _land(land, "f2", [_event(3, "2026-08-07T00:15:00+02:00", sev="p1"), _event(3, "2026-08-06T09:00:00Z")])
    cfg = _cfg(scratch)
    listener = monitor.attach(spark)
    _run(spark, cfg)
    out = _stored(spark, cfg)
    batch = job.clean_batch(read_json(spark, os.path.join(land, "raw/kafka/category=alarms"), UNIFIED_EVENT,
                                      multiline=False), "alarms")
    cols = ["event_id", "severity_clean", "event_date", "vendor"]
    assert sorted(map(tuple, out.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))
    assert out.where("event_id = 'ALM-3'").first()["severity_clean"] == "CRITICAL"  # newest copy kept
    assert len({r["batch"] for r in out.select("batch").collect()}) == 2            # one file per trigger
    log = listener.run_log(spark)
    assert log.where("records_processed > 0").count() >= 2
    assert listener.flush(spark, os.path.join(scratch, "runlog"), at_least=1000) == 0
    n = listener.flush(spark, os.path.join(scratch, "runlog"))
    assert n >= 2 and spark.read.parquet(os.path.join(scratch, "runlog")).count() == n
    assert listener.run_log(spark).count() == 0
    spark.streams.removeListener(listener)
    audit = spark.read.parquet(os.path.join(cfg.output_root, "audit_log"))          # a row for each batch
    assert audit.count() == 2 and audit.agg(F.sum("records_count")).first()[0] == 3
    assert {r["source_type"] for r in audit.collect()} == {"alarms"}


def test_flush_keeps_rows_that_were_not_written(spark, scratch):
    listener = monitor.RunLogListener()
    listener.rows.append(("r", "q", "COMPLETED", None, None, 1, "x" * 5000))
    write_file(scratch, "file", "in the way")
    with pytest.raises(Exception):
        listener.flush(spark, os.path.join(scratch, "file", "log"))
    assert len(listener.rows) == 1
    assert listener.flush(spark, os.path.join(scratch, "log")) == 1 and listener.rows == []
    assert len(spark.read.parquet(os.path.join(scratch, "log")).first()["error"]) == 5000


def test_repeats_in_later_batches_are_folded_on_reading(spark, scratch):
    land = os.path.join(scratch, "land")
    _land(land, "f1", [_event(1, "2026-08-06T10:00:00Z"), _event(2, "2026-08-06T10:00:00Z")])
    cfg = _cfg(scratch)
    _run(spark, cfg)
    _land(land, "f2", [_event(1, "2026-08-06T10:05:00Z", sev="p1"), _event(9, "2020-01-01T00:00:00Z")])   # a late one too
    _run(spark, cfg)
    assert _stored(spark, cfg).where("event_id = 'ALM-1'").count() == 2     # stored again, as the platform does
    rows = {r["event_id"]: r["severity_clean"] for r in read_serving(spark, cfg.output_root, "alarms").collect()}
    assert rows == {"ALM-1": "CRITICAL", "ALM-2": "MAJOR", "ALM-9": "MAJOR"}
    _run(spark, cfg)   # restart with nothing new: no new output
    assert _stored(spark, cfg).count() == 4
    assert compact(spark, cfg.output_root, "alarms") == 2
    assert _stored(spark, cfg).count() == 3
    assert {r["event_id"]: r["severity_clean"] for r in read_serving(spark, cfg.output_root, "alarms").collect()} == rows
    assert compact(spark, cfg.output_root, "alarms") == 0


def _batches(spark, cfg, land, *days):
    """One micro-batch for each list of (event number, time, severity)."""
    for i, events in enumerate(days):
        _land(land, f"b{i}-{len(events)}-{events[0][1][:10]}", [_event(n, at, sev=sev) for n, at, sev in events])
        _run(spark, cfg)


def _content(df):
    return sorted((r["event_id"], r["severity_clean"], str(r["event_timestamp"]), r["event_date"]) for r in df.collect())


THREE = ([(1, "2024-03-01T10:00:00Z", "p1"), (2, "2024-03-01T11:00:00Z", "p2"), (3, "2024-03-05T09:00:00Z", "p1")],
         [(1, "2024-03-02T10:00:00Z", "p3"), (4, "2024-03-02T11:00:00Z", "p1")],
         [(4, "2024-03-01T08:00:00Z", "p2"), (2, "2024-03-03T11:00:00Z", "p1"), (5, "2024-03-03T00:00:00Z", "p1")])


def test_bounded_reading_folds_the_ids_of_its_dates(spark, scratch):
    from siglake.operators.aggregates import time_slice
    cfg, land = _cfg(scratch), os.path.join(scratch, "land")
    _batches(spark, cfg, land, *THREE)
    everything = read_serving(spark, cfg.output_root, "alarms")
    assert everything.count() == 5
    for since, until in (("2024-03-01", "2024-03-02"), ("2024-03-02", "2024-03-03"), ("2024-03-03", None), (None, "2024-03-02"),
                         ("2024-03-01 10:30:00", "2024-03-03 00:00:01"), ("2025-01-01", None)):
        got = read_serving(spark, cfg.output_root, "alarms", since=since, until=until)
        assert _content(got) == _content(time_slice(everything, since, until)), (since, until)
    # 1, 2 and 4 were on the first of March once, and moved or have a newer row elsewhere
    assert _content(read_serving(spark, cfg.output_root, "alarms", since="2024-03-01", until="2024-03-02")) == []
    got = read_serving(spark, cfg.output_root, "alarms", ["event_id"], since="2024-03-02", until="2024-03-03")
    p = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in p and p.index("Aggregate") < p.index("LeftSemi")      # the fold stands above the semi-join
    physical = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in physical


def test_compaction_by_date_keeps_other_files_and_the_catalog(spark, scratch):
    from siglake.operators.dedup import newest_events
    spark.sql("CREATE NAMESPACE IF NOT EXISTS ops_compact")
    cfg, land = _cfg(scratch, table_prefix="ops_compact."), os.path.join(scratch, "land")
    name = "ops_compact.alarms"

    def files():
        return {os.path.join(d, f) for d, _, fs in os.walk(os.path.join(cfg.output_root, "table=alarms")) for f in fs
                if f.endswith(".parquet")}

    _batches(spark, cfg, land, *THREE)
    before = _content(read_serving(spark, cfg.output_root, "alarms"))
    assert _content(newest_events(spark.table(name).drop("batch"))) == before and spark.table(name).count() == 8
    assert compact(spark, cfg.output_root, "alarms", name) == 3
    assert _content(read_serving(spark, cfg.output_root, "alarms")) == before == _content(spark.table(name))
    # a new batch moves 5 from the third to the fourth of March: other dates keep their files
    old = files()
    _batches(spark, cfg, land, [(5, "2024-03-04T00:00:00Z", "p2")])
    assert compact(spark, cfg.output_root, "alarms", name) == 1
    kept = {f for f in old if "event_date=2024-03-03" not in f}
    assert kept <= files() and len(files()) > len(kept)
    after = _content(read_serving(spark, cfg.output_root, "alarms"))
    assert after == _content(spark.table(name)) and len(after) == 5 and ("ALM-5", "MAJOR", "2024-03-04 00:00:00", "2024-03-04") in after
    # folded batches are read as they are, the asked dates alone
    plan = read_serving(spark, cfg.output_root, "alarms", since="2024-03-02", until="2024-03-03")
    assert "Aggregate" not in plan._jdf.queryExecution().optimizedPlan().toString() and plan.count() == 1 + 1
    # a new checkpoint is still refused
    cfg.checkpoint_root = os.path.join(scratch, "another")
    with pytest.raises(RuntimeError, match="checkpoint is new"):
        job.start_source(spark, SOURCES[0], cfg)


def test_a_compaction_that_was_cut_off_is_finished(spark, scratch, monkeypatch):
    from siglake.sinks import tables
    cfg, land = _cfg(scratch), os.path.join(scratch, "land")
    _batches(spark, cfg, land, *THREE)
    before = _content(read_serving(spark, cfg.output_root, "alarms"))
    with monkeypatch.context() as m:
        m.setattr(tables, "_settle", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            compact(spark, cfg.output_root, "alarms")
    assert _content(read_serving(spark, cfg.output_root, "alarms")) == before            # repeats are folded
    assert compact(spark, cfg.output_root, "alarms") == 0
    assert _content(read_serving(spark, cfg.output_root, "alarms")) == before and _stored(spark, cfg).count() == 5


def test_a_failing_batch_leaves_its_row(spark, scratch, monkeypatch):
    cfg, land = _cfg(scratch), os.path.join(scratch, "land")
    _land(land, "f1", [_event(1, "2024-03-01T10:00:00Z"), _event(2, "2024-03-01T10:00:00Z")])
    with monkeypatch.context() as m:
        m.setattr(job, "write_batch", lambda *a: (_ for _ in ()).throw(OSError("disk is full")))
        q = job.start_source(spark, SOURCES[0], cfg)
        with pytest.raises(Exception, match="disk is full"):
            q.awaitTermination(120)
    _run(spark, cfg)
    rows = {r["status"]: r for r in spark.read.parquet(os.path.join(cfg.output_root, "audit_log")).collect()}
    assert "disk is full" in rows["FAILED"]["error_message"] and rows["FAILED"]["records_count"] is None
    assert rows["SUCCESS"]["records_count"] == 2 and rows["SUCCESS"]["payload_size_bytes"] > 0


def test_rows_without_an_id_stay_apart(spark, scratch):
    land = os.path.join(scratch, "land")
    _land(land, "f1", [{"source": "s", "node_id": "n"}, {"source": "s", "node_id": "n"}])
    _land(land, "f2", [{"source": "s", "node_id": "n"}])
    cfg = _cfg(scratch)
    _run(spark, cfg)
    assert read_serving(spark, cfg.output_root, "alarms").count() == 3


def test_new_checkpoint_beside_old_output_is_refused(spark, scratch):
    _land(os.path.join(scratch, "land"), "f1", [_event(1, "2026-08-06T10:00:00Z")])
    cfg = _cfg(scratch)
    _run(spark, cfg)
    cfg.checkpoint_root = os.path.join(scratch, "another")
    with pytest.raises(RuntimeError, match="checkpoint is new"):
        job.start_source(spark, SOURCES[0], cfg)
    cfg.checkpoint_root = None
    with pytest.raises((ValueError, RuntimeError)):          # no folder named, or a new one
        job.start_source(spark, SOURCES[0], cfg)


APPLICATION = """
import sys
sys.path.insert(0, {root!r})
from siglake.session import get_session
from siglake.sources.files import SOURCES
from siglake.streaming import job
spark = get_session("local[1]", shuffle_partitions=2, extra={{"spark.checkpoint.dir": {shared!r}}})
cfg = job.StreamConfig({land!r}, {out!r}, trigger_seconds=None)
q = job.start_source(spark, SOURCES[0], cfg)
q.awaitTermination(200)
assert q.exception() is None
"""


def test_two_applications_share_a_checkpoint(spark, scratch):
    """A restart in another application reads only what is new."""
    land = os.path.join(scratch, "land")
    code = APPLICATION.format(root=ROOT, shared=os.path.join(scratch, "shared"), land=land, out=os.path.join(scratch, "out"))
    for i in (1, 2):
        _land(land, f"f{i}", [_event(i, "2026-08-06T10:00:00Z")])
        subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True)
    stored = read_stored(spark, os.path.join(scratch, "out"), "alarms")
    assert sorted(r["event_id"] for r in stored.collect()) == ["ALM-1", "ALM-2"]
    assert len({r["batch"].split("--")[1] for r in stored.collect()}) == 1        # one query id


def test_hourly_window_counts_closed_windows(spark, scratch):
    land = os.path.join(scratch, "land")
    _land(land, "f1", [_event(i, f"2026-08-06T{10 + i // 3:02d}:{(i * 7) % 60:02d}:00Z") for i in range(9)])
    _land(land, "f2", [_event(100, "2026-08-06T20:00:00Z")])   # advances the watermark
    s = job.source_frame(spark, SOURCES[0], _cfg(scratch))
    counts = job.hourly_window_counts(s, delay="10 minutes")
    q = (counts.writeStream.outputMode("append").format("memory").queryName("hourly_test")
         .option("checkpointLocation", os.path.join(scratch, "wck")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = {str(r["window_start"]): r["events"] for r in spark.sql("SELECT * FROM hourly_test").collect()}
    assert got == {"2026-08-06 10:00:00": 3, "2026-08-06 11:00:00": 3, "2026-08-06 12:00:00": 3}
    # the 20:00 window is still open (watermark not past its end) and is not emitted
    batch = read_json(spark, os.path.join(land, "raw/kafka/category=alarms"), UNIFIED_EVENT, multiline=False)
    b = batch.groupBy(F.date_trunc("hour", F.try_to_timestamp("timestamp")).alias("h")).count()
    assert b.count() == 4


def test_start_all_json_and_csv_sources(spark, scratch):
    land = os.path.join(scratch, "land")
    _land(land, "f1", [_event(1, "2026-08-06T10:00:00Z")])
    body = 'event_id,severity,vendor,note\nALM-1,CRITICAL,Huawei,"a, quoted"\nALM-2,MAJOR,Nokia,\n'
    write_file(land, "raw/uploads/csv/test_alarms.csv", body)
    write_file(land, "raw/uploads/csv/again.csv", body)
    write_file(land, "raw/uploads/csv/many.csv", "event_id,n\n" + "".join(f"E{i},{i}\n" for i in range(700)))
    write_file(land, "raw/csv/events.csv", "event_id,source,event_type,timestamp,severity,node_id,region,payload\n"
                                           "N-1,s,t,2026-08-06T10:00:00Z,p2,n,r,\n")
    published = []
    cfg = _cfg(scratch, publish=lambda df: published.append((df.columns, df.count())))
    cfg.max_files_per_trigger = 10
    qs, waiting = job.start_all(spark, SOURCES, cfg)
    for q in qs:
        q.awaitTermination(120)
        assert q.exception() is None
    job.stop_all(qs)
    assert sorted(q.name for q in qs) == ["query_alarms", "query_events_csv", "query_uploads_csv"]
    assert {s.category for s in waiting} == {"tickets", "network", "security", "performance", "rest", "uploads_json", "uploads_excel", "uploads_pdf"}
    up = _stored(spark, cfg, "network_events")
    one = up.where("filename = 'test_alarms.csv'").orderBy("event_id").collect()
    assert [r["event_id"][-2:] for r in one] == ["-0", "-1"] and one[0]["event_id"].startswith("UPLOAD-")
    assert [r["vendor"] for r in one] == ["Huawei", "Nokia"]            # bound from each record
    assert json.loads(one[0]["payload"])["note"] == "a, quoted"          # header-matched, quote-aware
    assert {r["category"] for r in one} == {"uploads_csv"} and {r["source"] for r in one} == {"UPLOAD_CSV"}
    # every record of every file counts: no cap, and equal files keep both files' rows
    assert {r["filename"]: r["count"] for r in up.groupBy("filename").count().collect()} == {
        "test_alarms.csv": 2, "again.csv": 2, "many.csv": 700, None: 1}
    assert read_serving(spark, cfg.output_root, "network_events").count() == 705
    assert up.where("event_id = 'N-1'").first()["severity_clean"] == "MAJOR"
    history = spark.read.parquet(os.path.join(cfg.output_root, "upload_history"))
    assert {r["filename"]: r["records_count"] for r in history.collect()} == {"test_alarms.csv": 2, "again.csv": 2, "many.csv": 700}
    assert spark.read.parquet(os.path.join(cfg.output_root, "upload_files")).count() == 3
    assert published == []                                # the outbox sends them, not the batch
    for q in follow.start_followers(spark, cfg, []):
        q.awaitTermination(120)
        assert q.exception() is None
    assert published == [(["key", "topic", "value"], 704)]
    # the folders that were missing start once they are there
    write_file(land, "raw/kafka/category=tickets/t.json", json.dumps([_event(5, "2026-08-06T10:00:00Z")]))
    more, still = job.start_all(spark, waiting, cfg)
    assert [q.name for q in more] == ["query_tickets"] and len(still) == 7
    more[0].awaitTermination(120)


def test_message_ingestion_stream(spark, scratch):
    from siglake.streaming import ingest
    recs = [
        {"topic": "telecom-alarms", "value": json.dumps(_event(1, "2026-08-06T10:00:00Z"))},
        {"topic": "telecom-events", "value": json.dumps({"event_id": "x-1", "source": "Comarch OSS",
                                                         "event_type": "CellTowerDown", "node_id": "n9"})},
        {"topic": "telecom-events", "value": json.dumps({"event_id": "evt-9912"})},     # rejected
        {"topic": "tickets", "value": "not json"},                                      # rejected
    ]
    write_file(scratch, "kafka/part-0.json", "\n".join(json.dumps(r) for r in recs))
    land, quar = os.path.join(scratch, "land", "raw", "kafka"), os.path.join(scratch, "quarantine")
    stream = ingest.json_record_stream(spark, os.path.join(scratch, "kafka"))
    q = ingest.start_ingest(stream, land, quar, os.path.join(scratch, "ck"), trigger_seconds=None)
    q.awaitTermination(120)
    assert q.exception() is None
    landed = spark.read.option("recursiveFileLookup", False).json(land)
    cats = {r["event_id"]: r["category"] for r in landed.select("event_id", "category").collect()}
    assert cats == {"ALM-1": "alarms", "x-1": "network"}
    bad = spark.read.parquet(quar).select("raw_value", "reject_reason").collect()
    assert len(bad) == 2
    assert any(r["raw_value"] == "not json" for r in bad)
    assert all("missing source" in r["reject_reason"] for r in bad)
    # the landed layout is exactly what the landing-zone job reads back
    cfg = _cfg(scratch)
    _run(spark, cfg)
    out = read_serving(spark, cfg.output_root, "alarms")
    assert [(r["event_id"], r["severity_clean"]) for r in out.collect()] == [("ALM-1", "MAJOR")]


def test_ingest_retry_lands_each_message_once(spark, scratch):
    from siglake.streaming import ingest
    rows = [{"topic": "telecom-alarms", "value": json.dumps(_event(i, f"2026-08-0{5 + i}T10:00:00Z"))} for i in (1, 2)]
    write_file(scratch, "kafka/part-0.json", "\n".join(json.dumps(r) for r in rows))
    land, quar, ck = (os.path.join(scratch, x) for x in ("land/raw/kafka", "quarantine", "ck"))
    q = ingest.start_ingest(ingest.json_record_stream(spark, os.path.join(scratch, "kafka")), land, quar, ck, None)
    q.awaitTermination(120)
    cfg = _cfg(scratch)
    _run(spark, cfg)                                          # the landing job has read the files
    batch = spark.read.schema("topic string, value string").json(os.path.join(scratch, "kafka")).withColumn(
        "value", F.col("value").cast("binary"))
    ingest.make_ingest_handler(land, quar, ck)(batch, 0)      # the same batch again
    _run(spark, cfg)
    assert _stored(spark, cfg).count() == 2
    days = [d for d in os.listdir(os.path.join(land, "category=alarms"))]
    assert sorted(days) == ["ingest_date=2026-08-06", "ingest_date=2026-08-07"]      # the messages' own days


def test_message_keeps_all_its_fields(spark, scratch):
    from siglake.streaming import ingest
    values = [{"source": "s", "node_id": "n1", "alarm_id": "ALM-9", "vendor": "Nokia", "created_at": "2026-08-06T10:00:00Z"},
              {"event_id": "E1", "source": "s", "node_id": "n2", "event_time": "2026-08-06T11:00:00Z",
               "payload": {"vendor": "Own", "x": 1}, "vendor": "Top", "site_id": "S-1"},
              {"source": "s", "node_id": "n3", "metric_id": "M-1"}]
    write_file(scratch, "kafka/p.json", "\n".join(json.dumps({"topic": "telecom-alarms", "value": json.dumps(v)}) for v in values))
    land = os.path.join(scratch, "land", "raw", "kafka")
    q = ingest.start_ingest(ingest.json_record_stream(spark, os.path.join(scratch, "kafka")), land,
                            os.path.join(scratch, "quar"), os.path.join(scratch, "ck"), None)
    q.awaitTermination(120)
    cfg = _cfg(scratch)
    _run(spark, cfg)
    rows = {r["event_id"]: r for r in read_serving(spark, cfg.output_root, "alarms").collect()}
    assert set(rows) == {"ALM-9", "E1", "M-1"}
    assert rows["ALM-9"]["vendor"] == "Nokia" and str(rows["ALM-9"]["event_timestamp"]) == "2026-08-06 10:00:00"
    assert rows["ALM-9"]["severity"] == "INFO"                # the event default
    assert rows["E1"]["vendor"] == "Own" and rows["E1"]["site_name"] == "S-1" and str(rows["E1"]["event_timestamp"]) == \
        "2026-08-06 11:00:00"
    assert json.loads(rows["E1"]["payload"])["x"] == 1
    assert rows["M-1"]["event_timestamp"] is not None         # the landed file's time


def test_stream_to_panels_equals_batch_panels(spark, scratch):
    """ingest -> stream -> all 26 panels, with repeats in later batches, against the panels over one batch."""
    from siglake.plans import dashboards, serving
    from siglake.streaming import ingest
    rng = random.Random(7)
    topics = ["telecom-alarms", "tickets", "network-events", "security-events", "performance"]
    records = []
    for k in range(4):
        part = []
        for i in range(60):
            e = _event(rng.randrange(90), f"2026-08-0{1 + rng.randrange(6)}T{rng.randrange(24):02d}:{rng.randrange(60):02d}:00Z",
                       sev=rng.choice(["p1", "MAJOR", "low", "minor"]), vendor=rng.choice(["Nokia", "Huawei"]))
            e["region"] = rng.choice(["R1", "R2", None])
            part.append({"topic": topics[i % 5], "value": json.dumps(e)})
        records += part
        write_file(scratch, f"kafka/part-{k}.json", "\n".join(json.dumps(r) for r in part))
    land = os.path.join(scratch, "land", "raw", "kafka")
    stream = ingest.json_record_stream(spark, os.path.join(scratch, "kafka"), max_files=1)
    ingest.start_ingest(stream, land, os.path.join(scratch, "quar"), os.path.join(scratch, "ck"), None).awaitTermination(200)
    cfg = _cfg(scratch)
    cfg.max_files_per_trigger = 7
    queries, _ = job.start_all(spark, SOURCES[:5], cfg)
    for q in queries:
        q.awaitTermination(200)
        assert q.exception() is None
    from siglake.sources.kafka import decode_messages
    from siglake.operators.normalize import resolve_lenient
    raw = spark.createDataFrame([(r["topic"], bytearray(r["value"].encode())) for r in records], "topic string, value binary")
    routed = serving.routed_messages(resolve_lenient(decode_messages(raw)))
    dashboards.register_views({t: serving.build_table(routed, c) for t, c in serving.TABLE_CATEGORIES.items()})
    want = {n: sorted(map(str, spark.sql(sql).collect())) for n, sql in dashboards.PANEL_SQL.items()}
    assert dashboards.register_serving(spark, cfg.output_root) == sorted(serving.PANELS)
    assert len(dashboards.PANEL_SQL) == 26
    for name, sql in dashboards.PANEL_SQL.items():
        assert sorted(map(str, spark.sql(sql).collect())) == want[name], name
    assert read_stored(spark, cfg.output_root, "alarms").count() > read_serving(spark, cfg.output_root, "alarms").count()


def test_legacy_pretty_printed_landing(spark, scratch):
    land = os.path.join(scratch, "land")
    for i in range(3):
        write_file(land, f"raw/kafka/alarms/2026/08/06/{i}.json",
                   json.dumps(_event(i, "2026-08-06T10:00:00Z"), indent=2))
    from siglake.sources.files import SourceSpec
    cfg = _cfg(scratch, json_multiline=True)
    _run(spark, cfg, SourceSpec("raw/kafka/alarms", "alarms", "alarms", "json", True))
    out = _stored(spark, cfg)
    assert sorted(r["event_id"] for r in out.collect()) == ["ALM-0", "ALM-1", "ALM-2"]


def test_rest_envelopes_are_exploded_and_normalised(spark, scratch):
    land = os.path.join(scratch, "land")
    env = {"target_system": "ServiceNow", "url": "http://x/api", "pages_fetched": 1, "total_records": 3,
           "collected_at_utc": "2026-08-06T12:00:00Z",
           "data": [{"ticket_id": "INC-1", "priority": "P1", "site_id": "S-9", "created_at": "2026-08-06T08:00:00Z"},
                    {"ticket_id": "INC-2", "priority": "3 - Medium"},
                    {"status": "ACTIVE"}]}
    write_file(land, "raw/rest/2026/08/06/env1.json", json.dumps(env, indent=2))
    write_file(land, "raw/rest/2026/08/06/env2.json", json.dumps({"target_system": "X", "data": []}))
    cfg = _cfg(scratch)
    spec = [s for s in SOURCES if s.category == "rest"][0]
    _run(spark, cfg, spec)
    out = _stored(spark, cfg, "network_events")
    rows = {r["event_id"]: r for r in out.collect()}
    assert len(rows) == 3
    assert rows["INC-1"]["severity_clean"] == "CRITICAL" and rows["INC-1"]["node_id"] == "S-9"
    assert rows["INC-1"]["source"] == "REST_SERVICENOW" and rows["INC-1"]["ticket_id"] == "INC-1"
    assert str(rows["INC-1"]["event_timestamp"]) == "2026-08-06 08:00:00"
    assert rows["INC-2"]["severity_clean"] == "MINOR" and rows["INC-2"]["region"] == "SA-RIYADH"
    ext = [k for k in rows if k.startswith("EXT-SERVICENOW-")]
    assert len(ext) == 1 and str(rows[ext[0]]["event_timestamp"]) == "2026-08-06 12:00:00"


def test_command_line_stream_once(spark, scratch):
    from siglake.__main__ import main
    land = os.path.join(scratch, "land")
    _land(land, "f1", [_event(1, "2026-08-06T10:00:00Z"), _event(2, "2026-08-06T11:00:00Z")])
    out = os.path.join(scratch, "out")
    rc = main(["stream", "--landing", land, "--output", out, "--checkpoints", os.path.join(scratch, "ck"),
               "--sources", "alarms", "--once", "--monitor-seconds", "0.5",
               "--run-log", os.path.join(scratch, "runlog")])
    assert rc == 0
    assert read_serving(spark, out, "alarms").count() == 2
    assert main(["panel", "--serving", out, "--name", "total_alarms"]) == 0
    assert main(["compact", "--serving", out, "--tables", "alarms"]) == 0


def test_catalog_table_over_idempotent_output(spark, scratch):
    from siglake.sources.files import read_json
    land = os.path.join(scratch, "land")
    _land(land, "f1", [_event(1, "2026-08-06T10:00:00Z"), _event(2, "2026-08-07T10:00:00Z")])
    spark.sql("CREATE NAMESPACE IF NOT EXISTS ops_stream")
    cfg = _cfg(scratch, table_prefix="ops_stream.")
    _run(spark, cfg)
    assert spark.table("ops_stream.alarms").count() == 2
    # replaying the same batch id (a retry) must not duplicate rows in the table
    handler = job.make_batch_handler(SOURCES[0], cfg, job.checkpoint_location(spark, cfg, SOURCES[0]))
    batch = read_json(spark, os.path.join(land, "raw/kafka/category=alarms"), UNIFIED_EVENT, multiline=False)
    handler(batch, 0)
    assert spark.table("ops_stream.alarms").count() == 2
    assert spark.table("ops_stream.alarms").where("event_date = '2026-08-07'").count() == 1

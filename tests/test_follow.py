"""Followers of stored batches: hourly counts by signed changes, the outbox."""

import json
import os

import pyarrow as pa
from pyspark.sql import functions as F

from conftest import write_file
from siglake.plans.serving import PANELS, panel_hourly
from siglake.sinks.tables import compact, read_serving, write_batch
from siglake.sources.files import SOURCES
from siglake.streaming import follow, job
from test_streaming import THREE, _cfg, _event, _land, _run


def _follow(spark, cfg, tables=("alarms",)):
    for q in follow.start_followers(spark, cfg, tables):
        q.awaitTermination(120)
        assert q.exception() is None


def _bring(spark, cfg, land, i):
    """Land and store the i-th of the three micro-batches."""
    _land(land, f"f{i}", [_event(n, at, sev=sev) for n, at, sev in THREE[i - 1]])
    _run(spark, cfg)


def _rows(df):
    return [tuple(r) for r in df.collect()]


def _same_as_the_panel(spark, cfg):
    alias = PANELS["alarms"].hourly_alias
    got = _rows(follow.read_hourly(spark, cfg.output_root, "alarms", alias))
    assert got == _rows(panel_hourly(read_serving(spark, cfg.output_root, "alarms"), PANELS["alarms"]))
    return got


def test_hourly_counts_follow_events_that_move(spark, scratch):
    cfg, land = _cfg(scratch, hourly=True), os.path.join(scratch, "land")
    for i in (1, 2, 3):                  # repeats move hours and dates, older versions come later
        _bring(spark, cfg, land, i)
        _follow(spark, cfg)
        _same_as_the_panel(spark, cfg)
    before = _same_as_the_panel(spark, cfg)
    assert sum(n for _, n in before) == 5
    compact(spark, cfg.output_root, "alarms")        # its files bring known ids only
    _follow(spark, cfg)
    assert _same_as_the_panel(spark, cfg) == before


def test_hourly_counts_of_rows_without_id_or_time(spark, scratch):
    cfg, land = _cfg(scratch, hourly=True), os.path.join(scratch, "land")
    _land(land, "f1", [{"source": "s", "timestamp": "2024-03-01T10:00:00Z"}] * 3 + [{"event_id": "E", "timestamp": "2024-03-01T10:30:00Z"}])
    _run(spark, cfg)
    none = read_serving(spark, cfg.output_root, "alarms").limit(1).withColumns(
        {"event_id": F.lit("T"), "event_timestamp": F.lit(None).cast("timestamp"), "event_date": F.lit(None).cast("string"),
         "payload": F.lit(None).cast("string")})
    write_batch(none, cfg.output_root, "alarms", "alarms--other--0")
    _follow(spark, cfg)
    got = _same_as_the_panel(spark, cfg)
    assert [n for _, n in got] == [1, 4] and got[0][0] is None
    compact(spark, cfg.output_root, "alarms")
    _follow(spark, cfg)
    assert _same_as_the_panel(spark, cfg) == got


def test_hourly_counts_after_a_retry(spark, scratch, monkeypatch):
    cfg, land = _cfg(scratch, hourly=True), os.path.join(scratch, "land")
    _bring(spark, cfg, land, 1)
    _follow(spark, cfg)
    _bring(spark, cfg, land, 2)
    write = follow.append_rows

    def fails_after(*a):
        write(*a)
        raise OSError("lost after the write")

    with monkeypatch.context() as m:
        m.setattr(follow, "append_rows", fails_after)
        q, = follow.start_followers(spark, cfg, ["alarms"])
        try:
            q.awaitTermination(120)
            raise AssertionError("the batch did not fail")
        except Exception as e:
            assert "lost after the write" in str(e)
    _follow(spark, cfg)
    _same_as_the_panel(spark, cfg)


def test_a_hot_id_sends_a_row_for_each_arrow_batch():
    rows = pa.table({"key": ["hot"] * 9000 + [f"k{i}" for i in range(1000)], "slot": [0] * 10000,
                     "at": list(range(10000)), "n": [1] * 10000})
    out = pa.Table.from_batches(list(follow._reduced(iter(rows.to_batches()))))
    assert out.num_rows == 1001 and out.column_names == ["key", "slot", "at", "n"]
    hot = out.to_pandas().set_index("key").loc["hot"]
    assert hot["at"] == 8999 and hot["n"] == 9000


def test_a_retried_batch_publishes_each_event_once(spark, scratch, monkeypatch):
    sent = []
    cfg = _cfg(scratch, publish=lambda df: sent.extend(df.collect()))
    env = {"target_system": "X", "collected_at_utc": "2024-03-01T12:00:00Z", "data": [{"id": "1"}, {"id": "2"}]}
    write_file(cfg.landing_root, "raw/rest/env1.json", json.dumps(env))
    spec = [s for s in SOURCES if s.category == "rest"][0]
    put = job.put_in_outbox

    def fails_after(*a):
        put(*a)
        raise OSError("lost after the write")

    with monkeypatch.context() as m:
        m.setattr(job, "put_in_outbox", fails_after)
        q = job.start_source(spark, spec, cfg)
        try:
            q.awaitTermination(120)
            raise AssertionError("the batch did not fail")
        except Exception as e:
            assert "lost after the write" in str(e)
    _follow(spark, cfg, [])                            # the outbox sends before the retry
    _run(spark, cfg, spec)                             # the retry
    _follow(spark, cfg, [])
    assert len(sent) == 2 and len({r["key"] for r in sent}) == 2
    assert all(json.loads(r["value"])["event_id"] == r["key"] for r in sent)
    assert read_serving(spark, cfg.output_root, "network_events").count() == 2


def test_command_line_keeps_hourly_counts_in_rocksdb(spark, scratch):
    from siglake.__main__ import main
    cfg = _cfg(scratch)
    for i in (1, 2):
        _land(cfg.landing_root, f"f{i}", [_event(n, at, sev=sev) for n, at, sev in THREE[i - 1]])
    rc = main(["stream", "--landing", cfg.landing_root, "--output", cfg.output_root, "--checkpoints", cfg.checkpoint_root,
               "--sources", "alarms", "--once", "--hourly", "--monitor-seconds", "0.5", "--run-log", os.path.join(scratch, "runlog")])
    assert rc == 0
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    _same_as_the_panel(spark, cfg)

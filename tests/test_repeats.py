"""Redelivered rows dropped from keyed state."""

import os

import pyarrow as pa

from siglake.sinks.tables import read_serving
from siglake.streaming import repeats
from test_streaming import _cfg, _event, _land, _run, _stored


def test_repeats_are_not_stored_and_no_distinct_row_is_lost(spark, scratch):
    cfg = _cfg(scratch, drop_repeats="2 days")
    loose = {"source": "s", "node_id": "n"}
    _land(cfg.landing_root, "f1", [_event(1, "2024-03-01T10:00:00Z"), _event(1, "2024-03-01T10:00:00Z"),
                                   _event(2, "2024-03-01T11:00:00Z"), loose, loose])
    _run(spark, cfg)
    assert _stored(spark, cfg).count() == 4
    _land(cfg.landing_root, "f2", [_event(1, "2024-03-01T10:00:00Z"),                    # a repeat
                                   _event(2, "2024-03-01T12:00:00Z", sev="p1"),          # a newer version
                                   _event(3, "2001-01-01T00:00:00Z"), loose])            # an old event, a loose one
    _run(spark, cfg)                                                                     # a restart keeps the state
    kept = _stored(spark, cfg)
    assert kept.count() == 7 and kept.where("event_id = 'ALM-1'").count() == 1
    rows = {r["event_id"]: r["severity_clean"] for r in read_serving(spark, cfg.output_root, "alarms").collect() if r["event_id"]}
    assert rows == {"ALM-1": "MAJOR", "ALM-2": "CRITICAL", "ALM-3": "MAJOR"}
    assert read_serving(spark, cfg.output_root, "alarms").count() == 6


def test_a_hot_row_is_one_for_each_arrow_batch():
    rows = pa.record_batch({repeats._KEY: ["hot"] * 3000 + ["a", "hot", "b"], "n": list(range(3003))})
    out, = repeats._first_of_each(iter([rows]))
    assert out.to_pydict() == {repeats._KEY: ["hot", "a", "b"], "n": [0, 3000, 3002]}
    empty, = repeats._first_of_each(iter([rows.slice(0, 0)]))
    assert empty.num_rows == 0

"""DataFrame operators on small literal frames, including the platform's quirks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siglake.operators import summaries
from siglake.operators.aggregates import (count_by, hourly_counts, long_form_counts, recent,
                                          time_slice, total_count)
from siglake.operators.dedup import dedup_latest
from siglake.operators.normalize import (apply_event_defaults, clean_events, connector_normalize,
                                         to_canonical)
from siglake.operators.profile import column_profile, profile
from siglake.operators.reshape import explode_envelope, fan_in, page_records
from siglake.operators.validate import (accepted, cap_per_group, lookup_by_id, quarantine,
                                        validate_events)
from siglake.schemas import UNIFIED_EVENT, canonical_columns


def ev(**kw):
    base = {f.name: None for f in UNIFIED_EVENT.fields}
    base.update(kw)
    return tuple(base[f.name] for f in UNIFIED_EVENT.fields)


# --- connector normalisation (C2, C10-C12) ----------------------------------
def test_connector_normalize_alarm(spark):
    raw = spark.createDataFrame([("ALM-TEST-123", "CRITICAL", "TOWER-DEL-101", "IN-NORTH-DELHI", "Huawei")],
                                "alarm_id string, severity string, tower_id string, region string, vendor string")
    r = connector_normalize(raw, "alarm").first()
    assert r["event_id"] == "ALM-TEST-123"
    assert r["severity"] == "CRITICAL"
    assert r["node_id"] == "TOWER-DEL-101"
    assert r["source"] == "REST_ALARM"
    assert r["event_type"] == "REST_alarm"
    assert r["topic"] == "telecom-alarms"
    assert '"vendor":"Huawei"' in r["payload"]


def test_connector_defaults_and_stable_fallback_id(spark):
    raw = spark.createDataFrame([("", None, "ACTIVE")], "metric_id string, region string, status string")
    a = connector_normalize(raw, "performance").first()
    b = connector_normalize(raw, "performance").first()
    assert a["event_id"].startswith("EXT-PERFORMANCE-") and a["event_id"] == b["event_id"]
    assert a["node_id"] == "NODE-GENERIC" and a["region"] == "SA-RIYADH"
    assert a["severity"] == "INFO"
    sec = spark.createDataFrame([("SEC-101", "HIGH", "fw-1")], "event_id string, threat_level string, target_device string")
    s = connector_normalize(sec, "security").first()
    assert (s["event_id"], s["severity"], s["node_id"]) == ("SEC-101", "MAJOR", "fw-1")


# --- validation (D1, D2, C23) -------------------------------------------------
def test_validation_strict_lenient_rejected(spark):
    rows = [
        ev(event_id="evt-9912", source="Comarch OSS", event_type="OpticalLinkLoss",
           timestamp="2026-08-06T12:00:00Z", severity="CRITICAL", node_id="TOWER-DELHI-001",
           region="IN-NORTH-1", payload='{"dbm_level": -32.5}'),
        ev(event_id="evt-1", source="REST_ALARM", event_type="x", severity="Critical", node_id="n1"),
        ev(event_id="evt-9912"),                                   # source and node_id missing
        ev(event_id="e3", source="Alarm Events", event_type="t", node_id="n", timestamp="bad"),
        ev(event_id="e4", source="Alarm Events", event_type="t", node_id="n", payload="[1]"),
    ]
    df = spark.createDataFrame(rows, UNIFIED_EVENT)
    v = validate_events(df).select("is_strict", "is_lenient", "accepted", "reject_reason").collect()
    assert [tuple(r)[:3] for r in v] == [(True, True, True), (False, True, True), (False, False, False),
                                        (False, True, True), (False, True, True)]
    assert v[2]["reject_reason"] == "missing source; missing event_type; missing node_id"
    assert accepted(df).count() == 4
    q = quarantine(df).collect()
    assert len(q) == 1 and q[0]["event_id"] == "evt-9912"


def test_event_defaults(spark):
    df = spark.createDataFrame([ev(event_id="a", source="Comarch OSS", event_type="t", node_id="n")], UNIFIED_EVENT)
    r = apply_event_defaults(df, now=F.lit("2026-01-01 00:00:00").cast("timestamp")).first()
    assert r["severity"] == "INFO" and r["payload"] == "{}" and r["timestamp"].startswith("2026-01-01")
    assert r["region"] is None


# --- de-duplication (F1, F3) -------------------------------------------------
def test_dedup_keeps_newest_and_breaks_ties(spark):
    t = lambda s: dt.datetime.fromisoformat(s)
    df = spark.createDataFrame([
        ("A", t("2026-01-01 10:00:00"), "old"),
        ("A", t("2026-01-01 11:00:00"), "new"),
        ("B", t("2026-01-01 10:00:00"), "b1"),
        ("B", t("2026-01-01 10:00:00"), "b2"),     # tie: larger remaining column wins
        ("C", None, "c-null-ts"),
        ("C", t("2020-01-01 00:00:00"), "c-ts"),    # a real time beats NULL
    ], "event_id string, event_timestamp timestamp, note string")
    got = {r["event_id"]: r["note"] for r in dedup_latest(df).collect()}
    assert got == {"A": "new", "B": "b2", "C": "c-ts"}


def test_dedup_null_keys_are_kept_and_key_is_per_row(spark):
    df = spark.createDataFrame([
        (None, None, "x1"), (None, None, "x2"), ("", None, "x3"),          # no id at all -> kept
        (None, "INC1", "t1"), ("", "INC1", "t2"),                           # ticket id fallback
        ("E1", "INC1", "e1"),                                               # event_id wins over ticket
    ], "event_id string, ticket_id string, note string").withColumn(
        "event_timestamp", F.lit(None).cast("timestamp"))
    out = sorted(r["note"] for r in dedup_latest(df).collect())
    assert out == ["e1", "t2", "x1", "x2", "x3"]
    # the platform's dropDuplicates(["ticket_id"]) would have collapsed all NULLs into one row
    assert df.dropDuplicates(["ticket_id"]).count() == 2


def test_dedup_with_map_payload_uses_max_by(spark):
    df = spark.createDataFrame([("A", 1, {"k": "v1"}), ("A", 2, {"k": "v2"})],
                               "event_id string, event_timestamp int, payload map<string,string>")
    r = dedup_latest(df).first()
    assert r["payload"] == {"k": "v2"}


# --- caps, lookups -----------------------------------------------------------
def test_cap_per_group_hot_group_is_salted(spark):
    # one file holds most rows; the result is the first 500 of it by order, exactly
    rows = [("hot", i) for i in range(5000)] + [("cold", i) for i in range(10)]
    df = spark.createDataFrame(rows, "file string, pos int").repartition(4)
    out = cap_per_group(df, ["file"], "pos", 500, salts=16)
    got = {r["file"]: sorted(x["pos"] for x in out.where(F.col("file") == r["file"]).collect())
           for r in out.select("file").distinct().collect()}
    assert got["hot"] == list(range(500)) and got["cold"] == list(range(10))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "__salt" in plan        # the first ranking is partitioned by (file, salt)


def test_cap_per_group_with_map_column(spark):
    df = spark.createDataFrame([("f", i, {"k": str(i)}) for i in range(5)], "file string, pos int, m map<string,string>")
    assert [r["pos"] for r in cap_per_group(df, ["file"], "pos", 3).orderBy("pos").collect()] == [0, 1, 2]


def test_cap_per_group_dense_and_window_agree(spark):
    rows = [("f1", i) for i in range(700)] + [("f2", i) for i in range(3)]
    df = spark.createDataFrame(rows, "file string, row_idx int")
    dense = cap_per_group(df, ["file"], "row_idx", 500, dense_index=True)
    win = cap_per_group(df, ["file"], "row_idx", 500)
    assert dense.count() == 503 and win.count() == 503
    assert dense.agg(F.max("row_idx")).first()[0] == 499
    assert lookup_by_id(df, "row_idx", 699).count() == 1
    assert lookup_by_id(df, "row_idx", 10_000).count() == 0


# --- fan-in and flattening (F4-F6) ---------------------------------------------
def test_fan_in_fills_missing_columns(spark):
    a = spark.createDataFrame([("1", "n1")], "event_id string, node_id string")
    b = spark.createDataFrame([("2", "f.csv")], "event_id string, filename string")
    out = fan_in([a, b]).orderBy("event_id").collect()
    assert out[0]["filename"] is None and out[1]["node_id"] is None


def test_rest_page_shapes(spark):
    pages = [
        '{"items":[{"id":1,"status":"ACTIVE"}]}',
        '{"data":[{"event_id":"SEC-101","threat":"HIGH"}, {"event_id":"SEC-102"}]}',
        '[{"a":1},{"a":2},{"a":3}]',
        '{"result":[],"foo":1}',            # empty result -> the page itself
        '{"result":{"x":1}}',               # object result -> one record
        None,
    ]
    df = spark.createDataFrame([(p,) for p in pages], "page string")
    sizes = [r[0] for r in df.select(F.size(page_records("page"))).collect()]
    assert sizes == [1, 2, 3, 1, 1, 0]
    first = df.select(page_records("page")[0].alias("r")).first()["r"]
    assert first.replace(" ", "") == '{"id":1,"status":"ACTIVE"}'


def test_envelope_explode(spark):
    env = spark.createDataFrame([("ServiceNow", ['{"id":1}', '{"id":2}']), ("X", [])],
                                "target_system string, data array<string>")
    out = explode_envelope(env).collect()
    assert [(r["target_system"], r["record_idx"]) for r in out] == [("ServiceNow", 0), ("ServiceNow", 1)]


# --- aggregates and summaries -------------------------------------------------
@pytest.fixture
def events(spark):
    t = lambda s: dt.datetime.fromisoformat(s)
    return spark.createDataFrame([
        ("1", "CRITICAL", "Nokia", t("2026-01-01 10:05:00")),
        ("2", "CRITICAL", None, t("2026-01-01 10:55:00")),
        ("3", "MINOR", "Nokia", t("2026-01-01 12:00:00")),
        ("4", "INFO", "Huawei", t("2026-01-02 00:00:00")),
    ], "event_id string, severity_clean string, vendor string, event_timestamp timestamp") \
        .withColumn("event_date", F.date_format("event_timestamp", "yyyy-MM-dd"))


def test_panels(events):
    assert total_count(events, "n").first()["n"] == 4
    assert total_count(events.where("false"), "n").first()["n"] == 0   # COALESCE(COUNT(*),0)
    by_vendor = {r["vendor"]: r["count"] for r in count_by(events, "vendor", "vendor").collect()}
    assert by_vendor == {"Nokia": 2, None: 1, "Huawei": 1}
    hourly = [(str(r["time"]), r["c"]) for r in hourly_counts(events, "c").collect()]
    assert hourly == [("2026-01-01 10:00:00", 2), ("2026-01-01 12:00:00", 1), ("2026-01-02 00:00:00", 1)]
    rec = recent(events, {"event_id": "Event ID", "event_timestamp": "Event Timestamp"}, n=2).collect()
    assert [r["Event ID"] for r in rec] == ["4", "3"]
    sliced = time_slice(events, since="2026-01-01 11:00:00", until="2026-01-02 00:00:00")
    assert [r["event_id"] for r in sliced.collect()] == ["3"]


def test_breakdowns(spark, events):
    b = {(r["dimension"], r["value"]): r["n"] for r in summaries.severity_breakdown(events).collect()}
    assert b[("total", None)] == 4 and b[("severity", "MAJOR")] == 0 and b[("vendor", None)] == 1
    lf = {(r["dimension"], r["value"]): r["n"] for r in long_form_counts(events, ["vendor"]).collect()}
    assert lf == {("vendor", "Nokia"): 2, ("vendor", None): 1, ("vendor", "Huawei"): 1, ("total", None): 4}


def test_uploads_rollup_sums_all_history(spark):
    rows = [(i, "csv" if i % 2 else "pdf", 10, None if i == 3 else 2,
             dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i)) for i in range(150)]
    hist = spark.createDataFrame(rows, "id long, file_type string, file_size_bytes long, records_count long, created_at timestamp_ntz")
    r = summaries.uploads_rollup(hist).first()
    assert r["total_uploaded_files"] == 150
    assert r["total_bytes_processed"] == 1500
    assert r["total_records_parsed"] == 298
    assert (r["uploads_csv"], r["uploads_pdf"], r["uploads_excel"], r["uploads_json"]) == (75, 75, 0, 0)
    newest = summaries.uploads_rollup(summaries.recent_rows(hist, 100)).first()
    assert newest["total_uploaded_files"] == 100 and newest["total_records_parsed"] == 200      # ids 50..149


def test_performance_and_top_regions(spark):
    perf = spark.createDataFrame([("R1", 10.0, 0.5, 100.0), ("R1", 20.0, 0.5, 300.0), ("R2", 80.0, 4.0, 50.0),
                                  ("R3", 5.0, 0.0, 10.0)],
                                 "region string, latency_ms double, packet_loss_pct double, throughput_mbps double")
    a = summaries.performance_averages(perf).first()
    assert a["monitored_nodes_count"] == 4 and a["average_latency_ms"] == 28.75
    assert a["average_packet_loss_pct"] == 1.25 and a["average_throughput_mbps"] == 115.0
    top = [r["region"] for r in summaries.top_regions(perf).collect()]
    assert top == ["R3", "R1"]


def test_ingestion_summary_and_job_summary(spark):
    k = spark.createDataFrame([("kafka",)] * 3, "channel string")
    r = spark.createDataFrame([("rest",)] * 2, "channel string")
    s = {x["channel"]: x["events"] for x in summaries.ingestion_summary([k, r]).collect()}
    assert s == {"kafka": 3, "rest": 2, "total": 5}
    t = lambda s: dt.datetime.fromisoformat(s)
    m = spark.createDataFrame([
        ("alarms", t("2026-01-01 10:00:00"), True), ("alarms", t("2026-01-01 10:00:10"), True),
        ("alarms", t("2026-01-02 10:00:00"), False), ("tickets", t("2026-01-01 09:00:00"), True),
    ], "category string, event_timestamp timestamp, accepted boolean")
    js = summaries.job_summary(summaries.run_log(m)).first()
    assert (js["total_runs"], js["completed_runs"], js["failed_runs"], js["records_processed"]) == (3, 2, 1, 3)
    assert js["avg_duration_seconds"] == round(10 / 3, 2)
    assert str(js["last_completed_at"]) == "2026-01-02 10:00:00"
    assert (js["active_runs"], js["completed_24h"], js["failed_24h"], js["last_status"]) == (0, 1, 1, "FAILED")
    log = summaries.run_log(m)
    running = log.unionByName(log.limit(1).withColumns({"status": F.lit("RUNNING"), "run_id": F.lit("r"),
                                                        "completed_at": F.lit(None).cast("timestamp")}))
    js = summaries.job_summary(running, as_of=t("2026-01-01 20:00:00")).first()
    assert (js["active_runs"], js["completed_24h"], js["last_status"]) == (1, 2, "FAILED")


def test_summary_with_sample(spark, events):
    total = total_count(events, "total")
    got = summaries.with_sample(total, events, n=2, columns=["event_id", "vendor"]).first()
    assert got["total"] == 4 and [r["event_id"] for r in got["sample"]] == ["4", "3"]
    none = summaries.with_sample(total_count(events.limit(0), "total"), events.limit(0), columns=["event_id"]).first()
    assert none["total"] == 0 and none["sample"] == []


def test_recent_rows_page(spark):
    hist = spark.createDataFrame([(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i // 2)) for i in range(10)],
                                 "id long, created_at timestamp_ntz")
    page = [r["id"] for r in summaries.recent_rows(hist, 3, offset=2).collect()]
    assert page == [7, 6, 5]
    after = summaries.recent_rows(hist, 3, before=(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=4), 8)).collect()
    assert [r["id"] for r in after] == page          # the same page by the last key of the page before


def test_profile_one_pass(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    p = {r["column_name"]: (r["non_null"], r["nulls"], r["rows"]) for r in column_profile(df).collect()}
    assert p == {"a": (2, 1, 3), "b": (1, 2, 3)}
    full = profile(df, sample_rows=2)
    assert full["rows"] == 3 and len(full["sample"]) == 2 and '"name":"a"' in full["schema"]


def test_canonical_projection(spark):
    df = spark.createDataFrame([("1", '{"vendor":"N"}')], "event_id string, payload string")
    c = to_canonical(clean_events(df), category="alarms")
    assert c.columns == canonical_columns()
    assert c.first()["vendor"] == "N" and c.first()["category"] == "alarms"
    sp = spark.createDataFrame([(("N",),)], "payload struct<vendor:string>")
    assert to_canonical(sp).first()["payload"] == '{"vendor":"N"}'


def test_dedup_hot_key_third_of_rows(spark):
    # one id holds a third of all rows; the newest of them wins, every other id is untouched
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("E"), F.col("id").cast("string")))
        .alias("event_id"),
        F.timestamp_seconds(F.col("id")).alias("event_timestamp"),
        F.col("id").alias("seq")).repartition(8)
    out = dedup_latest(df)
    assert out.count() == 1 + (n - n // 3)
    hot = out.where("event_id = 'HOT'").first()
    assert hot["seq"] == max(i for i in range(n) if i % 3 == 0)


def test_cut_lineage_uses_reliable_checkpoint(spark):
    from siglake.session import checkpoint_dir, cut_lineage
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    cut = cut_lineage(df)
    assert cut.count() == 100
    plan = cut._jdf.queryExecution().analyzed().toString()
    assert "LogicalRDD" in plan and "Range" not in plan          # lineage replaced by the checkpoint
    assert checkpoint_dir(spark)                                  # files live in the shared folder

"""Readers and writers on literal files in a scratch folder."""

import json
import os

from pyspark.sql import functions as F

from conftest import write_file
from siglake.operators.uploads import Uploads
from siglake.schemas import UNIFIED_EVENT
from siglake.sinks.landing import encode_messages, file_prefix
from siglake.sinks.tables import (append_rows, create_table, delete_by_id, ensure_namespace, read_live,
                                  table_path, write_batch, write_partitioned)
from siglake.sources import catalog
from siglake.sources.files import (SOURCES, open_source, read_binary, read_csv, read_envelopes, read_json,
                                   read_or_empty)
from siglake.sources.kafka import decode_messages
from siglake.operators.reshape import explode_envelope


def test_csv_and_json_readers(spark, scratch):
    write_file(scratch, "csv/status.csv", "node_id,status,latency_ms\nN1,UP,12.5\nN2,DOWN,\n")
    df = read_csv(spark, os.path.join(scratch, "csv"))
    assert df.count() == 2
    assert dict(df.dtypes)["latency_ms"] == "double"          # inferred in batch mode
    assert df.where("latency_ms IS NULL").count() == 1
    write_file(scratch, "json/a/alarms.json", json.dumps([{"alarm_id": "A1", "severity": "MAJOR"},
                                                          {"alarm_id": "A2", "severity": "MINOR"}]))
    write_file(scratch, "json/b/one.json", json.dumps({"alarm_id": "A3"}))
    write_file(scratch, "json/b/bad.json", "{not json")
    schema = "alarm_id string, severity string"
    from pyspark.sql.types import _parse_datatype_string
    j = read_json(spark, os.path.join(scratch, "json"), _parse_datatype_string(schema))
    assert j.where("alarm_id IS NOT NULL").count() == 3          # recursive, array + object
    rows = j.select("alarm_id", "_corrupt_record").collect()     # a broken file is kept, not fatal
    assert sum(r["_corrupt_record"] is not None for r in rows) == 1
    assert j.where("alarm_id = 'A3'").first()["ingest_file"].endswith("one.json")


def test_missing_and_empty_dirs_are_graceful(spark, scratch):
    os.makedirs(os.path.join(scratch, "empty"))
    for p in [os.path.join(scratch, "missing"), os.path.join(scratch, "empty")]:
        df = read_or_empty(spark, lambda s, path, sc: read_json(s, path, sc), p, UNIFIED_EVENT)
        assert df.count() == 0
        assert "event_id" in df.columns


def test_unified_event_payload_kept_as_text(spark, scratch):
    write_file(scratch, "k/e.json", json.dumps({
        "event_id": "evt-9912", "source": "Comarch OSS", "event_type": "OpticalLinkLoss",
        "timestamp": "2026-08-06T12:00:00Z", "severity": "CRITICAL", "node_id": "TOWER-DELHI-001",
        "region": "IN-NORTH-1", "payload": {"dbm_level": -32.5}}))
    r = read_json(spark, os.path.join(scratch, "k"), UNIFIED_EVENT).first()
    assert json.loads(r["payload"]) == {"dbm_level": -32.5}


def test_envelopes(spark, scratch):
    write_file(scratch, "rest/env.json", json.dumps({
        "target_system": "ServiceNow", "url": "http://x", "pages_fetched": 1, "total_records": 2,
        "collected_at_utc": "2026-08-06T12:00:00Z", "data": [{"id": 1, "status": "ACTIVE"}, {"id": 2}]}))
    write_file(scratch, "rest/empty.json", json.dumps({"target_system": "X", "data": []}))
    env = read_envelopes(spark, os.path.join(scratch, "rest"))
    recs = explode_envelope(env.drop("_corrupt_record", "ingest_file", "file_modified_at"))
    assert recs.count() == 2
    assert json.loads(recs.orderBy("record_idx").first()["record"]) == {"id": 1, "status": "ACTIVE"}


def test_kafka_decode_and_encode(spark):
    msgs = spark.createDataFrame([
        ("telecom-alarms", bytearray(json.dumps({"event_id": "e1", "source": "Alarm Events", "node_id": "n",
                                                 "timestamp": "2026-08-06T12:00:00Z",
                                                 "payload": {"vendor": "Nokia"}}).encode()), 3),
        ("tickets", bytearray(b"not json"), 4),
    ], "topic string, value binary, offset long").withColumn(
        "timestamp", F.lit("2026-08-07 00:00:00").cast("timestamp"))
    d = decode_messages(msgs).orderBy("topic").collect()
    assert d[0]["timestamp"] == "2026-08-06T12:00:00Z" and d[0]["kafka_offset"] == 3
    assert str(d[0]["kafka_timestamp"]) == "2026-08-07 00:00:00"
    assert d[0]["event_id"] == "e1" and json.loads(d[0]["payload"]) == {"vendor": "Nokia"}
    assert d[1]["event_id"] is None and d[1]["raw_value"] == "not json"
    enc = encode_messages(spark.createDataFrame([("e1", "x", "network-events")], "event_id string, a string, topic string"))
    r = enc.first()
    assert r["topic"] == "network-events" and r["key"] == "e1" and json.loads(r["value"]) == {"event_id": "e1", "a": "x"}
    fp = spark.createDataFrame([("Comarch OSS", "e1")], "source string, event_id string") \
        .select(file_prefix(F.col("source"), "event_id")).first()[0]
    assert fp == "kafka_comarch_oss_e1"


def test_partitioned_and_idempotent_writes(spark, scratch):
    df = spark.createDataFrame([("1", "2026-01-01"), ("2", "2026-01-02")], "event_id string, event_date string")
    out = os.path.join(scratch, "t")
    write_partitioned(df, out)
    assert "event_date=2026-01-01" in os.listdir(out)
    assert spark.read.parquet(out).count() == 2
    assert spark.read.parquet(out).where("event_date = '2026-01-02'").count() == 1   # partition pruning
    b = os.path.join(scratch, "b")
    write_batch(df, b, "alarms", "q--7")
    write_batch(df, b, "alarms", "q--7")       # a retried batch finds itself
    write_batch(df.limit(1), b, "alarms", "q--8")
    assert spark.read.parquet(table_path(b, "alarms")).count() == 3


def test_history_delete_with_tombstones(spark, scratch):
    h, t = os.path.join(scratch, "h"), os.path.join(scratch, "tomb")
    append_rows(spark.createDataFrame([(1, "a.csv"), (2, "b.csv")], "id long, filename string"), h)
    assert delete_by_id(spark, h, t, [2]) == 1
    assert delete_by_id(spark, h, t, [99]) == 0          # not found
    assert [r["id"] for r in read_live(spark, h, t).collect()] == [1]


def test_catalog_table_create_once(spark, scratch):
    ensure_namespace(spark, "ops_test")
    create_table(spark, "ops_test.alarms", location=os.path.join(scratch, "wh"))
    create_table(spark, "ops_test.alarms")            # second call is a no-op
    assert "alarms" in catalog.list_tables(spark, "ops_test")
    assert "ops_test" in catalog.list_namespaces(spark)
    assert catalog.sample(spark, "ops_test.alarms").count() == 0
    from siglake.plans.serving import serving_table
    from siglake.sinks.tables import append_table
    rows = serving_table(spark, "/root/testdata/sf0.001", "security_events").limit(3)
    append_table(rows, "ops_test.alarms")
    assert spark.table("ops_test.alarms").count() == 3
    import pytest
    from pyspark.errors import AnalysisException
    with pytest.raises(AnalysisException):          # v2 writes need a v2 catalog (e.g. Iceberg)
        append_table(rows, "ops_test.alarms", v2=True)
    assert "spark_catalog" in catalog.list_catalogs(spark)


def test_source_registry(spark, scratch):
    assert len(SOURCES) == 11 and {s.table for s in SOURCES} == {
        "alarms", "tickets", "network_events", "security_events", "performance_metrics"}
    df = open_source(spark, SOURCES[0], scratch, UNIFIED_EVENT, streaming=False)
    assert df.count() == 0
    import pytest
    from siglake.sources.files import SourceSpec
    with pytest.raises(ValueError):
        open_source(spark, SourceSpec("x", "x", "x", "xml"), scratch, UNIFIED_EVENT)


def test_upload_inspection(spark, scratch):
    write_file(scratch, "up/status.csv", 'node_id,status,latency_ms\nN1,UP,12\nN2,DOWN,NaN\n')
    write_file(scratch, "up/quoted.csv", 'id,"say, what",q\n1,"x, y","he said ""hi"""\n')
    write_file(scratch, "up/alarms.json", json.dumps([{"alarm_id": "A1", "severity": "MAJOR"},
                                                      {"alarm_id": "A2", "severity": "MINOR"}]))
    write_file(scratch, "up/one.json", json.dumps({"alarm_id": "A3", "vendor": "Nokia"}))
    write_file(scratch, "up/bad.json", "{oops")
    write_file(scratch, "up/script.sh", "echo hi")
    write_file(scratch, "up/empty.csv", b"")
    write_file(scratch, "up/doc.pdf", b"%PDF-1.4 ...")
    write_file(scratch, "up/tickets.xlsx", b"PK ...")
    write_file(scratch, "up/spaced.json", '\n\t [{"alarm_id": "A4"}]')
    write_file(scratch, "up/blank.csv", "\n\n")
    up = Uploads(read_binary(spark, os.path.join(scratch, "up")))
    meta = {r["filename"]: r for r in up.metadata().collect()}
    assert meta["status.csv"]["row_count"] == 2 and meta["status.csv"]["status"] == "ACCEPTED"
    assert meta["status.csv"]["columns"] == ["node_id", "status", "latency_ms"]
    assert meta["alarms.json"]["row_count"] == 2 and meta["alarms.json"]["structure"] == "array"
    assert meta["one.json"]["structure"] == "object" and meta["one.json"]["json_keys"] == ["alarm_id", "vendor"]
    assert meta["bad.json"]["reason"] == "invalid JSON"
    assert meta["script.sh"]["reason"] == "unsupported extension"
    assert "empty.csv" not in meta      # binaryFile yields no split for a 0-byte file
    assert (meta["doc.pdf"]["status"], meta["doc.pdf"]["file_type"], meta["doc.pdf"]["row_count"]) == ("ACCEPTED", "pdf", None)
    assert (meta["tickets.xlsx"]["file_type"], meta["tickets.xlsx"]["status"]) == ("excel", "ACCEPTED")
    assert meta["spaced.json"]["structure"] == "array" and meta["spaced.json"]["status"] == "ACCEPTED"
    assert meta["blank.csv"]["reason"] == "no CSV header"
    assert len(meta["status.csv"]["sha256_hash"]) == 64
    recs = {(r["path"].rsplit("/", 1)[1], r["row_idx"]): json.loads(r["record"]) for r in up.records().collect()}
    assert recs["status.csv", 1] == {"node_id": "N2", "status": "DOWN", "latency_ms": None}
    assert recs["quoted.csv", 0] == {"id": "1", "say, what": "x, y", "q": 'he said "hi"'}
    assert recs["spaced.json", 0] == {"alarm_id": "A4"} and len(recs) == 7    # 2 + 1 csv, 2 + 1 array, 1 object
    ids = [r["event_id"] for r in up.events().collect()]
    assert len(set(ids)) == 7 and all(i.startswith("UPLOAD-") and len(i) > 64 for i in ids)
    assert up.events(cap=1).count() == 5
    hist = {r["filename"]: r for r in up.history().collect()}
    assert hist["status.csv"]["records_count"] == 2 and hist["status.csv"]["kafka_topic"] == "network-events"
    assert hist["script.sh"]["status"] == "FAILED" and hist["bad.json"]["error_message"] == "invalid JSON"
    assert len({r["id"] for r in hist.values()}) == len(hist)


def test_every_record_of_an_upload_counts(spark, scratch):
    body = "event_id,v\n" + "".join(f"E{i},{i}\n" for i in range(1200))
    write_file(scratch, "up/a.csv", body)
    write_file(scratch, "up/b.csv", body)                   # equal bytes, another file
    up = Uploads(read_binary(spark, os.path.join(scratch, "up")))
    assert up.events().select("event_id").distinct().count() == 2400
    assert {r["records_count"] for r in up.history().collect()} == {1200}


def test_no_upload_content_breaks_the_batch(spark, scratch):
    for i, content in enumerate([b"\x00\x01\xff", b'"open quote,b\n1,2', b"a" * 50_000, b"[[[[", b"{}", b"[]", b"null",
                                 b"\xef\xbb\xbfx,y\n1,2\n", b",,,\n1,2,3,4\n", b'{"a":1,"a":2}']):
        write_file(scratch, f"up/f{i}.csv", content)
        write_file(scratch, f"up/f{i}.json", content)
    up = Uploads(read_binary(spark, os.path.join(scratch, "up")))
    meta = {r["filename"]: r for r in up.metadata().collect()}
    assert len(meta) == 20 and up.history().count() == 20
    assert up.events().count() == up.records().count()
    assert meta["f7.csv"]["columns"] == ["x", "y"] and meta["f3.json"]["status"] == "REJECTED"


def test_files_of_many_headers_are_read_once_in_one_plan(spark, scratch):
    for i in range(200):
        write_file(scratch, f"up/f{i:03d}.csv", f"id,c{i},note\n{i},007,\"a\nb, \"\"{i}\"\"\"\n{i},,5\" pipe,extra\n")
    up = Uploads(read_binary(spark, os.path.join(scratch, "up")))
    recs, meta = up.records(), up.metadata()
    got = {(r["path"][-8:-4], r["row_idx"]): json.loads(r["record"]) for r in recs.collect()}
    assert len(got) == 400
    assert got["f042", 0] == {"id": "42", "c42": "007", "note": 'a\nb, "42"'}
    assert got["f199", 1] == {"id": "199", "c199": None, "note": '5" pipe'}
    assert {(r["columns"][1], r["row_count"]) for r in meta.collect()} == {(f"c{i}", 2) for i in range(200)}
    for df in (recs, meta):
        plan = df._jdf.queryExecution().executedPlan()
        assert plan.toString().count("FileScan") == 1 and "Exchange" not in plan.toString()
        while plan.children().size():
            plan = plan.children().apply(0)
        assert plan.metrics().apply("numOutputRows").value() == 200          # each file once


def test_long_csv_texts_match_without_recursion(spark, scratch):
    write_file(scratch, "up/a.csv", "a,b\n" + '"' + "x\n" * 200_000 + '",' + '""' * 100_001 + "\r\n" + "1,2\r\n" * 1000)
    write_file(scratch, "up/wide.csv", ",".join(f"c{i}" for i in range(3000)) + "\n" + "," * 5000 + "\n")
    up = Uploads(read_binary(spark, os.path.join(scratch, "up")))
    meta = {r["filename"]: r for r in up.metadata().collect()}
    assert meta["a.csv"]["row_count"] == 1001 and len(meta["wide.csv"]["columns"]) == 3000
    first = [json.loads(r["record"]) for r in up.records().where("row_idx = 0 AND path LIKE '%a.csv'").collect()][0]
    assert first["a"] == "x\n" * 200_000 and first["b"] == '"' * 100_000
    assert up.records().count() == 1002


def test_upload_paths_keep_bucket_and_host(spark):
    from siglake.operators.uploads import _path
    paths = ["s3a://bucket/k/a.csv", "hdfs://nn:8020/up/a.csv", "file:///tmp/a.csv", "file:/tmp/a.csv",
             "abfss://box@account.host/x/a.json", "gs://b/x//y.csv"]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in paths], "path string").select(_path("path")).collect()]
    assert got == [paths[0], paths[1], "file:/tmp/a.csv", "file:/tmp/a.csv", paths[4], paths[5]]

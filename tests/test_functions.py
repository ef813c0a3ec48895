"""Column expressions: severity, time, payload, routing, files, health."""

from pyspark.sql import functions as F

from siglake.functions import (category_route, connector_severity, content_type_of, event_date,
                               file_type_of, health_score, lake_severity, object_key_parts,
                               payload_field, sha256_hex, source_slug)
from siglake.operators.normalize import clean_events


def col_values(df, c):
    return [r[c] for r in df.collect()]


def test_lake_severity_rules(spark):
    raw = ["Critical", "crit-1", "P1", "P10", "major", "HIGH", "p2", "minor", "Medium", "P3",
           "administrative", "WARN", "warning", "low", "", None, "INFO"]
    df = spark.createDataFrame([(r,) for r in raw], "s string")
    got = col_values(df.select(lake_severity("s").alias("x")), "x")
    assert got == ["CRITICAL", "CRITICAL", "CRITICAL", "CRITICAL", "MAJOR", "MAJOR", "MAJOR",
                   "MINOR", "MINOR", "MINOR", "MINOR", "WARNING", "WARNING", "INFO", "INFO", "INFO", "INFO"]


def test_connector_severity_differs_on_fragments(spark):
    raw = ["CRIT", "MAJ", "MIN", "MED", "WARN", "CRITICAL", "major", "medium", "Warning", "", None, "HIGH"]
    df = spark.createDataFrame([(r,) for r in raw], "s string")
    got = col_values(df.select(connector_severity("s").alias("x")), "x")
    assert got == ["INFO", "INFO", "INFO", "INFO", "INFO", "CRITICAL", "MAJOR", "MINOR", "WARNING",
                   "INFO", "INFO", "MAJOR"]


def test_connector_severity_first_truthy(spark):
    df = spark.createDataFrame([(None, "HIGH", "P3"), ("", None, "P3"), (None, None, None)],
                               "severity string, threat_level string, priority string")
    got = col_values(df.select(connector_severity("severity", "threat_level", "priority").alias("x")), "x")
    assert got == ["MAJOR", "MINOR", "INFO"]


def test_event_time_candidates_and_bad_values(spark):
    df = spark.createDataFrame(
        [("2026-08-06T12:00:00Z", "2020-01-01T00:00:00Z"), ("nope", "2020-01-01T00:00:00Z"), (None, None)],
        "created_at string, time string")
    out = clean_events(df).select("event_timestamp", "event_date").collect()
    # created_at is picked over time (schema-level choice), bad text -> NULL
    assert str(out[0][0]) == "2026-08-06 12:00:00"
    assert out[0][1] == "2026-08-06"
    assert out[1][0] is None and out[1][1] is None
    assert out[2][0] is None


def test_event_time_offset_and_fallback(spark):
    df = spark.createDataFrame([("2026-08-06T12:00:00.5+05:30",)], "timestamp string")
    ts = clean_events(df).select(F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss.S")).first()[0]
    assert ts == "2026-08-06 06:30:00.5"
    nots = spark.createDataFrame([("a",)], "x string").withColumn(
        "mtime", F.lit("2025-05-05 05:00:00").cast("timestamp"))
    c = clean_events(nots, fallback_time=F.col("mtime")).select("event_date", "severity_clean").first()
    assert c["event_date"] == "2025-05-05" and c["severity_clean"] == "INFO"


def test_payload_json_string(spark):
    df = spark.createDataFrame([
        ('{"vendorName": "Nokia", "siteId": 7, "metrics": {"a": 1}}',),
        ('{"vendor": "Huawei", "vendor_name": "X"}',),
        ("not json",),
        (None,),
        ("[1,2]",),
    ], "payload string")
    out = clean_events(df).select("vendor", "site_name").collect()
    assert [r["vendor"] for r in out] == ["Nokia", "Huawei", None, None, None]
    assert out[0]["site_name"] == "7"
    nested = df.select(payload_field(df, ["metrics"]).alias("m")).first()["m"]
    assert nested.replace(" ", "") == '{"a":1}'


def test_payload_struct_coalesces_all_present_fields(spark):
    df = spark.createDataFrame([(("Nokia", None),), ((None, "Ericsson"),)],
                               "payload struct<vendor:string, vendorName:string>")
    got = col_values(clean_events(df).select("vendor"), "vendor")
    assert got == ["Nokia", "Ericsson"]  # deviation: both rows keep a value


def test_payload_map_and_guards(spark):
    df = spark.createDataFrame([({"deviceId": "D1"},), ({},)], "payload map<string,string>")
    assert col_values(clean_events(df).select("device_name"), "device_name") == ["D1", None]
    # target already present -> untouched; no payload -> NULL
    top = spark.createDataFrame([("keep", '{"vendor":"x"}')], "vendor string, payload string")
    assert clean_events(top).first()["vendor"] == "keep"
    nop = spark.createDataFrame([("a",)], "x string")
    assert clean_events(nop).first()["ticket_id"] is None
    other = spark.createDataFrame([(5,)], "payload int")
    assert clean_events(other).first()["vendor"] is None


def test_category_routing(spark):
    rows = [
        ("telecom-alarms", None, None, None), ("tickets", None, None, None),
        ("network-events", None, None, None), ("security-events", None, None, None),
        ("performance", None, None, None),
        ("unknown", "CellTowerDown", None, None),
        (None, None, "Alarm Events", None), (None, "x", None, "INC-7"),
        (None, "ThreatDetected", None, None), (None, "prf_sample", None, None),
        (None, "view", "Comarch OSS", "1"),
    ]
    df = spark.createDataFrame(rows, "topic string, event_type string, source string, event_id string")
    got = col_values(df.select(category_route(topic="topic").alias("c")), "c")
    assert got == ["alarms", "tickets", "network", "security", "performance", "network",
                   "alarms", "tickets", "security", "performance", "unrouted"]
    ex = spark.createDataFrame([("alarm",), ("kafka/network",), ("",)], "cat string")
    got = col_values(ex.select(category_route(explicit="cat", event_type=None, source=None,
                                              event_id=None).alias("c")), "c")
    assert got == ["alarms", "network", "unrouted"]


def test_files_and_ids(spark):
    names = ["a.CSV", "b.json", "c.xlsx", "d.xls", "e.pdf", "script.sh", "noext", None]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    out = df.select(file_type_of("f").alias("t")).select("t", content_type_of("t").alias("ct")).collect()
    assert [r["t"] for r in out] == ["csv", "json", "excel", "excel", "pdf", None, None, None]
    assert out[0]["ct"] == "text/csv" and out[5]["ct"] == "application/octet-stream"
    s = spark.createDataFrame([("Comarch OSS", "abc")], "src string, body string")
    r = s.select(source_slug("src").alias("slug"), sha256_hex("body").alias("h")).first()
    assert r["slug"] == "comarch_oss"
    assert r["h"] == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"


def test_object_key_parse(spark):
    key = "raw/kafka/alarms/2026/08/07/20260807_140000_123456_deadbeef_kafka_comarch_oss_evt-1"
    df = spark.createDataFrame([(key,), ("elsewhere/x",)], "p string")
    parts = object_key_parts("p")
    out = df.select(*[v.alias(k) for k, v in parts.items()]).collect()
    assert out[0]["key_category"] == "kafka/alarms"
    assert out[0]["key_date"] == "2026-08-07"
    assert out[0]["key_uuid"] == "deadbeef"
    assert out[0]["key_name"] == "kafka_comarch_oss_evt-1"
    assert out[1]["key_category"] is None


def test_health_score_truncates_and_clamps(spark):
    df = spark.createDataFrame([(0.0, 0.0), (4.5, 85.0), (0.01, 8.0), (10.0, 500.0), (0.5, 12.3)],
                               "loss double, lat double")
    got = col_values(df.select(health_score("loss", "lat").alias("h")), "h")
    # 100-0.15-1.6 = 98.25 -> 98 ; 100-7.5-2.46 = 90.04 -> 90
    assert got == [100, 15, 98, 0, 90]


def test_event_date_helper(spark):
    df = spark.createDataFrame([("2024-02-29 23:59:59",)], "s string").select(
        F.col("s").cast("timestamp").alias("t"))
    assert df.select(event_date("t")).first()[0] == "2024-02-29"

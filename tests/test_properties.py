"""Rule tables and property tests.

The rules' expected values stand in tables; the property tests hold operators
against plain Python over random rows, one Spark job for a whole batch of rows.
"""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siglake.functions import category_route, connector_severity, lake_severity

# label -> (landing-zone severity, connector severity)
SEVERITIES = {
    None: ("INFO", "INFO"), "": ("INFO", "INFO"), "low": ("INFO", "INFO"), "x": ("INFO", "INFO"),
    "info": ("INFO", "INFO"), "CRITICAL": ("CRITICAL", "CRITICAL"), "critical!": ("CRITICAL", "CRITICAL"),
    "crit": ("CRITICAL", "INFO"), "p1": ("CRITICAL", "CRITICAL"), "P10": ("CRITICAL", "CRITICAL"),
    "Major": ("MAJOR", "MAJOR"), "maj": ("MAJOR", "INFO"), "high": ("MAJOR", "MAJOR"), "1 - High": ("MAJOR", "MAJOR"),
    "p2": ("MAJOR", "MAJOR"), "minor": ("MINOR", "MINOR"), "min": ("MINOR", "INFO"), "Medium": ("MINOR", "MINOR"),
    "med": ("MINOR", "INFO"), "p3": ("MINOR", "MINOR"), "admin": ("MINOR", "INFO"), "warning": ("WARNING", "WARNING"),
    "warn": ("WARNING", "INFO"), "major warning": ("MAJOR", "MAJOR"), "minor p1": ("CRITICAL", "CRITICAL"),
    "medium high": ("MAJOR", "MAJOR"), " ": ("INFO", "INFO"),
}
# (topic, event type, source, event id) -> category
ROUTES = {
    ("telecom-alarms", None, None, None): "alarms", ("tickets", "alarm", None, None): "tickets",
    ("network-events", None, "security", None): "network", ("security-events", None, None, "INC1"): "security",
    ("performance", None, None, None): "performance",
    ("telecom-events", "LinkAlarm", None, None): "alarms", ("other", None, "Alarm Events", None): "alarms",
    (None, "TicketOpened", None, None): "tickets", (None, None, "ticket events", None): "tickets",
    (None, None, None, "inc-77"): "tickets", (None, "alarm", "ticket", "inc"): "alarms",
    (None, "NetDown", None, None): "network", (None, None, "Network feed", None): "network",
    (None, "CellTowerDown", None, None): "network", (None, "SecBreach", None, None): "security",
    (None, None, "SECURITY", None): "security", (None, "ThreatSeen", None, None): "security",
    (None, "prf", None, None): "performance", (None, None, "perf-agent", None): "performance",
    (None, "metric", None, None): "performance", (None, "metric threat", None, None): "security",
    (None, "net sec", None, None): "network", (None, "view", "Comarch OSS", "E1"): "unrouted",
    ("telecom-events", None, None, None): "unrouted", (None, None, None, None): "unrouted", ("", "", "", ""): "unrouted",
}


def test_severity_table(spark):
    df = spark.createDataFrame([(k,) for k in SEVERITIES], "a string")
    for r in df.select("a", lake_severity("a").alias("lake"), connector_severity("a").alias("conn")).collect():
        assert (r["lake"], r["conn"]) == SEVERITIES[r["a"]], r


def test_connector_takes_the_first_value_given(spark):
    rows = [(None, "p1", "warning"), ("", "major", None), ("low", "p1", None), (None, None, None)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    got = [r[0] for r in df.select(connector_severity("a", "b", "c")).collect()]
    assert got == ["CRITICAL", "MAJOR", "INFO", "INFO"]


def test_routing_table(spark):
    df = spark.createDataFrame(list(ROUTES), "topic string, event_type string, source string, event_id string")
    for r in df.select("*", category_route(topic="topic").alias("cat")).collect():
        assert r["cat"] == ROUTES[tuple(r)[:4]], r


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 50), st.integers(0, 3)),
                min_size=5, max_size=80))
def test_dedup_keeps_exactly_the_newest_per_id(spark, rows):
    from siglake.operators.dedup import dedup_latest
    df = spark.createDataFrame(rows, "event_id string, ts int, v int") \
        .withColumn("event_timestamp", F.timestamp_seconds("ts")).drop("ts")
    got = sorted((r["event_id"], r["v"], r["event_timestamp"]) for r in dedup_latest(df).collect()
                 if r["event_id"] is not None)
    best = {}
    for eid, ts, v in rows:
        if eid is not None and (eid not in best or (ts, v) > best[eid]):
            best[eid] = (ts, v)
    assert [(e, v) for e, v, _ in got] == sorted((e, tv[1]) for e, tv in best.items())
    nulls = dedup_latest(df).where("event_id IS NULL").count()
    assert nulls == sum(1 for r in rows if r[0] is None)      # every id-less row kept


CELL = st.text(alphabet=st.sampled_from(list("ab ,\"x1-\n")), max_size=6).filter(
    lambda v: v == v.strip())


@settings(max_examples=4, deadline=None)
@given(st.integers(1, 4).flatmap(lambda n: st.lists(st.lists(CELL, min_size=n, max_size=n),
                                                     min_size=1, max_size=6)))
def test_csv_upload_records_match_python_csv(spark, rows):
    import csv
    import io
    import json
    import os
    import tempfile
    from siglake.operators.uploads import NA_TOKENS, Uploads
    from siglake.sources.files import read_binary
    header = [f"c{i}" for i in range(len(rows[0]))]
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator="\n")
    w.writerow(header)
    w.writerows(rows)
    d = tempfile.mkdtemp(prefix="siglake-csvprop-")
    with open(os.path.join(d, "u.csv"), "w") as f:
        f.write(buf.getvalue())
    got = [json.loads(r["record"]) for r in
           Uploads(read_binary(spark, d)).records().orderBy("row_idx").collect()]
    want = []
    for rec in csv.DictReader(io.StringIO(buf.getvalue())):   # skips only blank lines
        want.append({k: (None if v in NA_TOKENS else v) for k, v in rec.items()})
    assert got == want


def test_csv_duplicate_and_ragged_columns(spark, scratch):
    import json
    import os
    from siglake.operators.uploads import Uploads
    from siglake.sources.files import read_binary
    with open(os.path.join(scratch, "d.csv"), "w") as f:
        f.write("a,b,a,a\n1,2,3,4\n5,6\n7,8,9,10,11\n")
    recs = [json.loads(r["record"]) for r in
            Uploads(read_binary(spark, scratch)).records().orderBy("row_idx").collect()]
    assert recs == [{"a": "1", "b": "2", "a.1": "3", "a.2": "4"},
                    {"a": "5", "b": "6", "a.1": None, "a.2": None},
                    {"a": "7", "b": "8", "a.1": "9", "a.2": "10"}]


def test_csv_quoted_line_breaks_and_awkward_headers(spark, scratch):
    import json
    import os
    from siglake.operators.uploads import Uploads, unique_names
    from siglake.sources.files import read_binary
    with open(os.path.join(scratch, "q.csv"), "w") as f:
        f.write('id,"say, what"\n1,"two\nlines"\n2,"he said ""hi"""\n')
    with open(os.path.join(scratch, "h.csv"), "w") as f:
        f.write("a,a,a.1,A\n1,2,3,4\n")
    up = Uploads(read_binary(spark, scratch))
    recs = {(r["path"][-5:], r["row_idx"]): json.loads(r["record"]) for r in up.records().collect()}
    assert recs == {("q.csv", 0): {"id": "1", "say, what": "two\nlines"}, ("q.csv", 1): {"id": "2", "say, what": 'he said "hi"'},
                    ("h.csv", 0): {"a": "1", "a.2": "2", "a.1": "3", "A.3": "4"}}
    assert {r["row_count"] for r in up.metadata().collect()} == {1, 2}
    names = spark.createDataFrame([(["x", "x", "x.1", "X"],)], "n array<string>")
    assert names.select(unique_names(F.col("n"))).first()[0] == ["x", "x.2", "x.1", "X.3"]

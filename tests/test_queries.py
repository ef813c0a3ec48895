"""Every registered query against its DuckDB SQL (the driver's check, locally).

Runs at sf0.001 by default; set SIGLAKE_TEST_SF to another driver folder to
repeat at a larger scale.
"""

import os

import pytest

from conftest import SMOKE_SF

SF_DIR = os.environ.get("SIGLAKE_TEST_SF", SMOKE_SF)
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["time", "alarms_count"]
    assert df.count() > 0


def test_every_query_has_sql_or_is_declared(spark):
    import __spark_entry__ as e
    qs, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 56
    own = {q for q in qs if not q.startswith("op") and q != "pipeline"}
    assert own - set(sql) == set()         # every query of the platform has an oracle


def test_queries_match_oracle(spark):
    from verify import compare
    report = compare(spark, SF_DIR, verbose=False)
    bad = {k: v for k, v in report.items() if not v["ok"]}
    assert not bad, bad


def test_results_do_not_depend_on_session_zone(spark):
    """A caller's session in a zone with midnight DST switches gets UTC results."""
    from verify import compare
    key = "spark.sql.session.timeZone"
    prev = spark.conf.get(key)
    spark.conf.set(key, "America/Sao_Paulo")
    try:
        names = ["tickets_hourly", "performance_metrics_hourly", "event_time_resolve",
                 "connector_normalize", "recent_alarms"]
        report = compare(spark, SF_DIR, names, verbose=False)
    finally:
        spark.conf.set(key, prev)
    assert all(v["ok"] for v in report.values()), report

"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
  {"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed in full: its result goes to the ``noop`` sink, which
takes every row and column, so nothing is pruned. Nothing is cached between
queries. A warm-up query (excluded from the timings) pays the JVM/JIT start-up once.
The registered queries rebuild each serving table from the raw inputs.
With BENCH_MATERIALIZED=1 two extra fields time the production path
(tables materialised once, panels read the date-partitioned tables).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from siglake.plans.catalog import all_queries
    from siglake.session import get_session

    spark = get_session(f"local[{cpus}]", app="siglake-bench",
                        shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", int(cpus) * 2)),
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                               "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)})
    qs = all_queries()
    names = only or list(qs)

    run(qs["total_alarms"](spark, sf_dir))  # warm-up

    timings: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        run(qs[name](spark, sf_dir))
        timings[name] = round(time.perf_counter() - t0, 3)

    # Production path: build the five serving tables once (date-partitioned
    # parquet under the shared checkpoint folder), then answer every panel
    # from them.
    extra = {}
    if not only and os.environ.get("BENCH_MATERIALIZED", "0") == "1":
        from siglake.plans import serving
        from siglake.session import shared_path
        from siglake.sinks.tables import read_serving
        out = shared_path(spark, "bench-serving", str(int(time.time() * 1000)))
        t0 = time.perf_counter()
        serving.materialize(spark, sf_dir, out)
        extra["serving_build_sec"] = round(time.perf_counter() - t0, 3)
        t0 = time.perf_counter()
        for table, spec in serving.PANELS.items():
            t = read_serving(spark, out, table)
            run(serving.panel_total(t, spec))
            run(serving.panel_by_severity(t, spec))
            for dim in spec.dims:
                run(serving.panel_by_dim(t, spec, dim))
            run(serving.panel_hourly(t, spec))
            run(serving.panel_recent(t, spec))
        extra["panels_on_materialized_sec"] = round(time.perf_counter() - t0, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "n_queries": len(timings),
        **extra,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Command-line entry points (``spark-submit -m siglake ...`` or ``python -m siglake``).

  stream       landing-zone job: one query per registry source -> serving tables
  ingest       message ingestion: (topic, value) records -> landing + quarantine
  materialize  batch build of all serving tables from the driver tables
  compact      fold the stored batches of serving tables into one
  panel        run a dashboard statement (or any SQL) over serving tables
  lookup       the newest version of one event of a serving table
  settle       write the files anew that hold deleted rows of a history

Settings the cluster owns (``spark.checkpoint.dir``, shuffle width, memory)
come from the spark-submit configuration; the streaming commands add FAIR
scheduling and the RocksDB state store.
"""

from __future__ import annotations

import argparse
import json
import signal
import sys
import time


# Streaming state (windows) lives in RocksDB, off the JVM heap, so large key
# sets do not pressure executor memory.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.scheduler.mode": "FAIR",
}
FLUSH_ROWS = 200      # run-log rows written together while a job runs


def _session(app: str, master: str | None, extra: dict | None = None):
    from siglake.session import get_session
    return get_session(master, app=app, extra=extra)


def run_stream(args) -> int:
    from siglake.sinks.landing import send
    from siglake.sources.files import SOURCES
    from siglake.streaming import follow, job, monitor

    spark = _session("siglake-stream", args.master, STREAM_CONF)
    cfg = job.StreamConfig(landing_root=args.landing, output_root=args.output,
                           checkpoint_root=args.checkpoints,
                           trigger_seconds=None if args.once else args.trigger_seconds,
                           max_files_per_trigger=args.max_files, table_prefix=args.table_prefix,
                           publish=(lambda df: send(df, args.bootstrap)) if args.bootstrap else None,
                           hourly=args.hourly, drop_repeats=args.drop_repeats)
    waiting = [s for s in SOURCES if not args.sources or s.category in args.sources]
    log_path = args.run_log or f"{args.output.rstrip('/')}/run_log"
    listener = monitor.attach(spark)
    tables = [s.table for s in waiting]
    queries: list = []
    followers: list = []
    stopping = {"flag": False}

    def stop(*_):
        stopping["flag"] = True

    signal.signal(signal.SIGTERM, stop)
    signal.signal(signal.SIGINT, stop)
    try:
        while not stopping["flag"]:
            started, waiting = job.start_all(spark, waiting, cfg)
            queries += started
            print(json.dumps({"queries": monitor.query_status(queries),
                              "waiting": [s.category for s in waiting]}), flush=True)      # I5
            listener.flush(spark, log_path, FLUSH_ROWS)
            if not any(q.isActive for q in queries) and (args.once or queries):
                break
            if not args.once:
                followers += follow.start_followers(spark, cfg, tables, followers)
            time.sleep(args.monitor_seconds)
        if args.once:                              # what the sources brought is there now
            followers += follow.start_followers(spark, cfg, tables)
            for q in followers:
                while q.isActive and not stopping["flag"]:
                    q.awaitTermination(1)
    finally:
        job.stop_all(queries + followers)                                       # I6
        time.sleep(min(args.monitor_seconds, 2.0))       # the last progress events arrive
        listener.flush(spark, log_path)
        spark.streams.removeListener(listener)
    failed = [q.name for q in queries + followers if q.exception() is not None]
    return 1 if failed else 0


def run_ingest(args) -> int:
    from siglake.streaming import ingest
    from siglake.sources.kafka import read_topics

    spark = _session("siglake-ingest", args.master, STREAM_CONF)
    if args.bootstrap:
        records = read_topics(spark, args.bootstrap)
    else:
        records = ingest.json_record_stream(spark, args.records)
    q = ingest.start_ingest(records, args.landing, args.quarantine, args.checkpoint,
                            trigger_seconds=None if args.once else args.trigger_seconds)
    q.awaitTermination()
    return 0 if q.exception() is None else 1


def run_materialize(args) -> int:
    from siglake.plans import serving

    spark = _session("siglake-materialize", args.master)
    print(json.dumps(serving.materialize(spark, args.inputs, args.output, args.tables or None)))
    return 0


def run_compact(args) -> int:
    from siglake.plans.serving import PANELS
    from siglake.sinks.tables import compact

    spark = _session("siglake-compact", args.master)
    print(json.dumps({t: compact(spark, args.serving, t, f"{args.table_prefix}{t}" if args.table_prefix else None)
                      for t in args.tables or PANELS}))
    return 0


def run_panel(args) -> int:
    from siglake.plans import dashboards

    spark = _session("siglake-panel", args.master)
    dashboards.register_serving(spark, args.serving, args.since, args.until)
    df = spark.sql(args.sql) if args.sql else dashboards.run_panel(spark, args.name)
    if args.output:
        df.write.mode("overwrite").format(args.format).save(args.output)
    else:
        print("\t".join(df.columns))
        for row in df.toLocalIterator():             # all rows, a partition at a time
            print("\t".join("" if v is None else str(v) for v in row))
    return 0


def run_lookup(args) -> int:
    from siglake.sinks.tables import lookup_event

    spark = _session("siglake-lookup", args.master)
    rows = lookup_event(spark, args.serving, args.table, args.id).toJSON().collect()     # one row, or none
    print("\n".join(rows))
    return 0 if rows else 1


def run_settle(args) -> int:
    from siglake.sinks.history import settle_deletes

    spark = _session("siglake-settle", args.master)
    print(json.dumps({"files": settle_deletes(spark, args.history, args.tombstones, args.id_column)}))
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="siglake")
    p.add_argument("--master", default=None, help="only for local runs; spark-submit sets it")
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("stream", help="landing zone -> serving tables")
    s.add_argument("--landing", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--checkpoints", default=None, help="default: streams under spark.checkpoint.dir")
    s.add_argument("--sources", nargs="*", default=None, help="registry categories to run")
    s.add_argument("--trigger-seconds", type=int, default=15)
    s.add_argument("--max-files", type=int, default=50)
    s.add_argument("--table-prefix", default=None, help="also register catalog tables, e.g. ops.")
    s.add_argument("--bootstrap", default=None, help="publish upload and REST events to these Kafka servers")
    s.add_argument("--drop-repeats", default=None, help="drop equal events that arrive again within this delay, e.g. '2 days'")
    s.add_argument("--hourly", action="store_true", help="keep hourly counts of each table")
    s.add_argument("--monitor-seconds", type=float, default=30.0)
    s.add_argument("--run-log", default=None, help="default: run_log under the output")
    s.add_argument("--once", action="store_true", help="drain what is there and stop")
    s.set_defaults(fn=run_stream)

    i = sub.add_parser("ingest", help="(topic, value) records -> landing + quarantine")
    i.add_argument("--bootstrap", default=None, help="Kafka servers (needs the Kafka connector)")
    i.add_argument("--records", default=None, help="folder of JSON-lines (topic, value) records")
    i.add_argument("--landing", required=True)
    i.add_argument("--quarantine", required=True)
    i.add_argument("--checkpoint", required=True)
    i.add_argument("--trigger-seconds", type=int, default=15)
    i.add_argument("--once", action="store_true")
    i.set_defaults(fn=run_ingest)

    m = sub.add_parser("materialize", help="build the serving tables from the driver tables")
    m.add_argument("--inputs", required=True)
    m.add_argument("--output", required=True)
    m.add_argument("--tables", nargs="*", default=None)
    m.set_defaults(fn=run_materialize)

    c = sub.add_parser("compact", help="fold the dates that new batches of serving tables touch")
    c.add_argument("--serving", required=True)
    c.add_argument("--tables", nargs="*", default=None)
    c.add_argument("--table-prefix", default=None, help="catalog tables that the stream registered, e.g. ops.")
    c.set_defaults(fn=run_compact)

    q = sub.add_parser("panel", help="dashboard SQL over serving tables")
    q.add_argument("--serving", required=True, help="folder written by `materialize` or `stream`")
    q.add_argument("--name", default="total_alarms", help="panel name (see plans/dashboards.py)")
    q.add_argument("--sql", default=None, help="any SQL over alarms, tickets, network_events, ...")
    q.add_argument("--since", default=None, help="first event time, e.g. 2024-01-02 00:00:00")
    q.add_argument("--until", default=None, help="event time before which the panel ends")
    q.add_argument("--output", default=None, help="write the rows here instead of printing them")
    q.add_argument("--format", default="parquet", choices=["parquet", "json", "csv"])
    q.set_defaults(fn=run_panel)

    k = sub.add_parser("lookup", help="one event of a serving table, as JSON; exit code 1 if there is none")
    k.add_argument("--serving", required=True)
    k.add_argument("--table", required=True)
    k.add_argument("--id", required=True)
    k.set_defaults(fn=run_lookup)

    d = sub.add_parser("settle", help="take deleted rows out of the files of a history")
    d.add_argument("--history", required=True)
    d.add_argument("--tombstones", required=True)
    d.add_argument("--id-column", default="id")
    d.set_defaults(fn=run_settle)

    args = p.parse_args(argv)
    return args.fn(args)


if __name__ == "__main__":
    sys.exit(main())

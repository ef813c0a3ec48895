"""Session construction and shared-folder settings.

The library never hard-codes a cluster path. Lineage cuts and streaming
checkpoints go under the folder the cluster names in ``spark.checkpoint.dir``;
only when that is unset (tests, local runs) do we create one ourselves.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every siglake session relies on. UTC keeps event_date and hourly
# buckets identical on every executor whatever the host zone is.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "siglake",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the siglake defaults applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/object-store)
    folder; it is read from the session and never replaced, and a cluster
    session without it is an error (a machine-local folder would vanish with
    the executor that wrote it). Only a ``local[...]`` session (tests, local
    runs) gets a fresh scratch folder registered when none is set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster session")
    local = tempfile.mkdtemp(prefix="siglake-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def stable_checkpoint_root(spark: SparkSession) -> str | None:
    """The folder that ``spark.checkpoint.dir`` names, the same in every application.

    ``getCheckpointDir`` is a new sub-folder in each application: right for
    staged tables, wrong for a stream that must find its checkpoint again.
    """
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for stream state, staged tables)."""
    base = checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *[p.strip("/") for p in parts]])


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss).

    ``localCheckpoint`` is deliberately not used: its blocks live on executors
    and vanish with them.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)

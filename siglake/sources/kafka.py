"""Kafka source.

The Kafka connector JAR is not bundled; ``read_topics`` works wherever it is
on the classpath. ``decode_messages`` is the part that matters and runs on
any ``(topic, value)`` frame - a Kafka stream or a static frame in tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siglake.schemas import TOPIC_CATEGORIES, UNIFIED_EVENT

# Subscribed topics (the catch-all plus one per category).
TOPICS = ["telecom-events", *TOPIC_CATEGORIES]


def read_topics(spark: SparkSession, bootstrap_servers: str, topics: list[str] | None = None,
                starting_offsets: str = "earliest", streaming: bool = True) -> DataFrame:
    """Subscribe to the topics (needs the spark-sql-kafka package)."""
    r = spark.readStream if streaming else spark.read
    return (r.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", ",".join(topics or TOPICS))
            .option("startingOffsets", starting_offsets)
            .load())


def decode_messages(df: DataFrame, schema: T.StructType = UNIFIED_EVENT) -> DataFrame:
    """``value`` (UTF-8 JSON) -> the event columns, ``extra``, ``topic`` and ``raw_value``.

    ``extra`` maps every other top-level field to its text (see
    ``operators.normalize.resolve_lenient``), so no part of a message is lost.

    A value that is not a JSON object gives NULL event columns and keeps its
    text in ``raw_value``, so validation routes it to quarantine.
    """
    text = F.col("value").cast("string")
    parsed = F.from_json(text, schema, {"mode": "PERMISSIVE"})
    cols = [parsed.getField(f.name).alias(f.name) for f in schema.fields]
    every = F.from_json(text, T.MapType(T.StringType(), T.StringType()))
    names = [f.name for f in schema.fields]
    extra = F.map_filter(every, lambda k, v: v.isNotNull() & ~k.isin(*names))
    # Kafka's own record metadata, renamed where it would clash with event fields.
    meta = [F.col(c).alias(f"kafka_{c}") for c in ("partition", "offset", "timestamp") if c in df.columns]
    return df.select(*cols, extra.alias("extra"), F.col("topic"), text.alias("raw_value"), *meta)

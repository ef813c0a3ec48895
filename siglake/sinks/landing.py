"""Raw landing zone and topic publishing.

The platform wrote one object per event. Here events are written as JSON
lines partitioned by ``category`` and ``ingest_date``: few, large files,
the layout the streaming readers consume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siglake.functions.files import source_slug
from siglake.functions.timeparse import event_date

MESSAGE = "key string, topic string, value string"


def file_prefix(source, event_id) -> F.Column:
    """``kafka_<source slug>_<event id>`` (the platform's object prefix)."""
    return F.concat_ws("_", F.lit("kafka"), source_slug(source), F.col(event_id) if isinstance(event_id, str) else event_id)


def encode_messages(df: DataFrame, topic: str | None = None, topic_col: str | None = "topic",
                    key_col: str | None = "event_id") -> DataFrame:
    """B6 (encode half): ``(key, topic, value)`` with the row as JSON text.

    Pass the result to ``.write.format("kafka")`` where the connector exists.
    """
    body = [c for c in df.columns if c != topic_col]
    t = F.lit(topic) if topic else F.col(topic_col)
    key = F.col(key_col).cast("string") if key_col and key_col in df.columns else F.lit(None).cast("string")
    return df.select(key.alias("key"), t.alias("topic"),
                     F.to_json(F.struct(*[F.col(c) for c in body])).alias("value"))


def send(messages: DataFrame, bootstrap_servers: str) -> None:
    """Write encoded messages to Kafka (needs the spark-sql-kafka package)."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).save()


def publish(df: DataFrame, bootstrap_servers: str, topic: str | None = None,
            topic_col: str | None = "topic") -> None:
    """Write rows to Kafka as JSON."""
    send(encode_messages(df, topic=topic, topic_col=topic_col), bootstrap_servers)

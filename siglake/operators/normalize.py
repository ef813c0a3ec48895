"""Normalisation transforms.

* ``clean_events``       - the landing-zone clean step (C1, C3, C4, C8, C9).
* ``connector_normalize`` - REST record -> unified event (C2, C10, C11, C12).
* ``upload_events``      - parsed upload record -> upload event (C14).
* ``to_canonical``       - fixed serving-table column set and types.

All are single ``select``/``withColumns`` projections: no shuffle, one
codegen stage, and Catalyst prunes any derived column a query never reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siglake.functions.common import first_truthy, present, truthy, truthy_number
from siglake.functions.payload import bind_payload_fields
from siglake.functions.severity import connector_severity, lake_severity
from siglake.functions.timeparse import event_date, parse_event_time, resolve_event_time
from siglake.schemas import (CANONICAL_EVENT, CONNECTOR_DEFAULT_NODE, CONNECTOR_DEFAULT_REGION, ID_CANDIDATES,
                             PAYLOAD_BINDINGS, TIMESTAMP_CANDIDATES)


def clean_events(df: DataFrame, fallback_time: Column | None = None,
                 bindings: dict[str, list[str]] | None = None) -> DataFrame:
    """Add severity_clean, event_timestamp, event_date and payload-bound columns.

    Raw columns are kept. ``fallback_time`` replaces ``current_timestamp()``
    when the frame has no timestamp column (pass the file modification time
    so a replay reproduces the same stamps).
    """
    sev = lake_severity("severity") if "severity" in df.columns else F.lit("INFO")
    ts = resolve_event_time(df, fallback_time)
    out = df.withColumns({"severity_clean": sev, "event_timestamp": ts})
    out = out.withColumn("event_date", event_date("event_timestamp"))
    return bind_payload_fields(out, PAYLOAD_BINDINGS if bindings is None else bindings)


# Connector candidate fields, in rule order.
CONNECTOR_ID_FIELDS = ["alarm_id", "ticket_id", "event_id", "metric_id"]
CONNECTOR_SEVERITY_FIELDS = ["severity", "threat_level", "priority"]
CONNECTOR_NODE_FIELDS = ["tower_id", "device_id", "target_device", "site_id"]
CONNECTOR_TYPE_FIELDS = ["alarm_type", "category", "event_type"]
CONNECTOR_TIME_FIELDS = ["timestamp", "created_at"]


def _typed_time_candidates(df: DataFrame, names: list[str]) -> list[Column] | None:
    """Typed timestamp candidates, or None if any candidate is not a time type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for n in names:
        dt = types[n]
        if not isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return None
        out.append(parse_event_time(F.col(n), dt))
    return out


def connector_normalize(df: DataFrame, category: str, now: Column | None = None) -> DataFrame:
    """REST record of any shape -> the 8 unified keys plus ``topic``.

    ``payload`` is the whole raw record as JSON text, keys without a value
    included. The id fallback is ``EXT-<CAT>-<sha256(payload)>`` rather than a
    wall-clock stamp, so a replayed poll yields the same id and de-duplicates.
    """
    from siglake.schemas import CONNECTOR_TOPICS

    cols = df.columns
    payload = F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"})
    cat_up = category.upper()
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    ids = [truthy_number(c) if c in numeric else c for c in present(cols, CONNECTOR_ID_FIELDS)]
    fallback_id = F.concat(F.lit(f"EXT-{cat_up}-"), F.sha2(payload, 256))
    event_id = first_truthy(*ids, default=fallback_id)
    sev_cols = present(cols, CONNECTOR_SEVERITY_FIELDS)
    severity = connector_severity(*sev_cols) if sev_cols else F.lit("INFO")
    node_id = first_truthy(*present(cols, CONNECTOR_NODE_FIELDS),
                           default=CONNECTOR_DEFAULT_NODE)
    region = first_truthy(*present(cols, ["region"]), default=CONNECTOR_DEFAULT_REGION)
    event_type = first_truthy(*present(cols, CONNECTOR_TYPE_FIELDS),
                              default=f"REST_{category}")
    now_col = now if now is not None else F.current_timestamp()
    ts_names = present(cols, CONNECTOR_TIME_FIELDS)
    typed = _typed_time_candidates(df, ts_names) if ts_names else None
    if typed is not None:
        timestamp = F.coalesce(*typed, now_col)
    else:
        timestamp = first_truthy(*ts_names, default=now_col.cast("string")) if ts_names \
            else now_col.cast("string")
    return df.select(
        event_id.alias("event_id"),
        F.lit(f"REST_{cat_up}").alias("source"),
        event_type.alias("event_type"),
        timestamp.alias("timestamp"),
        severity.alias("severity"),
        node_id.alias("node_id"),
        region.alias("region"),
        payload.alias("payload"),
        F.lit(CONNECTOR_TOPICS.get(category, category)).alias("topic"),
    )


def connector_normalize_json(df: DataFrame, record_col: str, category: Column,
                             fallback_time: Column | None = None) -> DataFrame:
    """C10-C12 on records held as JSON text (exploded REST envelopes).

    The record is parsed once into ``map<string,string>``; each unified key
    is the first non-empty candidate field, with the connector's defaults.
    ``category`` is a column (e.g. the envelope's target system).
    """
    from siglake.functions.payload import JSON_MAP

    rec = F.col(record_col)
    m = F.col("__rec_map")

    def look(names):
        return F.coalesce(*[F.when(F.try_element_at(m, F.lit(n)) != F.lit(""),
                                   F.try_element_at(m, F.lit(n))) for n in names])

    cat_up = F.upper(category)
    fallback_id = F.concat(F.lit("EXT-"), cat_up, F.lit("-"), F.sha2(rec, 256))
    sev = connector_severity(*[F.try_element_at(m, F.lit(n)) for n in CONNECTOR_SEVERITY_FIELDS])
    when = fallback_time if fallback_time is not None else F.current_timestamp()
    return df.withColumn("__rec_map", F.from_json(rec, JSON_MAP)).select(
        F.coalesce(look(CONNECTOR_ID_FIELDS), fallback_id).alias("event_id"),
        F.concat(F.lit("REST_"), cat_up).alias("source"),
        F.coalesce(look(CONNECTOR_TYPE_FIELDS), F.concat(F.lit("REST_"), category)).alias("event_type"),
        F.coalesce(look(CONNECTOR_TIME_FIELDS), when.cast("string")).alias("timestamp"),
        sev.alias("severity"),
        F.coalesce(look(CONNECTOR_NODE_FIELDS), F.lit(CONNECTOR_DEFAULT_NODE)).alias("node_id"),
        F.coalesce(look(["region"]), F.lit(CONNECTOR_DEFAULT_REGION)).alias("region"),
        rec.alias("payload"),
    )


def upload_events(records: DataFrame, file_type: Column, sha256: Column, uploaded_at: Column,
                  filename: Column, row_idx: Column, record_cols: list[str],
                  path: Column | None = None) -> DataFrame:
    """C14: one upload event per parsed record.

    The id is ``UPLOAD-<digest>-<idx>``: the digest of the file's content and
    path, whole, and the record's index, so two uploads with equal bytes keep
    the records of both. ``path`` defaults to the file name.
    """
    whole = F.sha2(F.concat_ws("\n", sha256, filename if path is None else path), 256)
    return records.select(
        F.concat(F.lit("UPLOAD-"), whole, F.lit("-"), row_idx.cast("string")).alias("event_id"),
        F.concat(F.lit("UPLOAD_"), F.upper(file_type)).alias("source"),
        uploaded_at.alias("timestamp"),
        F.lit("INFO").alias("severity"),
        filename.alias("filename"),
        F.to_json(F.struct(*[F.col(c) for c in record_cols])).alias("payload"),
    )


def to_canonical(df: DataFrame, category: Column | str | None = None,
                 ingest_file: Column | str | None = None) -> DataFrame:
    """Project onto the canonical serving schema (missing columns become NULL)."""
    def lit_or_col(v, name):
        if v is None:
            return F.col(name) if name in df.columns else F.lit(None).cast("string")
        return v if isinstance(v, Column) else F.lit(v)

    types = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in CANONICAL_EVENT.fields:
        if f.name == "category":
            c = lit_or_col(category, "category")
        elif f.name == "ingest_file":
            c = lit_or_col(ingest_file, "ingest_file")
        elif f.name in types:
            dt = types[f.name]
            if f.name == "payload" and isinstance(dt, (T.StructType, T.MapType, T.ArrayType)):
                c = F.to_json(F.col(f.name))
            else:
                c = F.col(f.name)
        else:
            c = F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def resolve_lenient(df: DataFrame) -> DataFrame:
    """Fields outside the unified eight (map column ``extra``) take their place.

    Per row: the id is the first non-empty of event, alarm, ticket and metric
    id; the time the first of the time fields that is there; the fields
    themselves join the payload object, whose own keys win.
    """
    extra = F.col("extra")
    ids = [F.try_element_at(extra, F.lit(c)) for c in ID_CANDIDATES if c != "event_id"]
    times = [F.try_element_at(extra, F.lit(c)) for c in TIMESTAMP_CANDIDATES if c != "timestamp"]
    own = F.coalesce(F.json_object_keys("payload"), F.array().cast("array<string>"))
    more = F.map_filter(extra, lambda k, v: ~F.array_contains(own, k))
    inside = F.regexp_replace(F.to_json(more), r"\}$", "")
    rest = F.regexp_replace("payload", r"^\s*\{", "")
    empty = F.col("payload").isNull() | F.col("payload").rlike(r"^\s*(\{\s*\}\s*)?$")
    merged = (F.when(empty, F.to_json(more))
              .when(F.json_object_keys("payload").isNotNull(), F.concat(inside, F.lit(","), rest))
              .otherwise(F.col("payload")))
    return df.withColumns({
        "event_id": first_truthy("event_id", *ids),
        "timestamp": F.coalesce("timestamp", *times),
        "payload": F.when(F.coalesce(F.size(more), F.lit(0)) > 0, merged).otherwise(F.col("payload")),
    }).drop("extra")


def apply_event_defaults(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Severity INFO, timestamp now, payload {} when absent; region stays NULL."""
    now_col = now if now is not None else F.current_timestamp()
    out = {}
    if "severity" in df.columns:
        out["severity"] = F.coalesce(F.col("severity"), F.lit("INFO"))
    if "timestamp" in df.columns:
        dt = df.schema["timestamp"].dataType
        fill = now_col if not isinstance(dt, T.StringType) else now_col.cast("string")
        out["timestamp"] = F.coalesce(F.col("timestamp"), fill)
    if "payload" in df.columns and isinstance(df.schema["payload"].dataType, T.StringType):
        out["payload"] = F.coalesce(truthy("payload"), F.lit("{}"))
    return df.withColumns(out) if out else df

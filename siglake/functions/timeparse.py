"""Event time resolution (C3), event date (C4) and hour buckets.

The event time is chosen per row: the first of ``timestamp, created_at,
event_time, time`` that exists in the schema and is not NULL. Strings are parsed with ``try_to_timestamp`` so an
unparseable value becomes NULL instead of failing the batch under ANSI mode.
A row without any takes the caller's fallback (the file's modification time or
the ingest time). ``current_timestamp()`` is used only if the frame has no
candidate column and the caller gives no fallback, because a replay would
otherwise restamp old events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siglake.schemas import TIMESTAMP_CANDIDATES


def parse_event_time(col: Column, dtype: T.DataType) -> Column:
    """Turn a column of any supported type into a TIMESTAMP (instant)."""
    if isinstance(dtype, T.TimestampType):
        return col
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return col.cast("timestamp")
    if isinstance(dtype, (T.LongType, T.IntegerType, T.DoubleType, T.FloatType, T.DecimalType)):
        return F.timestamp_seconds(col)
    return F.try_to_timestamp(col.cast("string"))


def resolve_event_time(df: DataFrame, fallback: Column | None = None) -> Column:
    """event_timestamp expression for ``df``."""
    names = {f.name: f.dataType for f in df.schema.fields}
    found = [(F.col(c), parse_event_time(F.col(c), names[c])) for c in TIMESTAMP_CANDIDATES if c in names]
    if not found:
        return fallback if fallback is not None else F.current_timestamp()
    if len(found) == 1 and fallback is None:
        return found[0][1]
    out = None
    for raw, parsed in found:
        out = F.when(raw.isNotNull(), parsed) if out is None else out.when(raw.isNotNull(), parsed)
    return out if fallback is None else out.otherwise(fallback)


def event_date(ts) -> Column:
    """C4: ``yyyy-MM-dd`` string in the session zone (UTC); NULL stays NULL."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(col, "yyyy-MM-dd")


def hour_bucket(ts) -> Column:
    """Start of the hour, as a TIMESTAMP."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.date_trunc("hour", col)


def wall_clock(ts) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ (session-zone wall time) for zone-free output."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return col.cast("timestamp_ntz")

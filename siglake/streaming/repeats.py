"""Redelivered rows dropped before they are stored (F2), from keyed state with a time to live.

A repeat is a row that equals an earlier one in all unified columns, its id
included; a newer version of an event differs and is kept for the fold on
reading. The watermark runs on arrival, not on event time: no row is ever too late
for it, however old its event, so none is dropped for its age and there are no
late rows to set aside. State holds one digest for each row that arrived within
the delay. Rows without an ``event_id`` are events of their own and all stay.

Keys are digests of content, so versions of one id spread over all tasks, and
equal rows are reduced to one in each Arrow batch before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siglake.schemas import UNIFIED_EVENT

_KEY = "__row_digest"
_ARRIVED = "__arrived"


def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each key of an Arrow batch, in order."""
    for b in batches:
        keys = pa.table({"key": b.column(_KEY), "at": np.arange(b.num_rows)})
        first = keys.group_by("key").aggregate([("at", "min")])["at_min"].to_numpy()
        yield b.take(pa.array(np.sort(first)))


def drop_repeats(events: DataFrame, within: str) -> DataFrame:
    """A stream of unified events without rows that arrived equal within the delay before (for example "2 days")."""
    same = F.sha2(F.to_json(F.struct(*[c for c in UNIFIED_EVENT.fieldNames() if c in events.columns])), 256)
    has_id = F.coalesce(F.trim("event_id"), F.lit("")) != ""
    keyed = events.withColumn(_KEY, F.when(has_id, same).otherwise(F.expr("uuid()")))
    return (keyed.mapInArrow(_first_of_each, keyed.schema)
            .withColumn(_ARRIVED, F.current_timestamp()).withWatermark(_ARRIVED, within)
            .dropDuplicatesWithinWatermark([_KEY]).drop(_KEY, _ARRIVED))

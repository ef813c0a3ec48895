"""Flattening and fan-in."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fan_in(frames: list[DataFrame]) -> DataFrame:
    """union by column name; a column missing from one input becomes NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def page_records(page_json) -> F.Column:
    """records of one REST page (JSON text) as an array of JSON strings.

    list -> its elements; object -> the first non-empty of ``result``,
    ``data``, ``items``; else the page itself as the single record. A
    ``result`` object (not a list) is one record.
    """
    p = F.col(page_json) if isinstance(page_json, str) else page_json
    as_list = F.from_json(p, T.ArrayType(T.StringType()))
    is_array = p.rlike(r"^\s*\[")

    def field_records(name):
        raw = F.get_json_object(p, f"$.{name}")
        arr = F.from_json(raw, T.ArrayType(T.StringType()))
        is_arr = raw.rlike(r"^\s*\[")
        is_obj = raw.rlike(r"^\s*\{")
        records = F.when(is_arr, arr).when(is_obj, F.array(raw))
        return F.when(F.size(records) > 0, records)

    from_obj = F.coalesce(field_records("result"), field_records("data"),
                          field_records("items"), F.array(p))
    return F.when(p.isNull(), F.array().cast("array<string>")) \
        .when(is_array, F.coalesce(as_list, F.array().cast("array<string>"))) \
        .otherwise(from_obj)


def explode_envelope(df: DataFrame, data_col: str = "data", keep: list[str] | None = None) -> DataFrame:
    """A8 + F6: one row per record of a REST envelope (``data ARRAY<STRING>``).

    ``posexplode`` keeps each record's position, which is the stable record
    index within the envelope. Empty or NULL arrays give no rows.
    """
    keep = [c for c in (keep if keep is not None else df.columns) if c != data_col]
    return df.select(*keep, F.posexplode(data_col).alias("record_idx", "record"))


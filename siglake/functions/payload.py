"""Attribute extraction from the nested ``payload``.

The payload may arrive as raw JSON text (the canonical form), a struct (when
a reader inferred it) or a map. The branch is chosen from the schema at plan
time; the per-row work is a built-in expression.

JSON text is parsed ONCE per row into ``map<string,string>`` (nested objects
keep their JSON text, numbers their literal text, bad JSON gives NULL - the
same answers as one ``get_json_object`` per candidate key, but one parse
instead of up to seventeen).

Deviation (documented, tested): for a struct payload every candidate present
in the struct is coalesced, so a frame mixing ``vendor`` and ``vendorName``
rows keeps both instead of only the first field name found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siglake.schemas import PAYLOAD_BINDINGS

JSON_MAP = T.MapType(T.StringType(), T.StringType())
_MAP_COL = "__payload_map"


def _leaf_as_string(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.StructType, T.MapType, T.ArrayType)):
        return F.to_json(c)
    return c.cast("string")


def _map_lookup(m: Column, candidates: list[str], non_empty: bool = False) -> Column:
    exprs = [F.try_element_at(m, F.lit(c)) for c in candidates]
    if non_empty:
        exprs = [F.when(e != F.lit(""), e) for e in exprs]
    return F.coalesce(*exprs) if len(exprs) > 1 else exprs[0]


def payload_field(df: DataFrame, candidates: list[str], payload_col: str = "payload",
                  non_empty: bool = False) -> Column:
    """Expression for the first non-NULL candidate key inside the payload
    (first non-empty with ``non_empty``).

    The expression references the payload column exactly once, so Catalyst
    can inline it into a consumer and evaluate it only where it is needed
    (e.g. in the ELSE branch of a CASE).
    """
    if payload_col not in df.columns:
        return F.lit(None).cast("string")
    dtype = df.schema[payload_col].dataType
    p = F.col(payload_col)
    if isinstance(dtype, T.StringType):
        parsed = F.array(F.from_json(p, JSON_MAP))
        return F.element_at(F.transform(parsed, lambda m: _map_lookup(m, candidates, non_empty)), 1)
    if isinstance(dtype, T.StructType):
        fields = {f.name: f.dataType for f in dtype.fields}
        exprs = [_leaf_as_string(p.getField(c), fields[c]) for c in candidates if c in fields]
    elif isinstance(dtype, T.MapType):
        # A missing map key is NULL.
        exprs = [F.try_element_at(p, F.lit(c)).cast("string") for c in candidates]
    else:
        return F.lit(None).cast("string")
    if not exprs:
        return F.lit(None).cast("string")
    if non_empty:
        exprs = [F.when(e != F.lit(""), e) for e in exprs]
    return (F.coalesce(*exprs) if len(exprs) > 1 else exprs[0]).cast("string")


def bind_payload_fields(df: DataFrame, bindings: dict[str, list[str]] | None = None,
                        payload_col: str = "payload") -> DataFrame:
    """Add each target column unless it already exists at top level.

    For JSON text the payload is parsed once into a helper map column shared
    by every target; columns nobody reads are pruned by Catalyst, and with
    them the parse.
    """
    bindings = PAYLOAD_BINDINGS if bindings is None else bindings
    targets = {t: c for t, c in bindings.items() if t not in df.columns}
    if not targets:
        return df
    if payload_col in df.columns and isinstance(df.schema[payload_col].dataType, T.StringType):
        parsed = df.withColumn(_MAP_COL, F.from_json(F.col(payload_col), JSON_MAP))
        m = F.col(_MAP_COL)
        return parsed.withColumns({t: _map_lookup(m, c) for t, c in targets.items()}).drop(_MAP_COL)
    return df.withColumns({t: payload_field(df, c, payload_col) for t, c in targets.items()})

"""De-duplication (F1, F3; the streaming form F2 lives in ``siglake.streaming``).

Batch rule: per id keep the newest row (largest event time), ties broken by
the remaining columns so the result never depends on task order.

Plan shape: one pass, ``groupBy(id).agg(max(struct(order..., rest...)))``. The
max is computed partially in every map task before the shuffle, so an id that
holds a third of all rows is reduced to one row per task. When only the order
column itself is wanted the maximum is a plain value and Spark uses a hash
aggregate; a struct maximum needs a sort aggregate, with a sort on either side of
the shuffle, as a ``row_number() = 1`` window with its group limits would.

The id is chosen per row (F3): the first non-empty of the id columns present (an
explicit ``key`` expression may replace the candidates). Rows with no id at all
are kept as they are - the platform's ``dropDuplicates`` collapsed them into one
row - by grouping each under a number of its own in the same pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siglake.functions.common import first_non_empty, first_truthy, present
from siglake.functions.payload import payload_field
from siglake.schemas import ID_CANDIDATES, PAYLOAD_BINDINGS

_KEY = "__dedup_key"
_ROW = "__dedup_row"
_WIN = "__dedup_winner"


def dedup_key(df: DataFrame, candidates: list[str] | None = None) -> Column:
    """The per-row id: first non-empty of the candidate columns present."""
    cols = present(df.columns, ID_CANDIDATES if candidates is None else candidates)
    if not cols:
        return F.lit(None).cast("string")
    return first_truthy(*cols)


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, (T.MapType, T.VariantType)):
        return False
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    return True


def _newest(df: DataFrame, keys: list[Column], cols: list[str], order: list[str]) -> DataFrame:
    """Newest row per key: partial + final max over (order..., rest...)."""
    rest = [c for c in cols if c not in order]
    types = {f.name: f.dataType for f in df.schema.fields}
    named = [k.alias(f"__k{i}") for i, k in enumerate(keys)]
    if cols == order and len(cols) == 1:            # a plain maximum: hash aggregate, no sort
        return df.groupBy(*named).agg(F.max(cols[0]).alias(cols[0])).select(cols[0])
    if all(_orderable(types[c]) for c in cols):
        agg = F.max(F.struct(*[F.col(c) for c in order + rest]))
    else:
        ordered = [c for c in order + rest if _orderable(types[c])]
        agg = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(c) for c in ordered]))
    return (df.groupBy(*named).agg(agg.alias(_WIN))
            .select(*[F.col(f"{_WIN}.{c}").alias(c) for c in cols]))


def dedup_latest(df: DataFrame, key: Column | str | None = None,
                 order_by: list[str] | tuple[str, ...] = ("event_timestamp",),
                 id_candidates: list[str] | None = None,
                 keep_null_keys: bool = True,
                 columns: list[str] | None = None,
                 within: list[str] | None = None) -> DataFrame:
    """Keep the newest row per id; rows without any id are kept.

    ``key``: an explicit key column/expression (one branch) instead of the
    id candidates. ``columns``: the output columns (default: all) - only
    these travel through the shuffle and break ties. ``within``: extra
    grouping columns (e.g. ``category`` when several tables are built in one
    pass).
    """
    cols = columns or df.columns
    order = [c for c in order_by if c in cols]
    extra = [F.col(c) for c in (within or [])]
    if key is None:
        k = dedup_key(df, id_candidates)
    else:
        k = F.col(key) if isinstance(key, str) else key
    keyed = df.withColumn(_KEY, k)
    keys = [*extra, F.col(_KEY)]
    if keep_null_keys:
        # a row without an id is a group of its own
        keyed = keyed.withColumn(_ROW, F.when(F.col(_KEY).isNull(), F.monotonically_increasing_id()))
        keys.append(F.col(_ROW))
    else:
        keyed = keyed.where(F.col(_KEY).isNotNull())
    return _newest(keyed, keys, cols, order)


DEDUP_KEYS = ["event_id", "ticket_id"]
_EVENT_KEY = "__event_key"
# Fixed tie-break among rows with the same id and event time: these columns,
# in this order (largest wins). Every other canonical column is either a
# function of them or of the payload, so the winner - and every panel built
# from it - is the same whichever columns a query keeps. The payload itself
# joins the order only when a payload-derived column is requested.
TIE_BREAK = ["source", "event_type", "severity", "node_id", "region", "filename", "ingest_file"]
PAYLOAD_DERIVED = {"payload", "vendor", "site_name", "device_name", "ticket_id"}


def event_key(canon: DataFrame) -> Column:
    """F3 key of a canonical row: event_id, else the payload's ticket id.

    The payload lookup is one self-contained expression in the ELSE branch
    of a CASE, so it is only evaluated for rows whose event_id is empty.
    """
    return first_non_empty("event_id", payload_field(canon, PAYLOAD_BINDINGS["ticket_id"], non_empty=True))


def newest_events(canon: DataFrame, columns: list[str] | None = None, within: list[str] | None = None) -> DataFrame:
    """The newest row of each event of a canonical frame; batch, stream and readers share this rule.

    ``columns`` restricts the result, and therefore what the shuffle carries,
    to what a caller reads plus the tie-break columns.
    """
    wanted = list(canon.columns) if columns is None else list(columns)
    keyed = canon.withColumn(_EVENT_KEY, event_key(canon))
    if wanted == ["event_timestamp"]:                # equal times need no tie-break
        return dedup_latest(keyed, key=_EVENT_KEY, columns=wanted, within=within)
    order = ["event_timestamp"] + TIE_BREAK
    if PAYLOAD_DERIVED & set(wanted):
        order.append("payload")
    keep = order + [c for c in wanted if c not in order]
    return dedup_latest(keyed, key=_EVENT_KEY, columns=keep, within=within).select(*wanted)

"""Validation, quarantine and bounded record selection.

D1: a message is *strict* when it satisfies the unified-event contract
(required ids, source and severity domains, parseable timestamp, object
payload). A non-strict message is still accepted raw (*lenient*) when it
carries both ``source`` and ``node_id``; otherwise it is rejected.
D2: rejected rows go to a quarantine frame with the reasons, not to /dev/null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siglake.schemas import SEVERITY_LEVELS, SOURCE_DOMAIN

REQUIRED = ["event_id", "source", "event_type", "node_id"]


def _str(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(None).cast("string")
    return F.col(name).cast("string")


def _checks(df: DataFrame) -> list[tuple[Column, str]]:
    """(failure condition, reason) pairs, cheapest first."""
    checks = [(_str(df, name).isNull(), f"missing {name}") for name in REQUIRED]
    src = _str(df, "source")
    checks.append((src.isNotNull() & ~src.isin(*SOURCE_DOMAIN), "source not in domain"))
    sev = _str(df, "severity")
    checks.append((sev.isNotNull() & ~sev.isin(*SEVERITY_LEVELS), "severity not in domain"))
    if "timestamp" in df.columns and isinstance(df.schema["timestamp"].dataType, T.StringType):
        ts = F.col("timestamp")
        checks.append((ts.isNotNull() & F.try_to_timestamp(ts).isNull(), "unparseable timestamp"))
    if "payload" in df.columns and isinstance(df.schema["payload"].dataType, T.StringType):
        p = F.col("payload")
        checks.append((p.isNotNull() & F.json_object_keys(p).isNull(), "payload not an object"))
    return checks


def violations(df: DataFrame) -> Column:
    """Array of contract violations for each row (empty when strict)."""
    return F.filter(F.array(*[F.when(c, F.lit(r)) for c, r in _checks(df)]), lambda x: x.isNotNull())


def validate_events(df: DataFrame) -> DataFrame:
    """Add ``is_strict``, ``is_lenient``, ``accepted`` and ``reject_reason``.

    ``is_strict`` is a conjunction evaluated left to right with the cheap
    null/domain tests first, so the JSON check on the payload only runs for
    rows that passed everything else; the reason list is built only for
    rejected rows.
    """
    strict = None
    for cond, _ in _checks(df):
        ok = F.coalesce(~cond, F.lit(False))
        strict = ok if strict is None else (strict & ok)
    lenient = _str(df, "source").isNotNull() & _str(df, "node_id").isNotNull()
    out = df.withColumns({"is_strict": strict, "is_lenient": lenient})
    out = out.withColumn("accepted", F.col("is_lenient") | F.col("is_strict"))
    return out.withColumn(
        "reject_reason",
        F.when(~F.col("accepted"), F.array_join(violations(df), "; ")))


def accepted(df: DataFrame) -> DataFrame:
    """Rows that pass D1 (strict or lenient).

    Strict rows always carry ``source`` and ``node_id``, so "strict or
    lenient" is exactly the lenient test: a plain null check that Parquet can
    push down, with no per-row contract evaluation (no JSON parsing).
    """
    return df.where(_str(df, "source").isNotNull() & _str(df, "node_id").isNotNull())


def quarantine(df: DataFrame) -> DataFrame:
    """Rejected rows with their reasons (the complement of ``accepted``)."""
    rejected = df.where(_str(df, "source").isNull() | _str(df, "node_id").isNull())
    return (validate_events(rejected).where(~F.col("accepted"))
            .drop("is_strict", "is_lenient", "accepted"))


DEFAULT_CAP_SALTS = 256


def cap_per_group(df: DataFrame, group_cols: list[str], order_col: str, k: int,
                  dense_index: bool = False, salts: int = DEFAULT_CAP_SALTS) -> DataFrame:
    """At most ``k`` rows per group, the first ``k`` in ``order_col`` order.

    When ``order_col`` is already a dense 0-based position inside the group
    (``posexplode`` output, a parsed row number) the cap is a plain filter:
    no shuffle, no sort, and a huge group costs nothing extra.

    Otherwise a two-phase top-k keeps a hot group off a single task: rows
    are first ranked inside ``(group, salt)`` sub-groups, where the salt is a
    hash of the row, and only each sub-group's first ``k`` survive; the final
    rank then runs over at most ``k * salts`` candidates per group. Ties in
    ``order_col`` are broken by the row hash so the result is deterministic.
    """
    if dense_index:
        return df.where(F.col(order_col) < F.lit(k))
    cols = df.columns
    hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    h = F.xxhash64(*[F.col(c) for c in hashable])
    staged = df.withColumns({"__h": h, "__salt": F.pmod(h, F.lit(salts))})
    order = [F.col(order_col).asc_nulls_last(), F.col("__h").asc()]
    w1 = Window.partitionBy(*group_cols, "__salt").orderBy(*order)
    cand = staged.withColumn("__rn", F.row_number().over(w1)).where(F.col("__rn") <= F.lit(k))
    w2 = Window.partitionBy(*group_cols).orderBy(*order)
    return (cand.withColumn("__rn", F.row_number().over(w2))
            .where(F.col("__rn") <= F.lit(k)).select(*cols))


def lookup_by_id(df: DataFrame, id_col: str, value) -> DataFrame:
    """Point lookup; an empty result is the 'not found' answer."""
    return df.where(F.col(id_col) == F.lit(value))

"""Category routing.

Order: an explicit category; then the topic; then substring rules on the
lower-cased event_type, source and event_id; else the readable ``unrouted``
category (the platform dropped these into a folder nobody read). Singular
connector categories ("alarm", "ticket") map to their plural landing names.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siglake.schemas import TOPIC_CATEGORIES, UNROUTED_CATEGORY

# Explicit-category aliases.
CATEGORY_ALIASES = {"alarm": "alarms", "ticket": "tickets"}

# Fixed values: (category, [(field, substring), ...]) in rule order.
ROUTING_RULES = [
    ("alarms", [("event_type", "alarm"), ("source", "alarm")]),
    ("tickets", [("event_type", "ticket"), ("source", "ticket"), ("event_id", "inc")]),
    ("network", [("event_type", "net"), ("source", "network"), ("event_type", "cell")]),
    ("security", [("event_type", "sec"), ("source", "security"), ("event_type", "threat")]),
    ("performance", [("event_type", "prf"), ("source", "perf"), ("event_type", "metric")]),
]


def _c(x):
    if x is None:
        return F.lit(None).cast("string")
    return F.col(x) if isinstance(x, str) else x


def category_route(topic=None, event_type="event_type", source="source",
                   event_id="event_id", explicit=None) -> Column:
    """Landing category for each row."""
    fields = {
        "event_type": F.lower(F.coalesce(_c(event_type).cast("string"), F.lit(""))),
        "source": F.lower(F.coalesce(_c(source).cast("string"), F.lit(""))),
        "event_id": F.lower(F.coalesce(_c(event_id).cast("string"), F.lit(""))),
    }
    expr = None

    def add(cond, value):
        nonlocal expr
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)

    if explicit is not None:
        ex = F.nullif(F.lower(_c(explicit)), F.lit(""))
        ex = F.regexp_replace(ex, r"^kafka/", "")
        alias_map = F.create_map(*[F.lit(x) for kv in CATEGORY_ALIASES.items() for x in kv])
        add(ex.isNotNull(), F.coalesce(F.try_element_at(alias_map, ex), ex))
    if topic is not None:
        t = _c(topic)
        for tp, cat in TOPIC_CATEGORIES.items():
            add(t == F.lit(tp), F.lit(cat))
    for cat, tests in ROUTING_RULES:
        cond = None
        for field, needle in tests:
            c = fields[field].contains(needle)
            cond = c if cond is None else (cond | c)
        add(cond, F.lit(cat))
    return expr.otherwise(F.lit(UNROUTED_CATEGORY))

"""Severity normalisation.

Two distinct rules exist and are kept distinct:

* ``lake_severity`` (applied when cleaning landed files) matches short
  fragments: CRIT, MAJ, MIN, MED, WARN.
* ``connector_severity`` (applied when polling REST systems) matches whole
  words: CRITICAL, MAJOR, MINOR, MEDIUM, WARNING. "CRIT" alone is INFO here.

Both test rules in order; the first match wins. Matching is by substring,
so "administrative" contains MIN and "P10" contains P1 - kept as is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siglake.functions.common import first_truthy

# Fixed values: (level, substrings) in rule order.
LAKE_RULES = [
    ("CRITICAL", ["CRIT", "P1"]),
    ("MAJOR", ["MAJ", "HIGH", "P2"]),
    ("MINOR", ["MIN", "MED", "P3"]),
    ("WARNING", ["WARN"]),
]
CONNECTOR_RULES = [
    ("CRITICAL", ["CRITICAL", "P1"]),
    ("MAJOR", ["MAJOR", "HIGH", "P2"]),
    ("MINOR", ["MINOR", "MEDIUM", "P3"]),
    ("WARNING", ["WARNING"]),
]


def _rule_chain(upper: Column, rules) -> Column:
    expr = None
    for level, needles in rules:
        cond = None
        for n in needles:
            c = upper.contains(n)
            cond = c if cond is None else (cond | c)
        # contains() on NULL is NULL, which when() treats as false -> INFO.
        expr = F.when(cond, F.lit(level)) if expr is None else expr.when(cond, F.lit(level))
    return expr.otherwise(F.lit("INFO"))


def lake_severity(severity) -> Column:
    """severity_clean from a raw severity column (NULL -> INFO)."""
    col = F.col(severity) if isinstance(severity, str) else severity
    return _rule_chain(F.upper(col), LAKE_RULES)


def connector_severity(*cols) -> Column:
    """First truthy of the given columns (severity, threat_level, priority), else INFO."""
    raw = F.upper(first_truthy(*cols, default="INFO"))
    return _rule_chain(raw, CONNECTOR_RULES)

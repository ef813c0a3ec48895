"""Truthiness helpers.

Python's ``a or b`` skips None, "" (and 0/False); SQL ``coalesce`` skips only
NULL. Values arriving here are strings, so "truthy" means non-NULL and
non-empty.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truthy(c) -> Column:
    """NULL when the value is NULL or the empty string, else the value as string.

    A plain CASE keeps the expression inside whole-stage codegen. (For an
    expensive input that must stay lazy, see ``first_non_empty``.)
    """
    s = _col(c).cast("string")
    return F.when(s != F.lit(""), s)


def truthy_number(c) -> Column:
    """The number as a string, NULL for 0 (``0 or b`` is ``b``)."""
    return F.when(_col(c) != 0, _col(c).cast("string"))


def first_truthy(*cols, default=None) -> Column:
    """First non-NULL, non-empty value among ``cols``; ``default`` otherwise."""
    parts = [truthy(c) for c in cols]
    if default is not None:
        parts.append(default if isinstance(default, Column) else F.lit(default))
    return F.coalesce(*parts) if len(parts) > 1 else parts[0]


def first_non_empty(primary, fallback: Column) -> Column:
    """``primary`` when non-empty, else ``fallback`` - evaluated lazily.

    The fallback sits in the ELSE branch of a CASE, which generated code only
    enters for rows that need it, so an expensive fallback (a payload lookup)
    costs nothing for rows whose primary value is present.
    """
    p = _col(primary).cast("string")
    return F.when(p != F.lit(""), p).otherwise(fallback)


def present(df_columns, candidates) -> list[str]:
    """Candidates that exist in the frame, in candidate order."""
    cols = set(df_columns)
    return [c for c in candidates if c in cols]

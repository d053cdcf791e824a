"""Text helpers built from native functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import OTHER_CATEGORY


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c) -> Column:
    """NULL or empty string."""
    c = _as_col(c)
    return c.isNull() | (c == "")


def digits_only(c) -> Column:
    return F.regexp_replace(_as_col(c), "[^0-9]", "")


def contains_any(c, needles) -> Column:
    """TRUE when ``c`` contains one of ``needles`` (NULL for NULL input)."""
    c = _as_col(c)
    out = None
    for n in needles:
        t = c.contains(n)
        out = t if out is None else (out | t)
    return out if out is not None else F.lit(False)


def occupation_category(c, categories) -> Column:
    """First category (in the given order) one of whose keywords occurs in the
    text, case-insensitively; blank text and no match give the 'Other' category.
    A CASE chain, so evaluation short-circuits in the same order."""
    up = F.upper(_as_col(c))
    expr = F.when(is_blank(c), F.lit(OTHER_CATEGORY))
    for category, keywords in categories:
        if category == OTHER_CATEGORY or not keywords:
            continue
        expr = expr.when(contains_any(up, [k.upper() for k in keywords]), F.lit(category))
    return expr.otherwise(F.lit(OTHER_CATEGORY))


def postal_prefix(c) -> Column:
    """Two leading digits of a code that starts with at least two digits."""
    c = _as_col(c)
    return F.when(c.isNotNull() & c.rlike(r"^\d{2,}"), F.regexp_extract(c, r"^(\d{2})", 1))

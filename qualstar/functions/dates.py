"""Date handling as native Column expressions (no Python UDF).

The flexible reader accepts, in this order: ``Y-M-D``, ``D/M/Y``, ``M-D-Y``,
``Y-M-DTh:m:s`` and ``Y-M-DTh:m:s.f`` (1-6 fraction digits), with a
four-digit year and one- or two-digit month, day and time fields.  Each
format is gated by a shape regex first, so the Spark cast cannot read more
than the format allows (three-digit months, signed years).  Leading and
trailing whitespace is ignored, whole placeholder values give NULL.

Parsed values are wall-clock timestamps (``TIMESTAMP_NTZ``) and day counts
are floors of the exact wall-clock difference, like ``timedelta.days`` on
naive datetimes, so a daylight-saving switch in the session time zone cannot
shift a count by an hour.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

MICROS_PER_DAY = 86_400 * 1_000_000

# White space of any kind around a value; the patterns below are anchored at
# both ends, so a value is matched in one pass and not stripped first.
_WS = r"[\s\x1c-\x1f]*"
_ISO = r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?:T[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}(?:\.[0-9]{1,6})?)?"
_PLAIN_ISO = rf"^{_ISO}\z"
_PLAIN_STRICT_ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
_STRICT_ISO = rf"(?U)^{_WS}[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}{_WS}\z"
# (shape regex, its parts in the order that Spark's cast reads); no value fits two.
# ISO is last, as without white space it is matched before.
_FLEXIBLE_FORMATS = [
    (rf"(?U)^{_WS}([0-9]{{1,2}})/([0-9]{{1,2}})/([0-9]{{4}}){_WS}\z", "$3-$2-$1"),
    (rf"(?U)^{_WS}([0-9]{{1,2}})-([0-9]{{1,2}})-([0-9]{{4}}){_WS}\z", "$3-$1-$2"),
    (rf"(?U)^{_WS}({_ISO}){_WS}\z", "$1"),
]


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Remove leading/trailing whitespace of any kind (``trim`` only removes spaces)."""
    return F.regexp_replace(_as_col(c), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def parse_flexible(c) -> Column:
    """Text -> timestamp using the five accepted layouts; NULL when none fits.

    Values of the commonest layouts are cast as they are; the others have their
    parts put in order first.  Placeholders have none of the shapes."""
    c = _as_col(c)
    ordered = F.when(c.rlike(_PLAIN_ISO), c)
    for shape, parts in _FLEXIBLE_FORMATS:
        ordered = ordered.when(c.rlike(shape), F.regexp_replace(c, shape, parts))
    parsed = ordered.try_cast("timestamp_ntz")
    # Year 0 parses in Spark but is not a calendar year.
    return F.when(parsed >= F.lit("0001-01-01").cast("timestamp_ntz"), parsed)


def is_strict_iso_date(c, parsed: Column | None = None) -> Column:
    """TRUE for exactly ``YYYY-MM-DD`` naming a real calendar day, else FALSE
    (never NULL).  ``parsed`` is ``parse_flexible(c)`` where that is at hand."""
    c = _as_col(c)
    parsed = parse_flexible(c) if parsed is None else parsed
    return F.coalesce((c.rlike(_PLAIN_STRICT_ISO) | c.rlike(_STRICT_ISO)) & parsed.isNotNull(), F.lit(False))


def can_canonicalise(c) -> Column:
    """TRUE when the flexible reader understands the value (never NULL)."""
    return parse_flexible(c).isNotNull()


def date_typed(df, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (DateType, TimestampType, TimestampNTZType))


def as_timestamp(df, name: str) -> Column:
    """Column ``name`` as timestamp: typed dates pass through, text is parsed."""
    if date_typed(df, name):
        return F.col(name).cast("timestamp_ntz")
    return parse_flexible(F.col(name))


def micros_between(later: Column, earlier: Column) -> Column:
    """Exact wall-clock difference in microseconds (NTZ values)."""
    return F.timestamp_diff("MICROSECOND", earlier, later)


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days from ``earlier`` to ``later``, rounded down (NULL if either is NULL)."""
    return F.floor(micros_between(later, earlier) / F.lit(MICROS_PER_DAY)).cast("long")


def days_between_within(later: Column, earlier: Column, lo_days: int, hi_days: int) -> Column:
    """``lo <= floor(days) <= hi``, by comparing wall-clock times (no difference is formed)."""
    def after(days: int) -> Column:
        return earlier + F.make_dt_interval(F.lit(days)) if days else earlier
    return (later >= after(lo_days)) & (later < after(hi_days + 1))


def days_since(c, as_of) -> Column:
    """Whole days from the parsed date ``c`` to ``as_of`` (a timestamp Column
    or ISO text), rounded down; NULL when ``c`` does not parse."""
    ref = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")
    return days_between(ref.cast("timestamp_ntz"), parse_flexible(c))


def compare_dates_ge(a, b) -> Column:
    """``parse(a) >= parse(b)``; NULL when either side does not parse."""
    return parse_flexible(a) >= parse_flexible(b)

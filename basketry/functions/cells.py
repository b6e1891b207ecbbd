"""Turning raw text cells into typed values: bad cells become null, never an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from basketry.settings import EMPTY_TEXT, NA_TOKENS

# The characters Python's ``str.strip`` removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The accepted event-time layouts, blank or T between day and time, zone optional.
EVENT_TIME_LAYOUT = (
    r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?( UTC|Z|[+-]\d{2}:\d{2})?$"
)

_ZONE = "( UTC|Z|[+-][0-9]{2}:[0-9]{2})$"
_LETTERS_BUT_E = "[a-df-zA-DF-Z]"
_LONG_LIMIT = float(2**63)


def na_to_null(cell: Column) -> Column:
    """Null for a cell that equals one of the missing-value tokens exactly."""
    return F.when(~cell.isin(*NA_TOKENS), cell)


def strip(cell: Column) -> Column:
    """Drop leading and trailing white space of any kind (``trim`` drops blanks only)."""
    return F.btrim(cell, F.lit(WHITESPACE))


def event_time(cell: Column) -> Column:
    """UTC timestamp, or null when the cell has none of the accepted layouts.

    The layout is checked first: a bare cast would turn ``10:00`` into today and ``2019``
    into January 1st. A time without a zone is UTC, whatever the session's zone is.
    """
    zoned = F.when(cell.rlike(_ZONE), cell).otherwise(F.concat(cell, F.lit(" UTC")))
    return F.when(cell.rlike(EVENT_TIME_LAYOUT), zoned.try_cast("timestamp"))


def utc_day(time: Column) -> Column:
    """UTC day of a timestamp, in any session zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(time) / 86_400).cast("int"))


def utc_hour(time: Column) -> Column:
    """UTC hour of a timestamp, 0 to 23, in any session zone."""
    return F.pmod(F.floor(F.unix_seconds(time) / 3_600), F.lit(24)).cast("int")


def number(cell: Column) -> Column:
    """Double, or null. Letters other than an exponent rule out ``1.0d``, ``inf`` and ``nan``.

    Surrounding white space is allowed; text beyond the range of a double becomes infinite.
    """
    return F.when(~cell.rlike(_LETTERS_BUT_E), cell.try_cast("double"))


def whole_number(cell: Column) -> Column:
    """Long, or null. Integer text is read exactly (19 digits survive); other numbers truncate."""
    value = number(cell)
    truncated = F.when(value < F.lit(_LONG_LIMIT), value.try_cast("long"))
    return F.coalesce(cell.try_cast("long"), truncated)


def present(text: Column) -> Column:
    """Stripped text, null where it is empty or spells out a missing value."""
    return F.when(~text.isin(*EMPTY_TEXT), text)

"""Scalar expressions shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The real payment types.
PAYMENT_TYPES = ("account", "card", "cash", "dispute", "no charge")

# Words that stand for an absent value, in lower case.
ABSENCE_MARKERS = ("", "-", "\\n", "n/a", "na", "nan", "none", "null")

_ZONE = r"^\s*(?:[Zz][Oo][Nn][Ee]-?|[Zz])?\s*0*([0-9]{1,9})(?:\.0+)?\??\s*$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zone_number(c: Column | str) -> Column:
    """Number of a zone in any spelling (93, Z93, zone-93, 0093, 93.0, ' 93', 93?); null if there is none."""
    return F.regexp_extract(col(c), _ZONE, 1).try_cast("int")


def is_plain_zone(c: Column | str) -> Column:
    """Digits only, without a leading zero."""
    return col(c).rlike("^[1-9][0-9]*$")


def real_number(c: Column | str) -> Column:
    """The value as double, with NaN turned into null."""
    d = col(c).cast("double")
    return F.when(F.isnan(d), None).otherwise(d)


def real_payment(c: Column | str) -> Column:
    """Payment type in its plain spelling, or null if the value is none of the real ones."""
    p = F.lower(F.trim(col(c)))
    return F.when(p.isin(*PAYMENT_TYPES), p)


def real_passengers(c: Column | str) -> Column:
    return F.when(col(c).between(1, 9), col(c).cast("int"))


def real_extra(c: Column | str) -> Column:
    e = real_number(c)
    return F.when(e.between(0, 10), e)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minutes from start to end as double, at microsecond precision."""
    return F.timestamp_diff("MICROSECOND", col(start), col(end)) / F.lit(6e7)


def is_absent(c: Column | str) -> Column:
    """True for null and for the markers of absence in any case."""
    return col(c).isNull() | F.lower(F.trim(col(c))).isin(*ABSENCE_MARKERS)


def value_kind(c: Column | str) -> Column:
    """integer, decimal, timestamp or text; null for absent values."""
    v = F.trim(col(c))
    return (  # no marker of absence is a number or a time, so the commonest kinds come first
        F.when(v.rlike(r"^[+-]?[0-9]+$"), "integer")
        .when(v.rlike(r"^[+-]?([0-9]+\.[0-9]*|\.[0-9]+)$"), "decimal")
        .when(v.rlike(r"^[0-9]{4}[-/][0-9]{2}[-/][0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?(Z|[+-][0-9:]{4,6})?$"), "timestamp")
        .when(~is_absent(c), "text")
    )


def plain_name(name: str) -> str:
    """Column name in lower case with spaces as underscores."""
    return name.strip().lower().replace(" ", "_")

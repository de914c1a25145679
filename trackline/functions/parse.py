"""Lenient parsing: bad text becomes NULL, never an error (ANSI mode safe)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trackline.schema import NA_TOKENS

# What counts as a number.  Plain decimal or exponent notation,
# optional sign and surrounding blanks, or the inf/nan words; anything else
# (``1.5d``, ``1,000``) is rejected before the cast.
NUMBER_PATTERN = r"^\s*[+-]?(([0-9]+\.?[0-9]*)|(\.[0-9]+))([eE][+-]?[0-9]+)?\s*$"
SPECIAL_NUMBER_PATTERN = r"^\s*[+-]?(?i)(inf|infinity|nan)\s*$"
# Accepted timestamp texts: year first (dashes or slashes) or month/day/year, then perhaps blank or T,
# a time with optional seconds and fraction, and a zone (Z or an offset from UTC).
TIMESTAMP_PATTERN = (r"^([0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})"
                     r"([ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?( ?(Z|z|UTC|[+-][0-9]{2}:?[0-9]{2}))?)?$")
ZONE_PATTERN = r"^[^:]+:.* ?(Z|z|UTC|[+-][0-9]{2}:?[0-9]{2})$"
OFFSET_PATTERN = r"^[^:]+:.*([+-])([0-9]{2}):?([0-9]{2})$"


def na_to_null(c: Column) -> Column:
    """Map the missing-value tokens to NULL (string column)."""
    return F.when(c.isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def to_double(c: Column) -> Column:
    """Text -> DOUBLE; NULL for anything that is not a number."""
    s = F.trim(c)
    ok = s.rlike(NUMBER_PATTERN) | s.rlike(SPECIAL_NUMBER_PATTERN)
    return F.when(ok, s.try_cast("double"))


def to_long_id(c: Column) -> Column:
    """Identifier text -> BIGINT, accepting ``219018671.0`` but not ``1.5``."""
    d = to_double(c)
    return F.when((d == F.floor(d)) & (F.abs(d) < F.lit(9.0e18)), d.cast("long"))


def to_timestamp_ntz(c: Column) -> Column:
    """Text -> TIMESTAMP_NTZ in UTC; NULL when it does not parse.  A text without a zone is taken as UTC."""
    s = F.trim(c)
    local = F.when(s.rlike(ZONE_PATTERN), F.regexp_replace(s, r" ?(Z|z|UTC|[+-][0-9]{2}:?[0-9]{2})$", "")).otherwise(s)
    date_first = F.regexp_replace(F.regexp_replace(local, r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})", "$3-$1-$2"), "/", "-")
    at = F.regexp_replace(date_first, "T", " ").try_cast("timestamp_ntz")
    sign = F.when(F.regexp_extract(s, OFFSET_PATTERN, 1) == "-", -1).otherwise(1)
    hours, minutes = (F.regexp_extract(s, OFFSET_PATTERN, i).cast("int") * sign for i in (2, 3))
    utc = F.when(s.rlike(OFFSET_PATTERN), at - F.make_dt_interval(hours=hours, mins=minutes)).otherwise(at)
    return F.when(s.rlike(TIMESTAMP_PATTERN), utc)

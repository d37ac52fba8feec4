"""Scalar column expressions shared by the operators.

All built from ``pyspark.sql.functions``; every one is ANSI-safe (``try_*``
casts and guarded divisions), so a bad value becomes null instead of failing
the job.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhawk import contract as K

__all__ = [
    "epoch_us", "strip_ws", "blank_to_null", "pseudonym", "pseudonym_text", "email_domain",
    "hour_of", "weekday_of", "days_between", "typology", "risk_band",
    "is_legacy_code", "safe_div", "grid_index", "lenient_timestamp",
]

US_PER_HOUR = 3_600_000_000
US_PER_DAY = 86_400_000_000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_us(c) -> Column:
    """Microseconds since the epoch for timestamp, timestamp_ntz or date
    (the session time zone is UTC)."""
    return F.unix_micros(_c(c).cast("timestamp"))


def lenient_timestamp(c) -> Column:
    """Timestamp from a timestamp/date column or an ISO-like string; bad -> null."""
    return F.coalesce(F.try_to_timestamp(_c(c).cast("string")), _c(c).cast("string").try_cast("timestamp"))


# FIXED VALUES: the characters Python's str.strip() treats as whitespace.
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
              "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
              "\u2028\u2029\u202f\u205f\u3000")


def strip_ws(c) -> Column:
    """Remove leading/trailing whitespace of every kind, as str.strip()
    does (not only spaces); a character-set trim, no regex per value."""
    return F.btrim(_c(c).cast("string"), F.lit(WHITESPACE))


def blank_to_null(c) -> Column:
    s = _c(c)
    return F.when(strip_ws(s) != "", s)


def pseudonym(c, salt: str) -> Column:
    """Salted SHA-256 pseudonym of lower(strip(str(v))): 24 hex characters;
    null or blank -> null. Deterministic across jobs and engines."""
    norm = F.nullif(F.lower(strip_ws(c)), F.lit(""))
    return F.substring(F.sha2(F.concat(F.lit(salt), norm), 256), 1, 24)


def pseudonym_text(value: str | None, salt: str) -> str | None:
    """:func:`pseudonym` of one value in Python, for checks that hash apart from the engine."""
    norm = "" if value is None else value.strip().lower()
    return hashlib.sha256(f"{salt}{norm}".encode()).hexdigest()[:24] if norm else None


def email_domain(c) -> Column:
    """Domain after the last '@', trimmed and lower-cased; local part discarded."""
    s = _c(c).cast("string")
    return F.when(s.contains("@"), F.lower(strip_ws(F.substring_index(s, "@", -1))))


def hour_of(ts) -> Column:
    return F.hour(_c(ts)).cast("bigint")


def weekday_of(ts) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(ts)).cast("bigint")


def days_between(later, earlier) -> Column:
    return (epoch_us(later) - epoch_us(earlier)) / F.lit(float(US_PER_DAY))


def safe_div(a, b) -> Column:
    return F.try_divide(_c(a), _c(b))


def typology(text) -> Column:
    """Free text -> fraud typology; first pattern wins, text without a match is
    'other', null stays null."""
    t = F.lower(_c(text).cast("string"))
    expr = F.lit("other")
    for label, pattern in reversed(K.TYPOLOGY_PATTERNS):
        expr = F.when(F.regexp_like(t, F.lit(pattern)), F.lit(label)).otherwise(expr)
    return F.when(t.isNotNull(), expr)


def risk_band(p) -> Column:
    """Advisory band for a probability: the first band whose cut it reaches;
    no band without a score (null or NaN)."""
    p = score_or_null(p)
    expr = F.lit(K.RISK_BANDS[-1][1])
    for cut, name in reversed(K.RISK_BANDS[:-1]):
        expr = F.when(p >= F.lit(cut), F.lit(name)).otherwise(expr)
    return F.when(p.isNotNull(), expr)


def is_legacy_code(c) -> Column:
    return F.coalesce(F.regexp_like(_c(c).cast("string"), F.lit(K.OBJECTID_PATTERN)), F.lit(False))


def score_or_null(score) -> Column:
    """A score as double; NaN is no score. Rows without a score take no part
    in any metric and have no band."""
    s = _c(score).cast("double")
    return F.when(~F.isnan(s), s)


def grid_index(score, steps: int = 100) -> Column:
    """Number of grid points i/steps (i = 1..steps-1) that are <= score.

    Threshold i is reached exactly when ``grid_index >= i``; computed from
    floor(score*steps) and corrected by one step against the exact double
    literals, so it never disagrees with ``score >= i/steps``. Null for a
    null or NaN score.
    """
    s = score_or_null(score)
    k = F.floor(s * steps).cast("bigint")
    k = F.when((k + 1) / F.lit(float(steps)) <= s, k + 1).otherwise(k)
    k = F.when(k / F.lit(float(steps)) > s, k - 1).otherwise(k)
    return F.when(s.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(steps - 1), k))).cast("bigint")

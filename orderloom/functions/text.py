"""Text normalisation and id formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: every character a Unicode-aware strip removes.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Drop leading and trailing whitespace of any kind; NULL stays NULL."""
    return F.btrim(c, F.lit(WHITESPACE))


def strip_lower(c: Column) -> Column:
    return F.lower(strip(c))


def strip_upper(c: Column) -> Column:
    return F.upper(strip(c))


def padded_id(prefix: str, width: int, n: Column) -> Column:
    """``prefix-0042`` style identifiers."""
    return F.format_string(f"{prefix}-%0{width}d", n)

"""Text clean-up.

``trim`` in Spark removes spaces only and Java's ``\\s`` covers ASCII only, while
exports carry tabs, no-break spaces and the like. Stripping therefore names the
whole set of white-space characters and uses ``btrim``, which looks at the two
ends of a value and needs no regular expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Unicode treats as white space in text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The same set inside a Java character class.
WHITESPACE_CLASS = r"\s\x1c-\x1f"
USUAL_STATUS = r"^[a-z]+(?:_[a-z]+)*\z"
VISIBLE = rf"(?U)[^{WHITESPACE_CLASS}]"


def stripped(text: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """True for null, empty and white-space-only text; never null."""
    return text.isNull() | ~text.rlike(VISIBLE)


def status_key(text: Column) -> Column:
    """Comparable payment status: lower case, words joined by one underscore."""
    joined = F.regexp_replace(F.lower(stripped(text)), rf"(?U)[{WHITESPACE_CLASS}\-_]+", "_")
    return F.when(text.rlike(USUAL_STATUS), text).otherwise(joined)


def campaign_label(text: Column) -> Column:
    """Campaign name with single spaces and its own letter case; blank is null."""
    single_spaced = F.regexp_replace(stripped(text), rf"(?U)[{WHITESPACE_CLASS}]+", " ")
    return F.nullif(single_spaced, F.lit(""))

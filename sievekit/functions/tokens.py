"""Column expressions over text: tokens and character counts.

Everything here returns a ``Column`` built from JVM functions, so it runs
inside whole-stage codegen and needs no Python worker."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the whitespace class used for tokens.  Spelled out rather
# than ``\s`` because the meaning of ``\s`` and ``trim`` differs between
# SQL dialects.
WHITESPACE = "[ \t\n\r]+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text, pattern: str | None = None, lowercase: bool = True) -> Column:
    """Split a string into tokens.

    Default: lower-case, split on runs of blanks, drop empty tokens.  With
    ``pattern`` the tokens are the regex matches instead (e.g. one pattern
    per SMILES atom).  Null text gives a null array."""
    s = _c(text)
    if lowercase:
        s = F.lower(s)
    if pattern is not None:
        return F.regexp_extract_all(s, F.lit(pattern), 0)
    return F.array_remove(F.split(s, WHITESPACE), "")


def char_count(text, sub: str) -> Column:
    """Non-overlapping occurrences of ``sub`` (as Python ``str.count``)."""
    s = _c(text)
    removed = F.length(s) - F.length(F.replace(s, F.lit(sub), F.lit("")))
    if len(sub) == 1:
        return removed
    return (removed / F.lit(len(sub))).cast("int")

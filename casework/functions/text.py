"""Text columns: stripping, tokens and terms.

Character classes are spelled out in ASCII so that the JVM and other regex engines agree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
BLANKS = "[ \\t\\r\\n\\f]+"
BLANK_CHARS = " \t\r\n\f"
NON_LETTERS = "[^a-z]+"
MIN_TERM_LENGTH = 3


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Remove blanks, tabs and line ends on both sides (``trim`` removes spaces only)."""
    return F.btrim(col(c), F.lit(BLANK_CHARS))


def words(c: str | Column) -> Column:
    """Whitespace tokens of a text; the default tokeniser."""
    return F.split(strip(c), BLANKS)


def terms(c: str | Column) -> Column:
    """Lower-case search terms: runs of ASCII letters longer than two."""
    return F.filter(F.split(F.lower(col(c)), NON_LETTERS), lambda t: F.length(t) >= MIN_TERM_LENGTH)


def normalised(c: str | Column) -> Column:
    """Lower-case text with runs of blanks reduced to one space."""
    return F.regexp_replace(F.lower(strip(c)), BLANKS, " ")

"""Small helpers shared by the column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# The characters that count as white space in text and author fields.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same set as a regex class body.
WS = r"\s\x0b\x1c-\x1f\x85\p{Z}"
# Word characters: letters, numbers and underscore in any script, no combining marks.
WORD = r"\p{L}\p{N}_"


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def trim_ws(x: Column | str) -> Column:
    """Strip all Unicode white space at both ends (``trim`` strips only spaces)."""
    return F.btrim(col(x), F.lit(WHITESPACE))


def is_blank(x: Column | str) -> Column:
    """True for null, empty and white-space-only strings."""
    return F.coalesce(trim_ws(x) == "", F.lit(True))


def safe_text(x: Column | str) -> Column:
    return F.coalesce(col(x).cast("string"), F.lit(""))


def blank_to_null(x: Column | str) -> Column:
    return F.when(~is_blank(x), col(x))

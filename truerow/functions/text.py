"""Text helpers on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# All characters that count as white space.
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove all leading and trailing white space, not only spaces."""
    return F.trim(text, F.lit(WHITE_SPACE))


# Ranges keep the class fast. Most texts begin and end with a plain ASCII character.
_SPACES = r"\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_FILLED = rf"(?:[!-~]|[^{_SPACES}])"
_STRIPPED = rf"\A{_FILLED}(?:(?s:.*){_FILLED})?\z"


def filled(text: Column) -> Column:
    """The stripped text, NULL when nothing is left. Trimming is slow, so it runs only where needed."""
    return F.when(text.rlike(_STRIPPED), text).when(text.rlike(_FILLED), strip(text))


def is_blank(text: Column) -> Column:
    """NULL or empty; a text of spaces is not blank."""
    return F.coalesce(text, F.lit("")) == ""


def non_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))

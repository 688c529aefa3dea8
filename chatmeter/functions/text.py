"""Text helpers with the same results as the Python string methods of the log jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Python counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Cut white space of every kind at both ends; ``trim`` would cut blanks only."""
    return F.btrim(text, F.lit(WHITESPACE))


def field(fields: Column, index: int) -> Column:
    """Array item or null. ``fields[index]`` raises under ANSI mode, even behind a size filter,
    because the optimizer may move the two together."""
    return F.get(fields, F.lit(index))


def words(text: Column) -> Column:
    """Words between single blanks; neighbouring blanks give empty words."""
    return F.split(text, " ")

"""Text normalisation with Python ``str.strip`` / ``str.title`` semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.isspace`` accepts, i.e. what
# ``str.strip()`` removes (Spark's ``trim`` removes spaces only).
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_ws(col: Column) -> Column:
    """``str.strip()``: trim every Python white-space character at both ends."""
    return F.btrim(col, F.lit(PY_WHITESPACE))


# Letters that have case (upper, lower, title): Python starts a new word after
# any character outside this set, including uncased letters such as CJK.
_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def title_case(col: Column) -> Column:
    """``str.title()``: a letter run starts upper-case, the rest is lower-case.

    Spark's ``initcap`` only starts a word after a space.  Both rules agree on
    ASCII text in which no letter follows a character other than a letter or a
    space, so such strings (nearly all names) take ``initcap``.  Others are cut
    before every cased letter that follows an uncased character and each piece
    is ``initcap``-ed: all on the JVM, no Python.  Characters whose Python
    title case is several characters (``ß`` -> ``Ss``) keep Java's one-to-one
    mapping.
    """
    pieces = F.split(col, rf"(?<=[^{_CASED}])(?=[{_CASED}])")
    piecewise = F.array_join(F.transform(pieces, F.initcap), "")
    return F.when(col.rlike(r"[^\x00-\x7F]|[^A-Za-z ][A-Za-z]"), piecewise).otherwise(F.initcap(col))


def clean_name(col: Column) -> Column:
    """``.str.strip().str.title()``."""
    return title_case(strip_ws(col))


def label_from_key(col: Column) -> Column:
    """Metric key to label: ``'on_time_rate_pct'`` -> ``'On Time Rate Pct'``."""
    return title_case(F.replace(col, F.lit("_"), F.lit(" ")))

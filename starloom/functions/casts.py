"""Casts that turn bad text into NULL, identically with ANSI mode on or off.

Raw public-record extracts are all text. The conformance rules expect a bad
value to become NULL (and later a sentinel code), never to fail the job, so
every cast here goes through ``try_*``. All of them are plain Catalyst
expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c: str | Column) -> Column:
    """Text -> int, read the lenient way.

    Blanks around the number are ignored, a fractional part is truncated
    (``'10.5'`` -> 10, ``'12.0'`` -> 12) and anything else -- words, empty
    text, exponents, values beyond the int range -- becomes NULL.
    """
    return _to_integral(c, "int")


def _to_integral(c: str | Column, t: str) -> Column:
    # Text is read as a decimal and truncated; both steps give NULL for what
    # doesn't fit, and an exponent is no number here. A word costs the decimal
    # an exception, so of a column only text that begins as a number may gets
    # there. An expression stands here once, with the exponent's letter spoilt
    # instead: filters and conform projections copy this, and whatever feeds
    # it must not be multiplied.
    text = F.trim(col_of(c).cast("string"))
    if not isinstance(c, str):
        return F.translate(text, "eE", "xx").try_cast("decimal(38,10)").try_cast(t)
    may = (text < ":") | (text > "\x7f")  # a sign, a point, a digit or a control character; or a digit beyond ASCII
    return F.when(may & ~F.contains(text, F.lit("e")) & ~F.contains(text, F.lit("E")), text.try_cast("decimal(38,10)").try_cast(t))


def to_long(c: str | Column) -> Column:
    """Text -> bigint, read like :func:`to_int` (for keys beyond the int range)."""
    return _to_integral(c, "bigint")


def to_double(c: str | Column) -> Column:
    """Text -> double, NULL when it is not a number."""
    return F.trim(col_of(c).cast("string")).try_cast("double")


def to_float(c: str | Column) -> Column:
    """Text -> float (single precision), NULL when it is not a number."""
    return F.trim(col_of(c).cast("string")).try_cast("float")


_ISO_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_BR_DAY = r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$"


def to_date(c: str | Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Text -> date in ``fmt``; impossible days such as 31/02 become NULL.

    The two layouts of the sources (``yyyy-MM-dd``, ``dd/MM/yyyy``) are read
    by checking the exact shape and casting the ISO form -- the same result
    as a strict pattern parse at a fraction of its cost. Other patterns use
    ``try_to_date``.
    """
    src = col_of(c)
    if fmt == "yyyy-MM-dd":
        return F.when(src.rlike(_ISO_DAY), src.try_cast("date"))
    if fmt == "dd/MM/yyyy":
        iso = F.concat(F.substring(src, 7, 4), F.lit("-"), F.substring(src, 4, 2), F.lit("-"), F.substring(src, 1, 2))
        return F.when(src.rlike(_BR_DAY), iso.try_cast("date"))
    return F.try_to_date(src, fmt)

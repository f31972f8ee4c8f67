"""Text conformance: trimming, prefixes, hash keys, decimal commas, lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans import vocab as V
from .casts import col_of, to_float, to_int


def clean(c: str | Column) -> Column:
    """Trimmed text (NULL stays NULL)."""
    return F.trim(col_of(c))


def clean_upper(c: str | Column) -> Column:
    return F.upper(F.trim(col_of(c)))


def first_char(c: str | Column, upper: bool = False) -> Column:
    """First character of the trimmed text, optionally upper-cased first."""
    t = clean_upper(c) if upper else clean(c)
    return F.substring(t, 1, 1)


def code_prefix(c: str | Column, width: int = 6) -> Column:
    """Leading ``width`` characters of a code as int.

    Municipality codes come with 6 or 7 digits (the 7th is a check digit); the
    6-digit prefix is the join key. Text that is not numeric becomes NULL.
    """
    return to_int(F.substring(clean(c), 1, width))


def decimal_comma(c: str | Column) -> Column:
    """``'-10,5'`` -> -10.5 as float: decimal comma repaired, then cast."""
    return to_float(F.regexp_replace(clean(c), ",", "."))


def none_as_zero(c: str | Column) -> Column:
    """Replace the literal text ``None`` (a null written as text) by ``0``."""
    return F.replace(clean(c), F.lit(V.NONE_TEXT), F.lit(V.NO_CODE))


def hash_key(c: str | Column) -> Column:
    """SHA-256 hex surrogate key of a text; NULL text gives a NULL key."""
    return F.sha2(col_of(c), 256)


def split_max(c: str | Column, sep: str = ",") -> Column:
    """Largest element of a separated list, compared as text.

    Comparison is lexicographic: ``'9,10'`` -> ``'9'``, and because only the
    whole text is trimmed, ``'1, 2'`` -> ``'1'`` (``' 2'`` sorts first).
    """
    return F.array_max(F.split(clean(c), sep))

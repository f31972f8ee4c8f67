"""Code recoding as single CASE expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans import vocab as V
from .casts import col_of, to_int
from .text import clean, first_char

KEEP = object()  # "leave the value as it is" marker for recode()


def recode(
    c: str | Column,
    mapping: Mapping[Any, Any],
    default: Any = KEEP,
    null: Any = KEEP,
) -> Column:
    """CASE over ``mapping``; unmatched values get ``default`` (or stay),
    NULL gets ``null`` (or stays NULL). Literal results take the type Spark
    infers for the branch values, so keep them one type."""
    src = col_of(c)
    expr = None
    if null is not KEEP:
        expr = F.when(src.isNull(), F.lit(null))
    for k, v in mapping.items():
        cond = src == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    tail = src if default is KEEP else F.lit(default)
    return tail if expr is None else expr.otherwise(tail)


def first_present(pairs: Sequence[tuple[str | Column, Any]], otherwise: Any) -> Column:
    """Value of the first pair whose column is present (not NULL after trim)."""
    expr = None
    for c, value in pairs:
        cond = clean(c).isNotNull()
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(F.lit(otherwise))


def bucketize(c: str | Column, bands: Sequence[tuple[int | None, int | None, str]]) -> Column:
    """Label of the inclusive band ``(lo, hi, label)`` holding the value;
    ``None`` bounds are open. NULL input gives NULL (not the last band)."""
    src = col_of(c)
    expr = F.when(src.isNull(), F.lit(None).cast("string"))
    for lo, hi, label in bands:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (src >= lo)
        if hi is not None:
            cond = cond & (src <= hi)
        expr = expr.when(cond, F.lit(label))
    return expr


def sex_code(c: str | Column, *, first_letter: bool = True, upper: bool = False,
             unknown: Sequence[str] = tuple(V.UNKNOWN_SEX), missing: str = V.MISSING_SEX) -> Column:
    """Sex code: the (first letter of the) trimmed text; NULL and the
    ``unknown`` codes become ``missing``."""
    code = first_char(c, upper=upper) if first_letter else clean(c)
    return F.when(code.isNull() | code.isin(*unknown), F.lit(missing)).otherwise(code)


def swapped_race_code(c: str | Column, swap: tuple[str, str] = V.RACE_DIGIT_SWAP,
                      codes: Mapping[int, int] = V.RACE_RECODE, missing: int = V.RACE_MISSING) -> Column:
    """Race code of the SRAG layout: every digit 4 in the text becomes 6, the
    text is read as int, then 6 -> 3, 3 -> 4, 9 -> 99, NULL -> 99.
    (So source '4' -> 3, '3' -> 4, '6' -> 3 and '14' -> 16.)"""
    raw = to_int(F.regexp_replace(clean(c), swap[0], swap[1]))
    return recode(raw, codes, null=missing)


def letter_flag(c: str | Column, codes: Mapping[str, str] = V.FLAG_RECODE,
                missing: str = V.FLAG_MISSING) -> Column:
    """Yes/no letter code as text: 'S' -> '1', 'N' -> '2', NULL -> '9',
    anything else kept as trimmed text."""
    return recode(clean(c), codes, null=missing)

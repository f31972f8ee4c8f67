"""Age text parsing, labels and bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans import vocab
from .casts import col_of, to_int
from .codes import bucketize


def strip_year_words(c: str | Column) -> Column:
    """Remove the year words from an age text ('10 anos' -> '10')."""
    text = col_of(c)
    for word in vocab.YEAR_WORDS:
        text = F.replace(text, F.lit(word), F.lit(""))
    return text


def age_from_text(c: str | Column) -> Column:
    """Census age text -> int years.

    '10 anos' -> 10, '1 ano' -> 1; a text that still holds a word starting
    with 'm' once the year words are gone -> 0 ('1 ano e 3 meses', and also
    '100 anos ou mais' -> '100 ou mais', since ' mais' matches the same
    ``'% m%'`` rule); other texts that are not a number ('5 a 9 anos') -> NULL.
    """
    stripped = F.trim(strip_year_words(c))
    return F.when(stripped.like(vocab.MONTHS_PATTERN), F.lit(0)).otherwise(to_int(stripped))


def age_text_label(c: str | Column, age: Column) -> Column:
    """Description kept next to the parsed age: the stripped text, or the
    fixed months label when the age parsed as 0."""
    stripped = F.rtrim(F.ltrim(strip_year_words(c)))
    return F.when(age == 0, F.lit(vocab.MONTHS_LABEL)).otherwise(stripped)


def age_label(c: str | Column) -> Column:
    """'1 Ano' for ages up to one, '<n> Anos' otherwise."""
    a = col_of(c)
    word = F.when(a <= 1, F.lit(vocab.YEAR_SINGULAR)).otherwise(F.lit(vocab.YEAR_PLURAL))
    return F.concat(a.cast("string"), F.lit(" "), word)


def age_band(c: str | Column, bands: Sequence[tuple[int | None, int | None, str]] = vocab.AGE_BANDS) -> Column:
    return bucketize(c, bands)

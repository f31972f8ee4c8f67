"""Calendar attributes as native expressions (no Python worker)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import col_of


def epi_week(c: str | Column) -> Column:
    """Epidemiological week number: the ISO week, plus one when the day is a
    Sunday (weeks run Sunday to Saturday). Yields 53 or 54 around New Year,
    e.g. 2021-01-03 -> 54 and 2022-01-02 -> 53."""
    d = col_of(c)
    return F.weekofyear(d) + F.when(F.dayofweek(d) == 1, 1).otherwise(0)


def two_digits(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def calendar_columns(c: str | Column) -> dict[str, Column]:
    """Day attributes of the calendar dimension for a date column.

    ``ano`` is the calendar year, so a week that belongs to the previous
    epidemiological year is still prefixed with the day's own year
    (2021-01-01 -> '202153').
    """
    d = col_of(c)
    ano = F.date_format(d, "yyyy")
    semana_epi = two_digits(epi_week(d))
    return {
        "dia": F.date_format(d, "dd"),
        "mes": F.date_format(d, "MM"),
        "ano": ano,
        "anomes": F.trunc(d, "month"),
        "semana": two_digits(F.weekofyear(d)),
        "semana_epi": semana_epi,
        "anosemana_epi": F.concat(ano, semana_epi),
    }

"""Values that a conform step could not read."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rejected_values(checks: Mapping[str, tuple[Column | str, Column | str]]) -> Column:
    """``array<struct<coluna, texto>>``: for each name the source text that is
    not blank although its value is NULL. Computed in the projection that
    makes the values, so it costs no pass of its own. Only rows with such a
    text build the array."""
    found, bad = [], F.lit(False)
    for name, (text, value) in checks.items():
        text = F.col(text) if isinstance(text, str) else text
        value = F.col(value) if isinstance(value, str) else value
        unreadable = value.isNull() & (F.trim(text) != "")  # most values are there: their text is not looked at
        found.append(F.when(unreadable, F.struct(F.lit(name).alias("coluna"), text.alias("texto"))))
        bad = bad | unreadable
    return F.when(bad, F.array_compact(F.array(*found))).otherwise(F.array().cast("array<struct<coluna:string,texto:string>>"))


def reject_account(rows: DataFrame, *by: str, rejects: str = "rejeitos") -> DataFrame:
    """Unreadable values for each of ``by`` (source file) and column, with the
    least of their texts as an example. Rows without any are dropped before
    they are exploded."""
    each = rows.where(F.size(rejects) > 0).select(*by, F.inline(rejects))
    return each.groupBy(*by, "coluna").agg(F.count(F.lit(1)).alias("valores"), F.min("texto").alias("exemplo"))

"""DataFrame -> DataFrame conformance steps."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import to_date, to_float, to_int


def fill_sentinels(df: DataFrame, sentinels: Mapping[str, Any]) -> DataFrame:
    """Replace NULL by a sentinel code, per column.

    The sentinel is cast to the column's own type, so a text code column gets
    ``'0'`` and an int column gets ``0``; a column never changes type here.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({
        name: F.coalesce(F.col(name), F.lit(value).cast(types[name]))
        for name, value in sentinels.items()
    })


_CASTS = {"int": to_int, "integer": to_int, "float": to_float}


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Tighten text code columns to ``int``/``float``/``date`` (NULL on bad text)."""
    out: dict[str, Column] = {}
    for name, t in types.items():
        if t == "date":
            out[name] = to_date(name)
        else:
            out[name] = _CASTS[t](name)
    return df.withColumns(out)

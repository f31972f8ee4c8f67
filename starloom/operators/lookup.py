"""Lookup tables and the geographic dimension join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def collapse_lookup(df: DataFrame, keys: Sequence[str], maxes: Sequence[str]) -> DataFrame:
    """One row per ``keys``: several localities of a municipality collapse to
    the largest value of each of ``maxes`` (partial + final aggregate)."""
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in maxes])


def lookup_dim(
    rows: DataFrame,
    key: str,
    lookup: DataFrame,
    lookup_key: str,
    columns: Mapping[str, Column],
    where: Column | None = None,
) -> DataFrame:
    """Dimension from the distinct codes of ``rows`` joined to ``lookup``.

    Equivalent to ``SELECT DISTINCT <columns> FROM rows JOIN lookup ON
    key = lookup_key WHERE <where>`` whenever ``columns`` depend only on the
    key and lookup columns: the codes are deduplicated *before* the join, so
    only one row per code (not every fact row) reaches the join. ``columns``
    may refer to ``key`` and to any lookup column; codes without a lookup
    row are dropped (inner join).

    No join hint is given and nothing is counted here: both sides are one
    row per code, and Spark broadcasts one of them when its size (from file
    statistics, or measured at run time by AQE) is below the session's
    threshold.
    """
    keyed = rows.filter(where) if where is not None else rows
    codes = keyed.select(F.col(key).cast("int").alias(key)).filter(F.col(key).isNotNull()).distinct()
    return describe_codes(codes, key, lookup, lookup_key, columns)


def describe_codes(codes: DataFrame, key: str, lookup: DataFrame, lookup_key: str, columns: Mapping[str, Column]) -> DataFrame:
    """The dimension of :func:`lookup_dim` from its distinct codes."""
    joined = codes.join(lookup, F.col(key) == F.col(lookup_key), "inner")
    return joined.select(*[c.alias(n) for n, c in columns.items()]).distinct()

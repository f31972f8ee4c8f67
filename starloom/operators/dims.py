"""Deduplicated dimension tables: (code, descriptions) DISTINCT."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(eq=False, frozen=True)
class DimSpec:
    """Declarative dimension.

    ``columns`` maps output name -> expression (or source column name), in
    output order. ``defaults`` fills NULL descriptions (``coalesce``);
    ``not_null`` keeps only rows whose listed source columns are present;
    ``where`` filters rows before, ``having`` after the DISTINCT.
    ``unique_by`` names columns (of the output) that identify a row: of
    several rows for one of them, that of most source rows stays, the least
    values among equals. Without it a code described in two ways has two rows.
    """

    columns: Mapping[str, Column | str]
    defaults: Mapping[str, Any] = field(default_factory=dict)
    not_null: Sequence[str] = ()
    where: Column | str | None = None
    having: Column | str | None = None
    unique_by: Sequence[str] = ()


def dim_columns(spec: DimSpec) -> dict[str, Column]:
    """The spec's output columns as expressions, defaults filled in."""
    cols = {}
    for name, e in spec.columns.items():
        c = F.col(e) if isinstance(e, str) else e
        cols[name] = F.coalesce(c, F.lit(spec.defaults[name])) if name in spec.defaults else c
    return cols


def dim_filter(spec: DimSpec) -> Column | None:
    """The rows that the spec takes (None: all)."""
    parts = [F.col(c).isNotNull() for c in spec.not_null]
    if spec.where is not None:
        parts.append(F.expr(spec.where) if isinstance(spec.where, str) else spec.where)
    return reduce(lambda a, b: a & b, parts) if parts else None


def _rows(df: DataFrame, spec: DimSpec) -> DataFrame:
    where = dim_filter(spec)
    rows = df if where is None else df.filter(where)
    return rows.select(*[c.alias(n) for n, c in dim_columns(spec).items()])


def build_dim(df: DataFrame, spec: DimSpec) -> DataFrame:
    """DISTINCT over the dimension's columns.

    Spark plans it as a partial aggregate per partition (duplicates of a hot
    code collapse before the shuffle), one shuffle, final aggregate. A code
    spelled two ways keeps two rows -- uniqueness is by the whole tuple --
    unless the spec has ``unique_by``.
    """
    rows = _rows(df, spec)
    if spec.unique_by:
        rows = rows.groupBy(*spec.columns).agg(F.count(F.lit(1)).alias("_linhas"))
        return finish_dim(rows, spec)
    out = rows.distinct()
    return out.filter(spec.having) if spec.having is not None else out


def finish_dim(counted: DataFrame, spec: DimSpec) -> DataFrame:
    """The dimension, from its distinct rows and their ``_linhas``."""
    out = counted.filter(spec.having) if spec.having is not None else counted
    return chosen(out, spec.unique_by) if spec.unique_by else out.select(*spec.columns)


def chosen(counted: DataFrame, unique_by: Sequence[str], weight: str = "_linhas") -> DataFrame:
    """One row for each value of ``unique_by``: that of the largest
    ``weight``, the least other values among equals (a ranked choice as one
    aggregate: no sort, no window)."""
    columns = [c for c in counted.columns if c != weight]
    rest = [c for c in columns if c not in unique_by]
    if not rest:
        return counted.select(*columns).distinct()
    pick = F.min_by(F.struct(*rest), F.struct((-F.col(weight)).alias("w"), *rest))
    return counted.groupBy(*unique_by).agg(pick.alias("_pick")).select(*[F.col(c) if c in unique_by else F.col(f"_pick.{c}").alias(c) for c in columns])


def dim_conflicts(df: DataFrame, spec: DimSpec, unique_by: Sequence[str] = ()) -> DataFrame:
    """The audit beside the choice: each value of ``unique_by`` (by default
    the spec's) that has several rows in the plain dimension, with
    ``variantes`` (how many), ``linhas`` (source rows of all) and
    ``linhas_outras`` (source rows of those that the choice leaves out)."""
    by = list(unique_by or spec.unique_by)
    counted = _rows(df, spec).groupBy(*spec.columns).agg(F.count(F.lit(1)).alias("_linhas"))
    if spec.having is not None:
        counted = counted.filter(spec.having)
    found = counted.groupBy(*by).agg(F.count(F.lit(1)).alias("variantes"), F.sum("_linhas").alias("linhas"), F.max("_linhas").alias("_most"))
    return found.where("variantes > 1").select(*by, "variantes", "linhas", (F.col("linhas") - F.col("_most")).alias("linhas_outras"))

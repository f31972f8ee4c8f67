"""Keyed fact tables: filter -> group by keys -> one additive measure."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(eq=False, frozen=True)
class Measure:
    """``kind`` is ``count`` (rows), ``count_distinct`` or ``sum`` of ``column``;
    ``cast`` optionally retypes the result (e.g. counts stored as float)."""

    kind: str
    alias: str
    column: str | None = None
    cast: str | None = None

    def expr(self) -> Column:
        if self.kind == "count":
            out = F.count(F.lit(1))
        elif self.kind == "count_distinct":
            out = F.count_distinct(F.col(self.column))
        elif self.kind == "sum":
            out = F.sum(F.col(self.column))
        else:
            raise ValueError(f"unknown measure kind {self.kind!r}")
        return out.cast(self.cast).alias(self.alias) if self.cast else out.alias(self.alias)


@dataclass(eq=False, frozen=True)
class FactSpec:
    """Declarative fact table.

    ``where`` filters rows before grouping (reaches the Parquet scan when it
    only touches stored columns); ``shift`` adds a constant to a key *after*
    grouping; ``having`` filters the emitted rows (Catalyst moves it below the
    aggregate); ``rename`` maps a key column to its output name.
    """

    keys: Sequence[str]
    measure: Measure
    where: Column | str | None = None
    having: Column | str | None = None
    shift: Mapping[str, int] = field(default_factory=dict)
    rename: Mapping[str, str] = field(default_factory=dict)


def build_fact(df: DataFrame, spec: FactSpec) -> DataFrame:
    """Group ``df`` by the spec's keys and compute its measure.

    Plan: partial aggregate on every input partition (map-side combine), one
    shuffle on the keys, final aggregate; a distinct count adds one level
    keyed by (keys, id), so a hot key group is spread over many tasks by its
    ids before it is counted. No group is ever collected into one place.
    """
    rows = df.filter(spec.where) if spec.where is not None else df
    return finish_fact(rows.groupBy(*spec.keys).agg(spec.measure.expr()), spec)


def finish_fact(grouped: DataFrame, spec: FactSpec) -> DataFrame:
    """The spec's shifted and renamed keys, its measure and the rows that
    ``having`` keeps, from one row per group of keys."""
    keys = []
    for k in spec.keys:
        c = F.col(k) + F.lit(spec.shift[k]) if k in spec.shift else F.col(k)
        keys.append(c.alias(spec.rename.get(k, k)))
    out = grouped.select(*keys, spec.measure.alias)
    return out.filter(spec.having) if spec.having is not None else out

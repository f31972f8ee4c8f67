"""Several DISTINCT tables from one pass over their common input."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class OnePass:
    """The distinct rows of several tables, computed together.

    Every input row becomes one row for each table that takes it, in shared,
    typed slots beside the table's number; one partial aggregate, one shuffle
    and one final aggregate find the distinct rows of all. The input is
    scanned once, whatever the number of tables.

    ``tables``: for each name its columns (name -> expression or source
    column) and the rows it takes (None: all).
    """

    def __init__(self, df: DataFrame, tables: Mapping[str, tuple[Mapping[str, Column | str], Column | None]]) -> None:
        self.names = list(tables)
        own = {n: df.select(*[(F.col(e) if isinstance(e, str) else e).alias(c) for c, e in cols.items()]).schema for n, (cols, _) in tables.items()}
        self.slots: dict[str, dict[str, str]] = {}
        kinds: dict[str, str] = {}
        for n, schema in own.items():
            used: dict[str, int] = {}
            self.slots[n] = {}
            for f in schema.fields:
                kind = f.dataType.simpleString()
                k = used[kind] = used.get(kind, -1) + 1
                slot = "".join(x if x.isalnum() else "_" for x in kind) + str(k)
                kinds[slot] = kind
                self.slots[n][f.name] = slot
        self.kinds = dict(sorted(kinds.items()))
        cells: list[Column] = []
        for number, (n, (cols, where)) in enumerate(tables.items()):
            value = {self.slots[n][c]: F.col(e) if isinstance(e, str) else e for c, e in cols.items()}
            taken = F.lit(number) if where is None else F.when(where, F.lit(number))
            cells += [taken, *[(value[s] if s in value else F.lit(None)).cast(kind) for s, kind in self.kinds.items()]]
        rows = df.select(F.stack(F.lit(len(tables)), *cells).alias("tabela", *self.kinds))
        self.rows = rows.where("tabela is not null").groupBy("tabela", *self.kinds).agg(F.count(F.lit(1)).alias("_linhas"))

    def table(self, rows: DataFrame, name: str) -> DataFrame:
        """The distinct rows of one table, from ``rows`` (these, or as
        written); ``_linhas``: the input rows that each stands for."""
        return rows.where(F.col("tabela") == self.names.index(name)).select(*[F.col(s).alias(c) for c, s in self.slots[name].items()], "_linhas")

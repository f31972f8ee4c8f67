"""Facts that are continued delivery by delivery.

Beside a delivered layer (:mod:`starloom.sources.ledger`) a fact keeps a
state: the partial aggregates of each file version. A new delivery adds the
partials of the files that are new or changed, computed from their rows
alone; those of a file version that the ledger names no more are left out
from then on. The fact is the merge of the partials in force, and equals the
rebuild from all rows.

Measures merge exactly:

* ``count`` and ``sum``: partial counts and sums are added;
* ``count_distinct``: the ids are numbered once, in a dictionary that grows
  with the deliveries, and each group keeps the words of its bitmap that are
  not empty, 64 numbers each, united with a bitwise or (``bitmaps``), or the
  distinct ids themselves (``pairs``, for groups of few). A group never has
  more words than ids, so the state grows with the rows however few ids of
  one stretch of numbers fall into a group.

Layout below the state: ``parciais/estado=<v>``, ``ids/estado=<v>``,
``livro/<v>`` (the file versions whose partials are there) and the commits
of :mod:`starloom.sources.versions`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.facts import FactSpec, finish_fact
from ..sources import LAYER_CODEC, read_delivered, read_ledger, shuffles_released, versions

_FILE = ("arquivo", "versao")


def _partials(rows: DataFrame, spec: FactSpec, distinct: str) -> DataFrame:
    """One row per file version and group (and word, or id)."""
    by = rows.groupBy(*_FILE, *spec.keys)
    kind, column = spec.measure.kind, spec.measure.column
    if kind == "count":
        return by.agg(F.count(F.lit(1)).alias("parcial"))
    if kind == "sum":
        return by.agg(F.sum(column).alias("parcial"))
    if distinct == "pairs":
        return rows.select(*_FILE, *spec.keys, F.col(column).alias("parcial")).distinct()
    bit = F.expr("shiftleft(1L, cast(numero & 63 as int))")
    return rows.groupBy(*_FILE, *spec.keys, F.shiftright("numero", 6).alias("palavra")).agg(F.bit_or(bit).alias("parcial"))


def _merged(partials: DataFrame, spec: FactSpec, distinct: str) -> DataFrame:
    by, measure = partials.groupBy(*spec.keys), spec.measure
    if measure.kind in ("count", "sum"):
        value = F.sum("parcial")
        if measure.kind == "count":
            value = F.coalesce(value, F.lit(0).cast("long"))
        out = by.agg(value.cast(dict(partials.dtypes)["parcial"]).alias("_medida"))
    elif distinct == "pairs":
        out = by.agg(F.count_distinct("parcial").alias("_medida"))
    else:
        united = partials.groupBy(*spec.keys, "palavra").agg(F.bit_or("parcial").alias("parcial"))
        ids = F.sum(F.bit_count("parcial").cast("long"))  # a group of null ids alone has none
        out = united.groupBy(*spec.keys).agg(F.coalesce(ids, F.lit(0).cast("long")).alias("_medida"))
    value = F.col("_medida").cast(measure.cast) if measure.cast else F.col("_medida")
    return finish_fact(out.withColumn(measure.alias, value), spec)


def _put(spark: SparkSession, rows: DataFrame, path: str) -> None:
    with shuffles_released(spark):
        rows.write.option("compression", LAYER_CODEC).parquet(path)


def _parts(spark: SparkSession, state: str, name: str, folders: list[str]) -> DataFrame | None:
    paths = [f"{state}/{name}/estado={f}" for f in folders]
    return spark.read.option("basePath", f"{state}/{name}").parquet(*paths).drop("estado") if paths else None


def _numbered(spark: SparkSession, state: str, folder: str, note: dict, rows: DataFrame, column: str) -> tuple[DataFrame, dict]:
    """``rows`` with the ``numero`` of their id; new ids get the next numbers.
    Numbers are unique, not dense; they are written before they are used."""
    known = _parts(spark, state, "ids", note.get("ids", []))
    new = rows.select(F.col(column).alias("id")).where("id is not null").distinct()
    if known is not None:
        new = new.join(known.select("id"), "id", "left_anti")
    first = note.get("next", 0)
    _put(spark, new.select("id", (F.monotonically_increasing_id() + first).alias("numero")), f"{state}/ids/estado={folder}")
    note = {**note, "ids": [*note.get("ids", []), folder]}
    added = spark.read.parquet(f"{state}/ids/estado={folder}")
    last = added.agg(F.max("numero")).first()[0]
    note["next"] = first if last is None else last + 1
    ids = _parts(spark, state, "ids", note["ids"])
    return rows.join(ids.withColumnRenamed("id", column), column, "left"), note


def continue_fact(spark: SparkSession, layer: str, state: str, spec: FactSpec, distinct: str = "bitmaps") -> int:
    """Bring the state up to the layer's ledger, reading only the rows of
    file versions that it does not hold. Returns how many these were.

    One commit puts the result in force; a failed run leaves the state as it
    was. The spec must be the one that the state began with.
    """
    if distinct not in ("bitmaps", "pairs"):
        raise ValueError(f"distinct must be bitmaps or pairs, not {distinct!r}")
    state = state.rstrip("/")
    kept = {"bitmaps": "words", "pairs": "pairs"}[distinct]  # states of whole bitmaps, as once kept, are another spec's
    mark = repr((tuple(spec.keys), spec.measure, kept if spec.measure.kind == "count_distinct" else None, str(spec.where)))
    number, note = versions.current(spark, state)
    if note.get("spec", mark) != mark:
        raise ValueError(f"{state} was begun with another spec: {note['spec']}")
    live = read_ledger(spark, layer).select(*_FILE)
    held = spark.read.schema("arquivo string, versao string").parquet(f"{state}/livro/{note['folder']}") if number else live.limit(0)
    new = live.join(held, [*_FILE], "left_anti")
    n = new.count()
    if not n and not held.join(live, [*_FILE], "left_anti").count():
        return 0
    folder = versions.stage(number + 1)
    note = {**note, "folder": folder, "spec": mark}
    if n:
        rows = read_delivered(spark, layer, new, with_version=True)
        if spec.where is not None:
            rows = rows.filter(spec.where)
        if spec.measure.kind == "count_distinct" and distinct == "bitmaps":
            rows, note = _numbered(spark, state, folder, note, rows, spec.measure.column)
        _put(spark, _partials(rows, spec, distinct), f"{state}/parciais/estado={folder}")
        note["partials"] = [*note.get("partials", []), folder]
    live.write.parquet(f"{state}/livro/{folder}")
    versions.commit(spark, state, number + 1, note)
    return n


def continued_fact(spark: SparkSession, state: str, spec: FactSpec, distinct: str = "bitmaps") -> DataFrame:
    """The fact: the merge of the partials in force. Reads no rows of the layer."""
    state = state.rstrip("/")
    number, note = versions.current(spark, state)
    if not number or not note.get("partials"):
        raise ValueError(f"no state of a fact at {state}")
    live = spark.read.schema("arquivo string, versao string").parquet(f"{state}/livro/{note['folder']}")
    return _merged(_parts(spark, state, "parciais", note["partials"]).join(live, [*_FILE], "left_semi"), spec, distinct)


def compact(spark: SparkSession, state: str) -> None:
    """Write the partials and ids in force as one folder each, without those
    of replaced files. The old folders stay: readers of older versions are
    not disturbed."""
    state = state.rstrip("/")
    number, note = versions.current(spark, state)
    if not number or not note.get("partials"):
        return
    folder = versions.stage(number + 1)
    live = spark.read.schema("arquivo string, versao string").parquet(f"{state}/livro/{note['folder']}")
    _put(spark, _parts(spark, state, "parciais", note["partials"]).join(live, [*_FILE], "left_semi"), f"{state}/parciais/estado={folder}")
    live.write.parquet(f"{state}/livro/{folder}")
    if note.get("ids"):
        _put(spark, _parts(spark, state, "ids", note["ids"]), f"{state}/ids/estado={folder}")
        note["ids"] = [folder]
    versions.commit(spark, state, number + 1, {**note, "folder": folder, "partials": [folder]})

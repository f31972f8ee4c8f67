"""A layer that knows which raw files it holds.

The ledger is a table beside the layer's rows: for each delivered file its
path below the root, its part token, length, time of last change, number of
rows, and the version that wrote its rows. A delivery compares it with a
listing of the root, reads only the files that are new or changed, stages
their rows under a version of their own, and commits the new ledger. Readers
take the rows that the ledger names: a changed file's old rows disappear with
the commit that brings its new ones, and nothing else does.

Layout below the layer: ``dados/versao=<v>/<partitions>``, ``livro/<v>``
and the commits of :mod:`starloom.sources.versions`.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..plans.vocab import PART_TOKEN
from ..operators.rejects import reject_account
from . import versions
from .csv import exactly, path_below, read_by_header, read_delimited
from .sinks import LAYER_CODEC

LEDGER = "arquivo string, parte string, tamanho long, modificado timestamp, linhas long, versao string"
#: What a file is to the ledger.
NEW, CHANGED, SAME, WITHDRAWN = "novo", "alterado", "igual", "retirado"


@dataclass(frozen=True)
class Delivery:
    """What a delivery did: files by state, rows written, the version now in
    force (0: none yet), and the texts that could not be read."""

    new: int
    changed: int
    unchanged: int
    withdrawn: int
    rows: int
    version: int
    rejected: int = field(default=0, compare=False)


def listing(spark: SparkSession, root: str, glob: str = "*.csv", part_token: str | None = PART_TOKEN) -> DataFrame:
    """``arquivo, caminho, url, parte, tamanho, modificado`` of the files below
    ``root``, at any depth (``url``: the path as a scan's ``_metadata`` has it). Nothing of their content is read. A file without
    any byte counts as not there."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
             .load(root).select("path", F.col("_metadata.file_path").alias("url"), "length", "modificationTime"))
    name = F.element_at(F.split("path", "/"), -1)
    token: Column = F.lit(None).cast("string")
    if part_token is not None:
        part = F.regexp_extract(name, part_token, 1)
        token = F.when(part != "", part).otherwise(
            F.raise_error(F.concat(F.lit("no part token in the file name "), name)).cast("string"))
    return found.select(path_below(spark, F.col("path"), root).alias("arquivo"), F.col("path").alias("caminho"), "url",
                        token.alias("parte"), F.col("length").alias("tamanho"), F.col("modificationTime").alias("modificado"))


def read_ledger(spark: SparkSession, layer: str) -> DataFrame:
    """The ledger in force; empty before the first delivery."""
    number, note = versions.current(spark, layer)
    if not number:
        return _empty(spark, LEDGER)
    return spark.read.schema(LEDGER).parquet(f"{layer.rstrip('/')}/livro/{note['folder']}")


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    """No rows of this schema, without a job or a Python worker."""
    fields = [c.strip().split(" ") for c in schema.split(",")]
    return spark.range(1).where("false").select(*[F.lit(None).cast(t).alias(n) for n, t in fields])


def compare(listed: DataFrame, ledger: DataFrame) -> DataFrame:
    """The listing beside the ledger: ``situacao`` is ``novo``, ``alterado``
    (another length or time), ``igual`` or ``retirado`` (listed no more)."""
    known = ledger.select("arquivo", *[F.col(c).alias(f"_{c}") for c in ("parte", "tamanho", "modificado", "linhas", "versao")])
    both = listed.join(known, "arquivo", "full_outer")
    same = F.col("tamanho").eqNullSafe(F.col("_tamanho")) & F.col("modificado").eqNullSafe(F.col("_modificado"))
    state = (F.when(F.col("_versao").isNull(), NEW).when(F.col("caminho").isNull(), WITHDRAWN)
             .when(same, SAME).otherwise(CHANGED))
    return both.withColumn("situacao", state)


def deliver(spark: SparkSession, root: str, layer: str, conform: Callable[[DataFrame], DataFrame], *,
            glob: str = "*.csv", part_token: str = PART_TOKEN, columns: Sequence[str] | None = None,
            sep: str = ";", encoding: str = "UTF-8", drop_withdrawn: bool = False,
            sort_within: Sequence[str] = (), max_records_per_file: int | None = None) -> Delivery:
    """Bring the layer up to date with the files below ``root``.

    Files are known by their path below the root, so two folders may use one
    name; a file of another length or time than the ledger's replaces its own
    rows, also if it has none left. A withdrawn file is counted and keeps its
    rows, unless ``drop_withdrawn``. A second run without news writes nothing.
    Only file names and counts reach the driver. ``columns``: the header that
    all files have; without it headers are discovered in one job.

    If ``conform`` adds ``rejeitos`` (see
    :func:`starloom.operators.rejected_values`), their number is observed
    while the rows are written, and an account by file and column is written
    beside them (:func:`read_rejects`).
    """
    layer = layer.rstrip("/")
    number, note = versions.current(spark, layer)
    ledger = read_ledger(spark, layer)
    found = compare(listing(spark, root, glob, part_token), ledger)
    states = dict(found.groupBy("situacao").count().collect())
    count = lambda state: states.get(state, 0)
    news = found.where(F.col("situacao").isin(NEW, CHANGED))
    if not count(NEW) + count(CHANGED) + (count(WITHDRAWN) if drop_withdrawn else 0):
        return Delivery(0, 0, count(SAME), count(WITHDRAWN), 0, number)
    folder, data, schema = versions.stage(number + 1), f"{layer}/dados", note.get("schema")
    rejected, accounts = 0, note.get("accounts", [])
    written = _empty(spark, "arquivo string, linhas long")
    paths = sorted(r["caminho"] for r in news.select("caminho").collect())
    if paths:
        source = dict(files=news.select("url", "parte", "arquivo"), sep=sep, encoding=encoding)
        scan = (read_delimited(spark, [exactly(p) for p in paths], columns, **source) if columns is not None
                else read_by_header(spark, [exactly(p) for p in paths], **source))
        order = ["parte", "arquivo", *sort_within]
        early = {c.lower() for c in sort_within} <= {c.lower() for c in scan.columns}
        rows = conform(scan.sortWithinPartitions(*order) if early else scan)  # the raw columns are half as wide to sort
        seen = Observation()
        bad = F.sum(F.size("rejeitos")) if "rejeitos" in rows.columns else F.max(F.lit(0))
        watched = rows.observe(seen, F.count(F.lit(1)).alias("linhas"), F.coalesce(bad, F.lit(0)).cast("long").alias("rejeitados"))
        writer = (watched if early else watched.sortWithinPartitions(*order)).write.option("compression", LAYER_CODEC).partitionBy("parte", "arquivo")
        if max_records_per_file:
            writer = writer.option("maxRecordsPerFile", max_records_per_file)
        writer.parquet(f"{data}/versao={folder}")
        schema = _merged(schema, rows.schema)
        fresh = spark.read.schema(rows.schema).parquet(f"{data}/versao={folder}")
        written = fresh.groupBy("arquivo").agg(F.count(F.lit(1)).alias("linhas"))
        rejected = int(seen.get["rejeitados"])
        if rejected:  # one narrow column of what was just written; the raw files are not read again
            reject_account(fresh, "arquivo").write.parquet(f"{layer}/rejeitos/versao={folder}")
            accounts = [*accounts, folder]
    kept = ledger.join(news.select("arquivo"), "arquivo", "left_anti")
    if drop_withdrawn:
        kept = kept.join(found.where(F.col("situacao") == WITHDRAWN).select("arquivo"), "arquivo", "left_anti")
    added = (news.select("arquivo", "parte", "tamanho", "modificado").join(written, "arquivo", "left")
             .select("arquivo", "parte", "tamanho", "modificado", F.coalesce("linhas", F.lit(0).cast("long")).alias("linhas"),
                     F.lit(folder).alias("versao")))
    kept.select(*added.columns).unionByName(added).write.parquet(f"{layer}/livro/{folder}")
    versions.commit(spark, layer, number + 1, {"folder": folder, "schema": schema, "accounts": accounts})
    total = int(seen.get["linhas"]) if paths else 0
    return Delivery(count(NEW), count(CHANGED), count(SAME), count(WITHDRAWN), total, number + 1, rejected)


def _merged(before: str | None, now: StructType) -> str:
    """The columns that any version has, as JSON; partition columns as text."""
    have = StructType.fromJson(json.loads(before)) if before else StructType([])
    known = {f.name.lower(): f for f in have.fields}
    for f in now.fields:
        old = known.get(f.name.lower())
        if old is not None and old.dataType != f.dataType:
            raise ValueError(f"{f.name} is {f.dataType.simpleString()} now and was {old.dataType.simpleString()}")
        if old is None:
            have = have.add(StructField(f.name, f.dataType, True))
    return have.json()


def read_rejects(spark: SparkSession, layer: str) -> DataFrame:
    """``arquivo, coluna, valores, exemplo``: the texts that could not be read
    in the files that the ledger names."""
    _, note = versions.current(spark, layer)
    base = f"{layer.rstrip('/')}/rejeitos"
    if not note.get("accounts"):
        return _empty(spark, "arquivo string, coluna string, valores long, exemplo string")
    schema = "arquivo string, coluna string, valores long, exemplo string, versao string"
    used = {r["versao"] for r in read_ledger(spark, layer).select("versao").distinct().collect()}
    paths = [f"{base}/versao={f}" for f in note["accounts"] if f in used]
    if not paths:
        return _empty(spark, "arquivo string, coluna string, valores long, exemplo string")
    rows = spark.read.schema(schema).option("basePath", base).parquet(*paths)
    return rows.join(read_ledger(spark, layer).select("arquivo", "versao"), ["arquivo", "versao"], "left_semi").drop("versao")


def read_delivered(spark: SparkSession, layer: str, files: DataFrame | None = None, with_version: bool = False) -> DataFrame:
    """The rows of the layer that the ledger names; ``files`` (``arquivo,
    versao``) picks others. The versions at hand become a filter on the
    partition column, so folders that no file needs are not read; the join
    with the ledger is one row a file and Spark broadcasts it where it is
    small."""
    number, note = versions.current(spark, layer)
    if not number or not note.get("schema"):
        raise ValueError(f"nothing was delivered to {layer}")
    live = (files if files is not None else read_ledger(spark, layer)).select("arquivo", "versao")
    used = [r["versao"] for r in live.select("versao").distinct().collect()]
    schema = StructType.fromJson(json.loads(note["schema"])).add("versao", StringType())
    rows = spark.read.schema(schema).option("basePath", f"{layer.rstrip('/')}/dados").parquet(f"{layer.rstrip('/')}/dados")
    out = rows.where(F.col("versao").isin(used)).join(live, ["versao", "arquivo"], "left_semi")
    columns = [f.name for f in schema.fields if with_version or f.name != "versao"]
    return out.select(*columns)


def drop_unused(spark: SparkSession, layer: str) -> list[str]:
    """Delete what no reader of the layer needs: folders of rows of which the
    ledger names no file (replaced by now, or of a failed delivery), and the
    ledgers and accounts of older versions. Returns the versions dropped.
    Only when no reader or writer is at work on an older version; a version
    of which one file is still in force stays whole."""
    layer = layer.rstrip("/")
    number, note = versions.current(spark, layer)
    if not number:
        return []
    used = {r["versao"] for r in read_ledger(spark, layer).select("versao").distinct().collect()}
    gone: set[str] = set()
    for name, keep, lead in (("dados", used, "versao="), ("livro", {note["folder"]}, ""), ("rejeitos", used, "versao=")):
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{layer}/{name}")
        fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(hadoop):
            continue
        for status in fs.listStatus(hadoop):
            folder = status.getPath().getName()
            version = folder[len(lead):] if folder.startswith(lead) else ""
            if status.isDirectory() and version[:1].isdigit() and version not in keep:
                fs.delete(status.getPath(), True)
                gone.add(version)
    return sorted(gone)

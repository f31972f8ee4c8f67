"""Batch jobs: raw extracts -> prestructured layer -> star-schema tables.

Every job takes the caller's ``SparkSession`` and paths, and writes Parquet.
Each table is one Spark job (scan -> conform -> aggregate -> write); a
failed task is retried by Spark and the file commit protocol keeps partial
output invisible, so a lost executor costs a retry, not a wrong table. The
prestructured layer is a written table: the star builders start from it,
which cuts the lineage back to the raw text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import align_columns, build_fact, day_spine, int_spine, union_aligned
from ..sources import (
    LAYER_CODEC,
    PART_TOKEN,
    Delivery,
    current,
    deliver,
    drop_scratch,
    read_by_header,
    read_delimited,
    read_delivered,
    read_layer,
    read_positional,
    replace_parquet,
    scratch_path,
    shuffles_released,
    write_counted,
    write_parquet,
)
from . import star
from . import vocab as V


def ingest_vaccination(spark: SparkSession, raw: str | Sequence[str], out: str,
                       part_token: str = PART_TOKEN, max_records_per_file: int | None = None,
                       columns: Sequence[str] | None = None,
                       sort_within: Sequence[str] = ("paciente_endereco_uf",), root: str = "") -> int:
    """Raw vaccination CSV files -> conformed rows, one
    ``parte=<token>/arquivo=<path>`` partition per file. Returns the
    rows written.

    A run replaces the partitions of the files it reads and no others: files
    that share a token, in one run or in several, stand beside each other,
    and a file delivered again replaces itself. Files are known by their path
    below ``root``, by default by their whole path: files of one name in two
    folders are two. A file name without a token fails the run. Files may
    differ in the order, the spelling and the number of their columns (one
    scan for each header, one job to find them);
    ``columns`` names the header that all files have, which saves reading
    the headers and checks every file against it. ``sort_within``: rows of a
    file are stored by these columns, so that the tables of one state read
    the row groups that hold it.
    """
    if columns is not None:
        scan = read_delimited(spark, raw, columns, part_token=part_token, file_column="arquivo", root=root)
    else:
        scan = read_by_header(spark, raw, part_token=part_token, file_column="arquivo", root=root)
    early = {c.lower() for c in sort_within} <= {c.lower() for c in scan.columns}
    if early:  # the raw columns are half as wide to sort
        scan = scan.sortWithinPartitions("parte", "arquivo", *sort_within)
    return write_counted(star.conform_vaccination(scan), out, partition_by=["parte", "arquivo"],
                         max_records_per_file=max_records_per_file, sort_within=() if early else sort_within, compression=LAYER_CODEC)


def deliver_vaccination(spark: SparkSession, root: str, layer: str, part_token: str = PART_TOKEN,
                        columns: Sequence[str] | None = None, drop_withdrawn: bool = False,
                        sort_within: Sequence[str] = ("paciente_endereco_uf",),
                        max_records_per_file: int | None = None, glob: str = "*.csv") -> Delivery:
    """Bring a layer of conformed vaccination rows up to date with the raw
    files below ``root`` (those that ``glob`` matches; packed ones are read
    by their ending, one task a file): only new and changed files are read, by the ledger
    beside the layer, and one commit puts the result in force (see
    :func:`starloom.sources.deliver`). Texts that could not be read are
    accounted for by file and column (:func:`starloom.sources.read_rejects`)."""
    conform = lambda raw: star.conform_vaccination(raw, account=True)
    return deliver(spark, root, layer, conform, glob=glob, part_token=part_token, columns=columns,
                   drop_withdrawn=drop_withdrawn, sort_within=sort_within, max_records_per_file=max_records_per_file)


def read_vaccination_layer(spark: SparkSession, prestructured: str) -> DataFrame:
    """The layer that :func:`ingest_vaccination` or
    :func:`deliver_vaccination` writes."""
    if current(spark, prestructured)[0]:
        return read_delivered(spark, prestructured)
    return read_layer(spark, prestructured, {"parte": "string", "arquivo": "string"})


def build_vaccination_tables(spark: SparkSession, prestructured: str, localities: str, out: str,
                             scope: star.Scope = star.DEFAULT_SCOPE, concurrent_writes: int = 4,
                             max_files: int | None = None, one_name: bool = False,
                             versioned: bool = False, one_scan: bool = False) -> dict[str, str]:
    """Vaccination fact + eleven dimensions from the prestructured layer.

    The localities file is read by its own header; five of its columns are
    used, in whatever order and beside whatever others. Each table reads
    only the columns it uses from the Parquet layer (column pruning), so
    twelve narrow scans cost about one wide one; the layer is not cached
    because at scale it does not fit in memory. Up to ``concurrent_writes``
    tables are submitted as concurrent Spark jobs, so the small dimensions
    fill the slots the fact's tail leaves idle.

    ``one_scan``: the layer is scanned once instead, one aggregate finds the
    distinct rows of all tables, and each table is finished from its part of
    them as written. This takes about half as much CPU time again, so it is
    for layers whose reading costs more than that.
    ``one_name``: a code with several descriptions has one row, that of most
    source rows, where the source system keeps a row for each.
    ``versioned``: tables are replaced atomically and read with
    :func:`starloom.sources.read_replaced`.
    """
    layer = read_vaccination_layer(spark, prestructured)
    raw = read_delimited(spark, localities).select(*star.LOCALITY_COLUMNS)
    lookup = star.localities_lookup(raw, scope.state_name, one_name)
    found = None
    if one_scan:
        once = star.vaccination_pass(layer, scope)
        found = scratch_path(spark, "vaccination-pass")
        with shuffles_released(spark):
            once.rows.write.partitionBy("tabela").parquet(found)
        tables = star.vaccination_tables(once, spark.read.schema(once.rows.schema).parquet(found), lookup, scope, one_name)
    else:
        tables = star.vaccination_star(layer, lookup, scope, one_name)
    paths = {name: f"{out.rstrip('/')}/{name}" for name in tables}
    write = replace_parquet if versioned else write_parquet
    with shuffles_released(spark), ThreadPoolExecutor(max_workers=max(1, concurrent_writes)) as pool:
        caps = {"fato_vacinas": max_files}
        for done in [pool.submit(write, df, paths[name], max_files=caps.get(name))
                     for name, df in tables.items()]:
            done.result()
    if found:
        drop_scratch(spark, found)
    return paths


def ingest_srag(spark: SparkSession, sources: Mapping[int, str], out: str,
                years: Sequence[int] | None = None, fill=None, replace: Mapping[int, Sequence[str]] | None = None,
                columns: Mapping[int, Sequence[str]] | None = None,
                scope: star.Scope = star.DEFAULT_SCOPE, account: bool = False) -> int:
    """Yearly SRAG CSV files -> state COVID-19 cases aligned to one column
    list, with their conformed columns, written as ``ano=<year>`` partitions
    (dynamic overwrite: a run for one year leaves the other years in place).

    ``years`` empty or None means every source; an unknown year is an error.
    Columns a year lacks are filled with ``fill`` (NULL by default; the
    source system used the text '0'), and so are those that ``replace``
    names for the year although it has them. ``columns`` (a year's header)
    saves its inference and has every file checked against it. ``account``
    keeps the texts that could not be read beside each row (``rejeitos``, for
    :func:`starloom.operators.reject_account`).
    """
    unknown = sorted(set(years or ()) - set(sources))
    if unknown:
        raise ValueError(f"no source for the years {unknown}; there are {sorted(sources)}")
    frames = []
    for year in sorted(years or sources):
        # the cases are chosen by the file's own columns, whatever is replaced
        cases = read_delimited(spark, sources[year], (columns or {}).get(year)).filter(star.srag_case_filter(scope))
        aligned = align_columns(cases, V.SRAG_COLUMNS, fill, replace=(replace or {}).get(year, ()))
        frames.append(aligned.withColumn("ano", F.lit(str(year))))
    return write_counted(star.conform_srag(union_aligned(frames, [*V.SRAG_COLUMNS, "ano"]), account), out, partition_by=["ano"])


def build_deaths_fact(spark: SparkSession, prestructured: str, out: str, max_files: int | None = None,
                      scope: star.Scope = star.DEFAULT_SCOPE) -> None:
    """``max_files``: optional output file cap (the source system used
    ``vocab.MAX_FILES_FACT``); leave unset at scale. The layer stores the
    conformed columns, so every filter reaches its scan."""
    cases = read_layer(spark, prestructured, {"ano": "string"})
    write_parquet(build_fact(cases, star.deaths_fact_spec(scope)), out, max_files=max_files)


def build_notification_fact(spark: SparkSession, raw: str | Sequence[str], out: str,
                            max_files: int | None = None, columns: Sequence[str] | None = None,
                            scope: star.Scope = star.DEFAULT_SCOPE) -> None:
    rows = star.conform_notification(read_delimited(spark, raw, columns), scope)
    write_parquet(build_fact(rows, star.notification_fact_spec(scope)), out, max_files=max_files)


def build_population(spark: SparkSession, census: str | Sequence[str], out: str,
                     max_files: int | None = None, scope: star.Scope = star.DEFAULT_SCOPE) -> dict[str, str]:
    """Census export -> population fact; plus the age dimension of the scope."""
    base = out.rstrip("/")
    fact = star.population_fact(star.conform_census(read_positional(spark, census, V.CENSUS_COLUMNS)), scope)
    write_parquet(fact, f"{base}/fato_populacao", max_files=max_files)
    ages = star.age_dim(int_spine(spark, scope.age_min, scope.age_max, "cod_idade"))
    write_parquet(ages, f"{base}/dm_faixa_etaria")
    return {"fato_populacao": f"{base}/fato_populacao", "dm_faixa_etaria": f"{base}/dm_faixa_etaria"}


def build_calendar(spark: SparkSession, out: str, start: str = V.CALENDAR_START,
                   end: str = V.CALENDAR_END) -> None:
    write_parquet(star.calendar_dim(day_spine(spark, start, end)), out)

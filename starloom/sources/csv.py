"""Delimited-text scans of raw extracts. Every column is read as text."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..plans.vocab import PART_TOKEN  # noqa: F401  (re-exported default)


def string_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    *,
    sep: str = ";",
    encoding: str = "UTF-8",
    part_token: str | None = None,
    token_column: str = "parte",
    token_source: str = "file_name",
    file_column: str | None = None,
    root: str | None = None,
    files: DataFrame | None = None,
    check_header: bool = True,
) -> DataFrame:
    """Header CSV scan (one file, a glob or a list), all columns text.

    Files are checked against the header (``enforceSchema=false``): a file
    whose columns come in another order fails the read instead of being
    read by position. With ``columns`` the scan reads that named schema, so
    no inference pass over the data is made.

    ``part_token`` is a regex with one group applied to each row's source
    file name (``_metadata.file_name``, or the full ``file_path`` when
    ``token_source='file_path'``), adding ``token_column``: one scan over
    all files replaces a loop over a file listing. A file whose name has no
    token fails the read, naming the file. ``file_column`` adds the source
    file's name, or its path (see :func:`with_source`). ``files`` gives these
    columns instead, found once a file (see :func:`with_listed`).
    ``check_header=False``: the caller knows that every file has ``columns``
    in this order, however it spells them.
    """
    reader = (spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
              .option("enforceSchema", not check_header).option("mode", "PERMISSIVE"))
    if columns is not None:
        reader = reader.schema(string_schema(columns))
    df = reader.csv(path if isinstance(path, str) else list(path))
    if files is not None:
        return with_listed(df, files)
    return with_source(df, part_token, token_column, token_source, file_column, root)


def file_path() -> Column:
    """The source file's path as it is written (``_metadata`` has it as a
    URL; only a path with escapes is decoded)."""
    url = F.col("_metadata.file_path")
    decoded = F.url_decode(F.replace(url, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(url, F.lit("%")), decoded).otherwise(url)


def exactly(path: str) -> str:
    """A path that is read as it is, not as a glob."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def path_below(spark: SparkSession, path: Column, root: str) -> Column:
    """``path`` without its scheme, below ``root`` ('' for no root). A path
    that is not below it fails the read, naming the path. (Plain searches,
    no patterns: this runs for every row.)"""
    if not root:
        return F.ltrim(F.substr(path, F.instr(path, ":/") + 1), F.lit("/"))
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(root)
    whole = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()
    prefix = whole.split(":", 1)[1].rstrip("/") + "/"
    at = F.instr(path, prefix)
    return F.when(at > 0, F.substr(path, at + F.lit(len(prefix)))).otherwise(
        F.raise_error(F.concat(F.lit("not below the root: "), path)).cast("string"))


def with_source(df: DataFrame, part_token: str | None, token_column: str = "parte",
                token_source: str = "file_name", file_column: str | None = None, root: str | None = None) -> DataFrame:
    """``df`` (a file scan) with the part token and the name of its files, or
    their path below ``root`` (the whole path if that is '')."""
    added = {}
    if part_token is not None:
        source = F.col(f"_metadata.{token_source}")
        token = F.regexp_extract(source, part_token, 1)
        added[token_column] = F.when(token != "", token).otherwise(
            F.raise_error(F.concat(F.lit("no part token in the file name "), source)).cast("string"))
    if file_column is not None:
        added[file_column] = (F.col("_metadata.file_name") if root is None
                              else path_below(df.sparkSession, file_path(), root))
    return df.withColumns(added) if added else df


def with_listed(df: DataFrame, files: DataFrame) -> DataFrame:
    """``df`` (a file scan) with the columns that ``files`` has beside ``url``
    (a file's path as ``_metadata`` gives it): a lookup in one row a file in
    place of searches in each row's path. A row of a file that is not among
    them fails the read."""
    added = [c for c in files.columns if c != "url"]
    known = files.select(F.col("url").alias("_url"), F.struct(*added).alias("_file"))
    found = df.withColumn("_path", F.col("_metadata.file_path")).join(F.broadcast(known), F.col("_path") == F.col("_url"), "left")
    lost = F.raise_error(F.concat(F.lit("not a listed file: "), F.col("_path"))).cast("string")
    return found.select(*df.columns, *[F.when(F.col("_file").isNull(), lost).otherwise(F.col(f"_file.{c}")).alias(c) for c in added])


def list_files(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """The files of a path, a glob or a list of them (names only are read)."""
    found = spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path)).select("path")
    return sorted(r["path"] for r in found.collect())


def file_heads(spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """``file, head``: the first line of every file that has any, in one job.

    The executors read the files' first blocks as text, and each task keeps
    the first line that it meets of a file: it is the file's first, since one
    task reads a block from its start. The second aggregate has Spark keep
    these lines in a hash map; with ``first`` alone it would sort all lines.
    """
    lines = (spark.read.option("encoding", encoding).text(path if isinstance(path, str) else list(path))
             .where("_metadata.file_block_start = 0").select(file_path().alias("file"), "value"))
    heads = lines.groupBy("file").agg(F.first("value").alias("head"), F.collect_set(F.lit(1)).alias("seen"))
    return heads.where(F.size("seen") == 1).select("file", F.regexp_replace("head", "^\uFEFF", "").alias("head"))


def header_groups(spark: SparkSession, path: str | Sequence[str], sep: str = ";",
                  encoding: str = "UTF-8") -> list[tuple[list[str], list[str]]]:
    """The distinct headers, each with its files. Names that differ in letter
    case, surrounding blanks or a byte order mark are one; the spelling is
    that of the first file. Only headers and file names reach the driver."""
    found = file_heads(spark, path, encoding).groupBy("head").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    groups: dict[tuple[str, ...], tuple[list[str], list[str]]] = {}
    for row in sorted(found, key=lambda r: r["files"][0]):
        names = [n.strip() for n in next(csv.reader([row["head"].rstrip("\r")], delimiter=sep, skipinitialspace=True), [])]
        folded = tuple(n.lower() for n in names)
        if len(set(folded)) < len(folded):
            raise ValueError(f"{row['files'][0]} names a column twice: {names}")
        groups.setdefault(folded, (names, []))[1].extend(row["files"])
    return list(groups.values())


def read_by_header(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    *,
    sep: str = ";",
    encoding: str = "UTF-8",
    **source,
) -> DataFrame:
    """Header CSV scan of files whose columns differ in order, number or
    spelling.

    The header lines are read first, in one job (:func:`header_groups`);
    files of one header are one scan, and the scans are united by name,
    letter case aside. ``columns`` picks and orders the result, a column that
    a file lacks being NULL; by default it is every column, in the order and
    spelling of the first file that has it. Files without any line give no
    rows. ``source``: as for :func:`read_delimited`.
    """
    groups = header_groups(spark, path, sep, encoding)
    if not groups:
        raise ValueError(f"no files with a header at {path}")
    spelled: dict[str, str] = {}
    for names, _ in groups:
        for name in names:
            spelled.setdefault(name.lower(), name)
    wanted = list(columns) if columns is not None else list(spelled.values())
    scans = []
    for names, files in groups:
        scan = read_delimited(spark, [exactly(f) for f in files], names, sep=sep, encoding=encoding, check_header=False, **source)
        added = [c for c in scan.columns if c not in names]
        have = {c.lower() for c in names}
        scans.append(scan.select(*[F.col(f"`{c}`").alias(c) if c.lower() in have else F.lit(None).cast("string").alias(c) for c in wanted], *added))
    return reduce(DataFrame.unionByName, scans)


def read_positional(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str],
    *,
    sep: str = ";",
    encoding: str = "UTF-8",
) -> DataFrame:
    """Headerless CSV scan that names columns by position.

    For exports that carry title lines above the header and notes below the
    data: those lines parse into rows too (missing fields are NULL), so the
    caller's row predicate drops them -- no line has to be skipped by
    position, and the file splits across tasks like any other CSV.
    """
    return (spark.read.schema(string_schema(columns)).option("header", False).option("sep", sep)
            .option("encoding", encoding).option("mode", "PERMISSIVE")
            .csv(path if isinstance(path, str) else list(path)))

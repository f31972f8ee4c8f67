"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import os
import uuid
import weakref
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.sources.scratch import shared_root


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from the driver's path.

    On a cluster whose workers have the package installed (or got it with
    ``--py-files``) this changes nothing.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), root) if x)
    return spark


def write_cut(df: DataFrame, name: str, kept: bool = False) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.
    ``kept``: it outlives a ``passing`` around it.

    Cuts the lineage with a table that outlives any executor. The columns
    keep their names and types.
    """
    path = f"{shared_root(df.sparkSession)}/starloom-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    if _WITHIN and not kept:
        _WITHIN[-1].append(path)
    _CUTS[id(out)] = (weakref.ref(out, lambda _, key=id(out): _CUTS.pop(key, None)), path)
    return out


#: Tables of ``write_cut`` by the identity of their DataFrame.
_CUTS: dict[int, tuple[weakref.ref, str]] = {}


def drop_cut(*tables: DataFrame) -> None:
    """Delete tables that ``write_cut`` returned. Only for those whose every
    reader has been written itself: nothing reads them again, not even to
    recover a lost executor's work."""
    for table in tables:
        _delete(table.sparkSession, _CUTS.pop(id(table))[1])


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


#: Paths of the tables written within each open ``passing``.
_WITHIN: list[list[str]] = []


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables of ``write_cut`` that are written inside are deleted at the
    end: what is built from them must have been written by then, elsewhere."""
    _WITHIN.append([])
    try:
        yield
    finally:
        for path in _WITHIN.pop():
            _delete(spark, path)


# What Python workers keep between tasks. Spark uses a worker again for the
# next stage, whose operator has no use for the memos of the one before.
_FORGET: dict[str, Callable[[], None]] = {}
_OWNER: list[str | None] = [None]


def keeps(owner: str, forget: Callable[[], None]) -> None:
    """``forget`` frees what the module ``owner`` keeps in a worker."""
    _FORGET[owner] = forget


def begin(owner: str) -> None:
    """Called by a task of ``owner``: what others keep in this worker is
    freed, and the memory given back to the system."""
    if _OWNER[0] == owner:
        return
    _OWNER[0] = owner
    for other, forget in _FORGET.items():
        if other != owner:
            forget()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it keeps what it has
        pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions (sized with the data by
    whoever runs the job)."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(col: str):
    """Text as bytes; null counts as empty."""
    return F.coalesce(F.col(col), F.lit("")).cast("binary")


def even_labels(spark: SparkSession) -> list[int]:
    """One label for each shuffle partition: rows that ``repartition`` deals
    by these labels fill every partition, one label each."""
    n = partitions(spark)
    found = spark.range(24 * n + 200, numPartitions=1).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("p")).agg(F.min("id").alias("id")).collect()
    return [r["id"] for r in sorted(found, key=lambda r: r["p"])]


def ddl(df: DataFrame, *more: str) -> str:
    """The columns of ``df`` and further ones as a schema string."""
    return ", ".join([f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields] + list(more))


def free(name: str, taken: Sequence[str]) -> str:
    """``name``, with as many ``_`` before it as it takes to be new."""
    while name in taken:
        name = "_" + name
    return name

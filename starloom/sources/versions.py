"""Atomic replacement: staged versions, and a pointer that readers resolve.

A writer puts a new version into a folder of its own and then commits it: one
small file, moved into ``_versoes`` under the next number. Readers take the
highest number there, so they see the old version whole until the moment of
the commit and the new one whole after it. A writer that fails leaves a
folder that no number names. Two writers that started from one version want
the same number; the second is refused.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from .scratch import path_exists
from .sinks import write_parquet

_NUMBERS = "_versoes"


def _hadoop(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def current(spark: SparkSession, base: str) -> tuple[int, dict]:
    """The number of the version in force and what its writer noted; (0, {})
    before the first."""
    folder = f"{base.rstrip('/')}/{_NUMBERS}"
    if not path_exists(spark, folder):
        return 0, {}
    path, fs = _hadoop(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    number = max((int(n) for n in names if n.isdigit()), default=0)
    if not number:
        return 0, {}
    stream = fs.open(_hadoop(spark, f"{folder}/{number:012d}")[0])
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return number, json.loads(text)


def commit(spark: SparkSession, base: str, number: int, note: dict) -> None:
    """Put version ``number`` in force (the one after the current)."""
    folder = f"{base.rstrip('/')}/{_NUMBERS}"
    path, fs = _hadoop(spark, f"{folder}/{number:012d}")
    staged, _ = _hadoop(spark, f"{folder}/.{uuid.uuid4().hex}")
    stream = fs.create(staged, False)
    try:
        stream.write(bytearray(json.dumps(note).encode()))
    finally:
        stream.close()
    if fs.exists(path) or not fs.rename(staged, path):
        fs.delete(staged, False)
        raise RuntimeError(f"version {number} of {base} was committed by another writer")


def stage(number: int) -> str:
    """A fresh folder name for the files of version ``number``."""
    return f"{number:012d}-{uuid.uuid4().hex[:8]}"


def replace_parquet(df: DataFrame, base: str, **options) -> int:
    """Replace the table at ``base`` by ``df`` (options: those of
    :func:`write_parquet`). Readers see the old rows or the new ones, never a
    mixture, and a failed write changes nothing. Returns the version."""
    spark, base = df.sparkSession, base.rstrip("/")
    number = current(spark, base)[0] + 1
    folder = stage(number)
    write_parquet(df, f"{base}/{folder}", **options)
    commit(spark, base, number, {"folder": folder})
    return number


def read_replaced(spark: SparkSession, base: str) -> DataFrame:
    """The version in force of a table that :func:`replace_parquet` writes."""
    number, note = current(spark, base)
    if not number:
        raise ValueError(f"no version of a table at {base}")
    return spark.read.parquet(f"{base.rstrip('/')}/{note['folder']}")


def prune(spark: SparkSession, base: str, keep: int = 1) -> list[str]:
    """Delete the folders of all versions of a replaced table but the last
    ``keep``, those of failed writers among them; returns their names. Only
    when no reader or writer is at work on an older version."""
    base = base.rstrip("/")
    number, note = current(spark, base)
    path, fs = _hadoop(spark, base)
    folders = sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory() and s.getPath().getName() != _NUMBERS)
    gone = [f for f in folders if f != note.get("folder") and int(f.split("-")[0]) <= max(number - keep, 0)
            or f != note.get("folder") and int(f.split("-")[0]) == number]
    for folder in gone:
        fs.delete(_hadoop(spark, f"{base}/{folder}")[0], True)
    return gone

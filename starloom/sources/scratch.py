"""Shared scratch locations for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Intermediate tables go there because every executor can read it. A local
    session that names none (tests, a laptop) gets a fresh local folder,
    kept for the session; on a cluster a missing setting is an error, since
    a folder of one machine would leave each executor with its own part.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = context.getCheckpointDir()
        if not root:
            context.setCheckpointDir(tempfile.mkdtemp(prefix="starloom-ckpt-"))
            root = context.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root for one run's table."""
    return f"{shared_root(spark)}/starloom/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables of this run that nothing reads any more. Only
    paths that :func:`scratch_path` made are accepted."""
    base = f"{shared_root(spark)}/starloom/"
    for path in paths:
        if not path.startswith(base) or "/" in path[len(base):]:
            raise ValueError(f"not a scratch table: {path}")
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Writes in this block delete their shuffle files when they end. Without
    it the files of finished writes stay until the driver's JVM happens to
    collect their plans, so the disk holds those of every step at once. The
    session's own setting is put back at the end; a Spark that does not know
    the setting (before 4.1) keeps the files as before."""
    before = spark.conf.get(_RELEASE, None)
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_RELEASE)
        else:
            spark.conf.set(_RELEASE, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in whatever store Spark resolves it to."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)

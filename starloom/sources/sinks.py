"""Parquet sinks: full refresh, partitioned (dynamic) overwrite, counted writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

#: Layers and states hold every raw column, many of them ids: about half of snappy's size.
LAYER_CODEC = "zstd"


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] | None = None,
    max_files: int | None = None,
    max_records_per_file: int | None = None,
    sort_within: Sequence[str] = (),
    compression: str | None = None,
) -> None:
    """Overwrite ``path`` with ``df`` as Parquet.

    * Unpartitioned: full refresh of the table directory.
    * ``partition_by``: one ``col=value`` directory per value, and only the
      partitions present in ``df`` are replaced (dynamic overwrite), so a
      re-run of one part or year leaves the others alone.
    * ``max_files`` caps the files (of each partition): the rows are dealt by
      their hash to at most so many groups, in a shuffle of its own, so the
      stage that computes ``df`` keeps all its tasks. AQE joins groups that
      are small, so the cap never raises the file count. Leave it unset at
      scale; ``max_records_per_file`` bounds file size instead.
    * ``sort_within`` sorts each task's rows (no shuffle), so that row groups
      hold few values of these columns and filters on them skip the others.
    * ``compression``: the files' codec, by default the session's.
    """
    out = df
    if max_files:
        hashed = [f"`{f.name}`" for f in df.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
        out = df.repartition(F.pmod(F.xxhash64(*hashed), F.lit(max_files))) if hashed else df.coalesce(max_files)
    if sort_within:
        out = out.sortWithinPartitions(*(partition_by or ()), *sort_within)
    writer = out.write.mode("overwrite").format("parquet")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.save(path)


def write_counted(df: DataFrame, path: str, **kwargs) -> int:
    """Write like :func:`write_parquet` and return the number of rows written,
    observed during the write itself (no second pass over the input)."""
    obs = Observation("written")
    write_parquet(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, **kwargs)
    return int(obs.get["rows"])

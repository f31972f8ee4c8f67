"""Incremental raw-file ingest with Structured Streaming.

The batch ingest rescans every raw file on each run. Here the file source
keeps, in its checkpoint, the set of files already processed: each run
(``availableNow``) conforms only the files that arrived since the last one
and the Parquet file sink commits each micro-batch exactly once. A run that
dies midway restarts from the checkpoint without duplicating rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.csv import PART_TOKEN, string_schema, with_source
from ..sources.scratch import path_exists


def raw_csv_stream(spark: SparkSession, source_dir: str, columns: Sequence[str], *,
                   sep: str = ";", glob: str = "*.csv", part_token: str | None = PART_TOKEN,
                   token_column: str = "parte", max_files_per_trigger: int | None = 1000) -> DataFrame:
    """Streaming scan of header CSV files dropped into ``source_dir``.

    ``max_files_per_trigger`` splits a large backlog into micro-batches:
    each one commits on its own, so a failure repeats one batch, not the run.
    """
    reader = (spark.readStream.schema(string_schema(columns)).option("header", True).option("sep", sep)
              .option("enforceSchema", False).option("pathGlobFilter", glob))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_source(reader.csv(source_dir), part_token, token_column)


def ingest_new_files(spark: SparkSession, source_dir: str, columns: Sequence[str],
                     conform: Callable[[DataFrame], DataFrame], out: str, *,
                     checkpoint: str | None = None, partition_by: Sequence[str] = ("parte",),
                     **scan_options) -> StreamingQuery:
    """Conform every not-yet-seen raw file into the partitioned Parquet layer
    at ``out`` and stop when the backlog is drained. The checkpoint is the
    sibling folder ``<out>_checkpoint`` unless given, so every session finds
    the same one. ``out`` belongs to the stream: its ``_spark_metadata`` log
    names the committed files (readers see only those), so batch writes must
    not target the same folder. An ``out`` that a stream has written without
    its checkpoint is refused: a new checkpoint would number its batches
    from 0 again, and the sink would skip them as already committed. A
    failed batch raises here."""
    base = out.rstrip("/")
    ckpt = checkpoint or f"{base}_checkpoint"
    if path_exists(spark, f"{base}/_spark_metadata") and not path_exists(spark, f"{ckpt}/commits"):
        raise ValueError(f"{base} was written by a stream whose checkpoint is not at {ckpt}")
    rows = conform(raw_csv_stream(spark, source_dir, columns, **scan_options))
    query = (rows.writeStream.format("parquet").option("checkpointLocation", ckpt)
             .partitionBy(*partition_by).trigger(availableNow=True).start(base))
    query.awaitTermination()
    return query

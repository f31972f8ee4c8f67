"""Parquet layer scans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType

_TYPES = {"string": StringType(), "int": IntegerType(), "bigint": LongType(), "date": DateType()}


def read_layer(spark: SparkSession, base: str, partition_types: Mapping[str, str] | None = None) -> DataFrame:
    """Read a Parquet table directory, including its ``key=value`` partition
    sub-directories (one scan = the union of all parts/years, with partition
    pruning on filters over the partition columns).

    ``partition_types`` pins partition column types, e.g. ``{'parte': 'string'}``
    so a part token ``'00007'`` is not inferred as the int 7.
    """
    if not partition_types:
        return spark.read.parquet(base)
    inferred = spark.read.parquet(base).schema
    fields = []
    for f in inferred.fields:
        if f.name in partition_types:
            fields.append(StructField(f.name, _TYPES[partition_types[f.name]], True))
        else:
            fields.append(f)
    return spark.read.schema(StructType(fields)).parquet(base)

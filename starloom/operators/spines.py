"""Generated key spines: days and integers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _days(lo: Column, hi: Column, name: str) -> Column:
    return F.explode(F.sequence(lo, hi, F.expr("interval 1 day"))).alias(name)


def day_spine(spark: SparkSession, start: str, end: str, name: str = "data") -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive (dates)."""
    return spark.range(1).select(_days(F.to_date(F.lit(start)), F.to_date(F.lit(end)), name))


def day_spine_over(df: DataFrame, column: str, name: str = "data") -> DataFrame:
    """One row per day between the first and last date of ``df[column]``.

    A global min/max (partial per partition, then one tiny final row) followed
    by a generator: the output size is the number of days in the span, not a
    function of the row count.
    """
    d = F.to_date(F.col(column))
    bounds = df.agg(F.min(d).alias("lo"), F.max(d).alias("hi"))
    return bounds.select(_days(F.col("lo"), F.col("hi"), name))


def int_spine(spark: SparkSession, lo: int, hi: int, name: str) -> DataFrame:
    """Integers ``lo`` .. ``hi`` inclusive as an int column."""
    return spark.range(lo, hi + 1).select(F.col("id").cast("int").alias(name))

"""Align frames whose columns drift from year to year to one canonical list."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def align_columns(df: DataFrame, canonical: Sequence[str], fill=None, fill_type: str = "string",
                  replace: Sequence[str] = ()) -> DataFrame:
    """Select ``canonical`` in order; columns the frame lacks are created with
    ``fill`` (default: a typed NULL, so 'absent' is not mistaken for a value).
    Those in ``replace`` get ``fill`` even where the frame has them. Name
    matching is case-insensitive, as Spark resolves names."""
    have = {c.lower() for c in df.columns} - {c.lower() for c in replace}
    filled = {c: F.lit(fill).cast(fill_type) for c in canonical if c.lower() not in have}
    return df.withColumns(filled).select(*canonical)


def union_aligned(frames: Sequence[DataFrame], canonical: Sequence[str], fill=None,
                  fill_type: str = "string", replace: Sequence[str] = ()) -> DataFrame:
    """Align every frame to ``canonical`` and union them by name (no shuffle)."""
    if not frames:
        raise ValueError("no frames to unite")
    aligned = [align_columns(f, canonical, fill, fill_type, replace) for f in frames]
    return reduce(lambda a, b: a.unionByName(b), aligned)

"""From candidate groups to links, link counts and components.

Used by the operators on pairs: groups of possible partners are cut into
blocks of bounded size, every pair of blocks is one unit of work, and a unit
hands back one row per linked member instead of one per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import drop_cut, write_cut

#: Members of a block; a unit of work holds two blocks at most.
BLOCK = 512


def in_blocks(members: DataFrame, size: str, key: str, block: int | None = None) -> DataFrame:
    """``members`` of groups (``size``: the group's) with ``own, lo, hi``:
    the member's block and, a row each, the block pairs that it takes part
    in. A group of one block has the pair (0, 0) alone."""
    n = F.ceil(F.col(size) / (block or BLOCK)).cast("int")
    own = members.withColumn("_n", n).withColumn("own", F.when(F.col("_n") > 1, F.pmod(F.xxhash64(F.lit(7), key), F.col("_n"))).otherwise(0).cast("int"))
    own = own.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return own.withColumn("lo", F.least("own", "_other")).withColumn("hi", F.greatest("own", "_other")).drop("_n", "_other")


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of rows that are sorted by ``keys`` (not null), across
    batches. A group that many batches hold is put together once."""
    held: list[pa.RecordBatch] = []
    last: list | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        changed = np.zeros(batch.num_rows - 1, bool)
        for key in keys:
            values = batch.column(key).to_numpy(zero_copy_only=False)
            changed |= values[1:] != values[:-1]
        starts = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
        first = [batch.column(key)[0].as_py() for key in keys]
        for at, end in zip(starts, starts[1:]):
            if held and (at > 0 or first != last):
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(at, end - at))
        last = [batch.column(key)[batch.num_rows - 1].as_py() for key in keys]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def block_pairs(own: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all pairs within a block, or between two."""
    if lo == hi:
        i, j = np.triu_indices(len(own), 1)
        return i, j
    a, b = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
    return np.repeat(a, len(b)), np.tile(b, len(a))


def local_links(ids: list[bytes], counts: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[bytes, int, bytes]]:
    """One row per linked member of a unit: its id, the documents it links
    with here, and the least id that it reaches here."""
    links = np.zeros(len(ids), np.int64)
    np.add.at(links, i, counts[j])
    np.add.at(links, j, counts[i])
    parent = list(range(len(ids)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in zip(i.tolist(), j.tolist()):
        a, b = root(a), root(b)
        if a != b:
            if ids[b] < ids[a]:
                a, b = b, a
            parent[b] = a
    return [(ids[x], int(links[x]), ids[root(x)]) for x in np.flatnonzero(links).tolist()]


LINKED = pa.schema([("id", pa.binary()), ("links", pa.int64()), ("least", pa.binary())])


def linked_batch(rows: list[tuple[bytes, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], LINKED.field(k).type) for k in range(3)], schema=LINKED)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``id, component``: the least id that each end of an edge reaches.

    ``edges``: ``a, b`` of one orderable type. Alternates large-star and
    small-star steps, each a min by key and a join, until nothing changes.
    Every round is a written table; only its row count and checksum come to
    the driver. A null end or a self-loop is no edge.
    """
    now = write_cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    mark = None
    for _ in range(max_rounds):
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("u")).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        hung = large.join(small, F.col("a") == F.col("u"))
        before, now = now, write_cut(
            hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct(), "components")
        drop_cut(before)
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).collect()[0]
        if tuple(seen) == mark:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
        mark = tuple(seen)
    raise RuntimeError(f"components still change after {max_rounds} rounds")

"""Embedding near-dedup by a random-projection tree forest.

Each tree splits its nodes at the median of a random projection, level by
level over all vectors, until a node is small. The two sides overlap (spill)
by a margin, so that close vectors part only rarely, and the trees of the
forest part them independently. Vectors are compared in double precision
within the leaves; a pair that meets in several leaves counts in one.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import drop_cut, write_cut
from starloom.llm.links import block_pairs, components, groups, in_blocks, linked_batch, local_links

THRESHOLD = 0.98
TREES = 6
#: A node of so many distinct vectors at most is a leaf.
LEAF = 1024
#: Half the overlap of two sides, in standard deviations of the projected
#: distance of two unit vectors at the threshold.
SPILL = 0.75
#: A node whose two sides together would hold more than so many times its
#: members is a leaf of any size.
GROWTH = 1.3
#: Levels after which a node is a leaf whatever its size.
MAX_LEVELS = 48


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as doubles with a fingerprint; null where nothing can link."""
    for batch in batches:
        fp, vec, dim = [], [], []
        for label, v in zip(batch.column(1).to_pylist(), batch.column(2)):
            x = None if label is None or not v.is_valid or v.values.null_count or not len(v.values) else v.values.to_numpy(zero_copy_only=False).astype("<f8")
            if x is None or not np.isfinite(x).all() or not x.any():
                fp.append(None), vec.append(None), dim.append(None)
                continue
            x = x + 0.0  # one zero
            name = str(label).encode()
            fp.append(hashlib.blake2b(len(name).to_bytes(8, "little") + name + x.tobytes(), digest_size=16).digest())
            vec.append(x.tobytes())
            dim.append(len(x))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(fp, pa.binary()), pa.array(dim, pa.int32()), pa.array(vec, pa.binary())],
            ["vec_id", "label", "fp", "dim", "vec"])


def direction(node: int, dim: int) -> np.ndarray:
    """A node's random unit vector."""
    d = np.random.Generator(np.random.PCG64(node & 0xFFFFFFFFFFFFFFFF)).standard_normal(dim)
    return d / np.linalg.norm(d)


def _projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes = batch.column(1).to_numpy()
        vecs = batch.column(2)
        out, dim = np.zeros(len(nodes)), np.zeros(len(nodes), np.int32)
        kinds, at = np.unique(nodes, return_inverse=True)
        order = np.argsort(at, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
            if len(rows):
                x = np.frombuffer(b"".join(vecs[r].as_py() for r in rows.tolist()), "<f8").reshape(len(rows), -1)
                dim[rows] = x.shape[1]
                out[rows] = x @ direction(int(nodes[rows[0]]), x.shape[1]) / np.linalg.norm(x, axis=1)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out), pa.array(dim)], ["fp", "node", "at", "dim"])


def leaves(vectors: DataFrame, trees: int, leaf: int) -> DataFrame:
    """``fp, leaf, members``: the leaves of the forest over ``vectors``
    (``fp, label, dim, vec``, distinct), every vector in each tree.

    One level a round: project, take each node's median, split the nodes
    that are too large. A node whose vectors lie so close that its two sides
    together would hold more than GROWTH times its members is a leaf of any
    size (and compared in blocks, which is cheaper than splitting it).
    """
    roots = vectors.select("fp", F.explode(F.transform(F.sequence(F.lit(1), F.lit(trees)), lambda t: F.xxhash64(t, "label", "dim"))).alias("node"))
    half = SPILL * math.sqrt(2 * (1 - THRESHOLD))
    done, now = [], write_cut(roots, "forest-nodes")
    spent = [now]
    for level in range(MAX_LEVELS + 1):
        sizes = now.groupBy("node").agg(F.count("*").alias("members"))
        if level == MAX_LEVELS:
            done.append(now.join(sizes, "node").select("fp", F.col("node").alias("leaf"), "members"))
            break
        sized = write_cut(now.join(sizes, "node"), "forest-sized")
        done.append(sized.where(F.col("members") <= leaf).select("fp", F.col("node").alias("leaf"), "members"))
        large = sized.where(F.col("members") > leaf)
        if large.isEmpty():
            spent.append(sized)
            break
        placed = large.join(vectors.select("fp", "vec"), "fp").select("fp", "node", "vec").mapInArrow(_projected, "fp binary, node long, at double, dim int")
        placed = write_cut(placed, "forest-placed")
        spent += [sized, placed]
        cut = placed.groupBy("node").agg(F.count("*").alias("members"), F.percentile_approx("at", 0.5, 2000).alias("q"))
        margin = F.lit(half) / F.sqrt(F.lit(1.0) * F.col("dim"))
        left, right = F.col("at") <= F.col("q") + F.col("margin"), F.col("at") > F.col("q") - F.col("margin")
        split = placed.join(cut, "node").withColumn("margin", margin).withColumn("left", left).withColumn("right", right)
        split = write_cut(split, "forest-split")
        spent.append(split)
        grown = split.groupBy("node").agg(F.sum((F.col("left") & F.col("right")).cast("long")).alias("both"))
        told = split.join(grown, "node").withColumn("tight", F.col("both") > (GROWTH - 1) * F.col("members"))
        done.append(told.where("tight").select("fp", F.col("node").alias("leaf"), "members"))
        sides = F.array_compact(F.array(
            F.when(F.col("left"), F.xxhash64("node", F.lit(0))),
            F.when(F.col("right"), F.xxhash64("node", F.lit(1)))))
        now = write_cut(told.where("not tight").select("fp", F.explode(sides).alias("node")), "forest-nodes")
        spent.append(now)
    out = write_cut(reduce(DataFrame.unionByName, done), "forest-leaves")
    drop_cut(*spent)
    return out


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within a unit of work, of pairs that share no lesser leaf."""
    out: list[tuple[bytes, int, bytes]] = []
    for g in groups(batches, ["leaf", "lo", "hi"]):
        if g.num_rows < 2:
            continue
        leaf, lo, hi = (g.column(c)[0].as_py() for c in ("leaf", "lo", "hi"))
        x = np.frombuffer(b"".join(g.column("vec").to_pylist()), "<f8").reshape(g.num_rows, -1)
        norms = np.sqrt((x * x).sum(1))
        near = (x @ x.T) / np.outer(norms, norms) >= THRESHOLD
        i, j = block_pairs(g.column("own").to_numpy(), lo, hi)
        real = near[i, j]
        i, j = i[real], j[real]
        held = g.column("leaves").to_pylist()
        if len(i):
            lesser = [[x for x in h if x < leaf] for h in held]
            code = {v: c for c, v in enumerate({x for h in lesser for x in h})}
            width = max(1, max(map(len, lesser)))
            coded = np.array([[code[v] for v in h] + [-1 - k] * (width - len(h)) for k, h in enumerate(lesser)], np.int64)
            first = np.ones(len(i), bool)
            for at in range(0, len(i), 20_000):
                a, b = coded[i[at : at + 20_000]], coded[j[at : at + 20_000]]
                first[at : at + 20_000] = ~(a[:, :, None] == b[:, None, :]).any((1, 2))
            i, j = i[first], j[first]
        out += local_links(g.column("fp").to_pylist(), g.column("copies").to_numpy(), i, j)
        if len(out) >= 5000:
            yield linked_batch(out)
            out = []
    yield linked_batch(out)


def near_dedup(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
               trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Rows link if their labels are equal and not null and their vectors'
    cosine is 0.98 or more. Vectors that are null, empty, zero or hold null
    or non-finite components link with nothing, nor do vectors of different
    length. Equal vectors of a label are compared once. Repeated ids: every
    row counts; ``component_id`` is the least id of the rows that a row
    reaches. A null id names a component only where no row has one. No rows
    give no rows. Vectors of any length are compared whole; other columns are
    not read.
    """
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).cast("array<double>").alias("v"))
    clean = write_cut(rows.mapInArrow(_clean, "vec_id long, label string, fp binary, dim int, vec binary"), "near-clean")
    vectors = write_cut(
        clean.where("fp is not null").groupBy("fp").agg(F.min("vec_id").alias("name"), F.count("*").alias("copies"), F.min("label").alias("label"), F.min("dim").alias("dim"), F.min("vec").alias("vec")), "near-vectors")
    placed = leaves(vectors, trees, leaf)
    held = placed.groupBy("fp").agg(F.sort_array(F.collect_set("leaf")).alias("leaves"))
    unit = ["leaf", "lo", "hi"]
    members = in_blocks(placed.where("members > 1"), "members", "fp")
    members = members.join(held.join(vectors.select("fp", "copies", "vec"), "fp"), "fp").select(*unit, "own", "fp", "copies", "leaves", "vec")
    linked = write_cut(members.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(_compared, "id binary, links long, least binary"), "near-linked")

    drop_cut(placed)
    links = linked.groupBy("id").agg(F.sum("links").alias("links"))
    found = components(linked.select(F.col("id").alias("a"), F.col("least").alias("b")))
    named = write_cut(
        vectors.select("fp", "name", "copies").join(links, F.col("fp") == F.col("id"), "left").drop("id")
        .join(found, F.col("fp") == F.col("id"), "left").drop("id")
        .select("fp", "name", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "fp").alias("component")), "near-named")
    drop_cut(vectors, linked)
    heads = named.groupBy(F.col("component").alias("head")).agg(F.min("name").alias("component_id"))
    named = named.join(heads, F.col("component") == F.col("head")).select(F.col("fp").alias("_fp"), "n_links", "component_id")
    return clean.select("vec_id", "fp").join(named, F.col("fp") == F.col("_fp"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("_fp").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

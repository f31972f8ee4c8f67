"""Jaccard join, embedding neighbours and components against brute force."""

import math
import random
from itertools import combinations

import numpy as np
import pytest
from conftest import SF_SMALL
from llm_cases import CLASHING, EDGE, documents, roots, shingle_set

from pyspark.sql import functions as F
from starloom.llm import jaccard, links, neighbours
from starloom.llm.common import ship


def brute_join(rows):
    sets = [shingle_set(t) for _, t in rows]
    pairs = [(a, b) for a, b in combinations(range(len(rows)), 2)
             if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    linked = [0] * len(rows)
    for a, b in pairs:
        linked[a] += 1
        linked[b] += 1
    found = roots(len(rows), pairs)
    ids = {}
    for k, root in enumerate(found):
        ids.setdefault(root, []).append(math.inf if rows[k][0] is None else rows[k][0])
    return sorted(((i if i is not None else math.inf), min(ids[c]), n) for (i, _), c, n in zip(rows, found, linked))


def joined(docs):
    return sorted((math.inf if r["doc_id"] is None else r["doc_id"], math.inf if r["class_id"] is None else r["class_id"], r["n_links"])
                  for r in jaccard.join(docs).collect())


def test_join_equals_brute_force(spark):
    ship(spark)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert joined(docs) == brute_join([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_edge_rows(spark):
    ship(spark)
    assert joined(documents(spark, EDGE, extra=True)) == brute_join(EDGE)


def test_hot_near_group_in_blocks(spark, monkeypatch):
    """A third of the rows are near copies: blocks far smaller than the group lose no link."""
    ship(spark)
    monkeypatch.setattr(links, "BLOCK", 7)
    r = random.Random(1)
    words = [f"w{k}" for k in range(120)]
    rows = [(k, " ".join(r.choices(words, k=60))) for k in range(80)]
    for k in range(40):
        near = words[:]
        for _ in range(k % 4):
            near[r.randrange(120)] = f"x{r.randrange(10**6)}"
        rows.append((100 + k, " ".join(near)))
    assert joined(documents(spark, rows)) == brute_join(rows)


def test_join_of_nothing(spark):
    ship(spark)
    assert jaccard.join(documents(spark, EDGE).limit(0)).count() == 0
    assert joined(documents(spark, [(1, None), (2, "")])) == [(1, 1, 0), (2, 2, 0)]


def test_posterior_rule():
    """Few pairs at the threshold would be dropped at any step; clear misses are."""
    need = jaccard.least_matches()
    assert need[jaccard.HASHES] > 30
    for n in range(jaccard.STEP, jaccard.HASHES + 1, jaccard.STEP):
        lost = sum(math.comb(n, m) * 0.8**m * 0.2 ** (n - m) for m in range(need[n]))
        assert lost < 1e-5


def test_representatives_keep_one_row_of_each_class(spark):
    ship(spark)
    rows = EDGE + [(6, "another text of the same id, which nothing else is like")]
    kept = sorted((r["doc_id"] or -1, r["text"] or "") for r in jaccard.representatives(documents(spark, rows)).collect())
    assert kept == sorted({(i or -1, t or "") for i, t in rows if i != 7})


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = {r["id"]: r["component"] for r in links.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(31)}, **{k: 100 for k in range(100, 140)}}
    assert links.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_near(rows):
    pairs = []
    for a, b in combinations(range(len(rows)), 2):
        (_, x, l), (_, y, m) = rows[a], rows[b]
        if l is None or l != m or x is None or y is None or len(x) != len(y) or not x:
            continue
        if any(v is None or not math.isfinite(v) for v in (*x, *y)) or not any(x) or not any(y):
            continue
        x, y = np.array(x, np.float32).astype(float), np.array(y, np.float32).astype(float)
        if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= 0.98:
            pairs.append((a, b))
    linked = [0] * len(rows)
    for a, b in pairs:
        linked[a] += 1
        linked[b] += 1
    return sorted((rows[k][0], linked[k], rows[c][0]) for k, c in enumerate(roots(len(rows), pairs)))


def vectors(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return df.withColumns({c: F.lit("clash") for c in CLASHING}) if extra else df


def near(df, **more):
    return sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in neighbours.near_dedup(df, **more).collect())


def clustered(n, seed):
    g = np.random.default_rng(seed)
    centres = g.standard_normal((n // 6, 24))
    return [(k, (centres[g.integers(len(centres))] + g.standard_normal(24) * g.choice([0.05, 0.11, 0.3])).astype(np.float32).tolist(), k % 2) for k in range(n)]


def test_forest_of_many_levels_finds_all_links(spark):
    ship(spark)
    rows = clustered(400, 5)
    assert near(vectors(spark, rows), leaf=40) == brute_near(rows)


def test_tight_group_larger_than_a_leaf(spark, monkeypatch):
    """Vectors that no split parts are compared in blocks."""
    ship(spark)
    monkeypatch.setattr(links, "BLOCK", 16)
    g = np.random.default_rng(3)
    centre = g.standard_normal(24)
    rows = [(k, (centre + g.standard_normal(24) * 0.02).astype(np.float32).tolist(), 1) for k in range(90)]
    rows += [(1000 + k, g.standard_normal(24).astype(np.float32).tolist(), 1) for k in range(60)]
    assert near(vectors(spark, rows), leaf=20) == brute_near(rows)


def test_edge_vectors(spark):
    ship(spark)
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1),
            (7, [float("nan"), 1.0], 1), (8, [float("inf"), 1.0], 1), (9, [], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, None], 1), (12, [-1.0, -0.0], 1)]
    assert near(vectors(spark, rows, extra=True)) == brute_near(rows)
    assert neighbours.near_dedup(vectors(spark, rows).limit(0)).count() == 0
    null_id = neighbours.near_dedup(vectors(spark, [(None, [1.0, 0.0], 1), (3, [1.0, 0.0], 1)])).collect()
    assert {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in null_id} == {(None, 1, 3, False), (3, 1, 3, True)}


@pytest.mark.parametrize("rows", [[(0, [1.0, 0.1], 1)] * 3])
def test_repeated_rows_count_each(spark, rows):
    ship(spark)
    assert near(vectors(spark, rows)) == [(0, 2, 0)] * 3


def test_long_labels_are_told_apart():
    """Equal vectors whose labels differ after 64 bytes are two members."""
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(["x" * 64 + "a", "x" * 64 + "b", "x" * 64 + "a"]), pa.array([[1.0, 2.0]] * 3)], ["vec_id", "label", "vec"])
    fp = next(neighbours._clean(iter([batch]))).column(2).to_pylist()
    assert fp[0] == fp[2] != fp[1]


def test_dense_label_makes_few_copies_and_loses_no_link(spark):
    """Vectors of one label at pairwise cosine about 0.975: splitting would
    copy nearly all of them to both sides, so the node is a leaf."""
    ship(spark)
    r = np.random.default_rng(3)
    center = r.standard_normal(64)
    center /= np.linalg.norm(center)
    noise = r.standard_normal((6000, 64))
    vectors = center + noise / np.linalg.norm(noise, axis=1, keepdims=True) * math.sqrt(1 / 0.975 - 1)
    df = spark.createDataFrame([(k, v.tolist(), "one") for k, v in enumerate(vectors)], "vec_id long, embedding array<double>, label string")
    rows = df.select("vec_id", "label", F.col("embedding").alias("v"))
    clean = rows.mapInArrow(neighbours._clean, "vec_id long, label string, fp binary, dim int, vec binary")
    placed = neighbours.leaves(clean.select("fp", "label", "dim", "vec"), 2, 1024)
    assert placed.count() <= 2 * 2 * 6000
    found = {x["vec_id"]: x["n_links"] for x in neighbours.near_dedup(df, trees=2).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.98).sum(1) - 1
    assert near.sum() > 1000 and [found[k] for k in range(6000)] == near.tolist()


def test_recall_at_the_production_leaf_size(spark):
    """12,000 vectors of one label, many levels of leaves of 1024: the links
    found against brute force."""
    ship(spark)
    r = np.random.default_rng(4)
    base = r.standard_normal((9000, 64))
    near = base[:3000] + r.standard_normal((3000, 64)) * 0.17
    vectors = np.concatenate([base, near])
    df = spark.createDataFrame([(k, v.tolist(), "one") for k, v in enumerate(vectors)], "vec_id long, embedding array<double>, label string")
    found = {x["vec_id"]: x["n_links"] for x in neighbours.near_dedup(df).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    truth = (unit @ unit.T >= 0.98).sum(1) - 1
    assert truth.sum() > 2000
    assert sum(found.values()) >= 0.99 * truth.sum() and all(found[k] <= truth[k] for k in found)


@pytest.mark.parametrize("width", [64, 1 << 21])
def test_matrix_products_by_chunks_count_exactly(monkeypatch, width):
    monkeypatch.setattr(jaccard, "CHUNK_CELLS", width)
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 60, n)).astype(np.uint64) for n in (1, 5, 20, 40, 40, 60, 60)]
    sets += [sets[-1][:-1], sets[-2][1:]]
    i, j = np.triu_indices(len(sets), 1)
    plain = [5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b])) for a, b in zip(i, j)]
    assert jaccard.verified(sets, np.tile(i, 5), np.tile(j, 5)).tolist() == plain * 5

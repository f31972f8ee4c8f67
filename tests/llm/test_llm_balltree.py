"""Ranked search over ball trees: bounds, pruning, and results against plain scoring."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_cases import CLASHING, EDGE

from pyspark.sql import functions as F
from starloom.llm import balltree
from starloom.llm.common import ship


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    found = [(i, Counter(words(t))) for i, t in docs]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    n, size = len(found), sum(x for _, _, x in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, length in found:
            m = 100 - 75 + 75 * length * n // size
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in words(text) if t in c)
            if score > 0:
                scored.append((-score, math.inf if i is None else i))
        out += [(math.inf if item is None else item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def searched(spark, docs, items, extra=False, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    if extra:
        clash = {c: F.lit("clash") for c in [*CLASHING, "row", "pass", "group", "place", "item_id", "doc_id"]}
        d, i = (x.withColumns({c: v for c, v in clash.items() if c not in x.columns}) for x in (d, i))
    out = balltree.search(d, i, **kw)
    assert dict(out.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    return sorted((math.inf if r["item_id"] is None else r["item_id"], r["rank"], math.inf if r["doc_id"] is None else r["doc_id"], r["score"]) for r in out.collect())


def corpus(seed=3, n=400):
    r = random.Random(seed)
    kinds = [[f"{p}{k}" for k in range(120)] for p in ("a", "É", "漢", "Q9x")]
    docs = []
    for k in range(n):
        own = r.choice(kinds)
        docs.append((k, " ".join(own[min(int(r.expovariate(0.05)), 119)] for _ in range(r.choice((3, 40, 300))))))
    items = [(k, " ".join(r.choice(kinds)[int(r.random() ** 2 * 120)] for _ in range(12))) for k in range(30)]
    items += [(100 + k, docs[k * 7][1][:200]) for k in range(10)]
    return docs, items


def test_equals_plain_scoring(spark, monkeypatch):
    """Small trees: many of them a task, deep ones, thresholds carried over."""
    ship(spark)
    monkeypatch.setattr(balltree, "TREE", 64)
    monkeypatch.setattr(balltree, "LEAF", 4)
    docs, items = corpus()
    assert searched(spark, docs, items) == plain(docs, items)


def test_edges_ties_and_repeats(spark):
    ship(spark)
    docs = [*EDGE, *[(k, "tie word") for k in range(40, 20, -1)], *[(50, "tie word")] * 4, (None, "tie word"), (-3, "tie word")]
    items = [(1, "tie"), (1, "tie"), (2, "TIE tie word 123"), (3, None), (None, "documents漢字"), (4, ""), (5, "never seen"), (6, "the same words"), (7, "x 漢字 été")]
    assert searched(spark, docs, items, extra=True) == plain(docs, items)
    assert searched(spark, docs, items, k=3) == plain(docs, items, 3)


def test_hot_copies_over_many_tasks(spark):
    ship(spark)
    docs, items = corpus(5, 150)
    docs += [(1000 + k, docs[3][1]) for k in range(200)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(13)
    out = balltree.search(d, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(tuple(r) for r in out.collect()) == plain(docs, items)


def test_several_passes(spark, monkeypatch):
    ship(spark)
    monkeypatch.setattr(balltree, "ASKED", 700)
    docs, items = corpus(6, 120)
    assert searched(spark, docs, items) == plain(docs, items)


@pytest.mark.parametrize("docs, items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None), (2, "")], [(1, "a")])])
def test_nothing_to_find(spark, docs, items):
    ship(spark)
    assert searched(spark, docs, items) == []


def random_tree(seed, n=600):
    r = np.random.default_rng(seed)
    items = balltree.Items([(k, " ".join(f"t{x}" for x in r.integers(0, 80, r.integers(1, 25)) + 80 * (k % 4)).encode()) for k in range(25)])
    width = len(items.place)
    rows = []
    for k in range(n):
        own = np.sort(r.choice(width // 2, r.integers(1, 20), replace=False)) + (width // 2) * (k % 2)
        rows.append((own, r.integers(1, 3 * 10**10 if seed % 2 else 50, len(own))))
    rows += [rows[0]] * 40
    ptr = np.concatenate(([0], np.cumsum([len(t) for t, _ in rows])))
    return items, rows, balltree.Tree(items, ptr, np.concatenate([t for t, _ in rows]), np.concatenate([v for _, v in rows]), 8)


@pytest.mark.parametrize("seed", range(4))
def test_bounds_hold_and_leaves_score_exactly(seed):
    items, rows, tree = random_tree(seed)
    exact = np.zeros((len(items.ids), len(rows)), object)
    for q in range(len(items.ids)):
        span = slice(items.ptr[q], items.ptr[q + 1])
        asked = dict(zip(items.terms[span].tolist(), items.repeats[span].tolist()))
        for x, (own, value) in enumerate(rows):
            exact[q, x] = sum(asked.get(t, 0) * v for t, v in zip(own.tolist(), value.tolist()))
    below = {}
    for node in reversed(range(len(tree.children))):
        if tree.children[node] is None:
            below[node] = tree.leaves[node][0].tolist()
            for q in range(len(items.ids)):
                found, scores = tree.scores(node, q)
                assert scores.tolist() == [exact[q, x] for x in found.tolist()]
        else:
            below[node] = [x for c in tree.children[node] for x in below[c]]
        for q in range(len(items.ids)):
            assert max(exact[q, x] for x in below[node]) <= tree.bounds[node, q]
    assert sorted(below[0]) == list(range(len(rows)))


def test_subtrees_are_pruned():
    """Items about a tenth of the documents open few of the leaves."""
    r = np.random.default_rng(1)
    items = balltree.Items([(k, " ".join(f"g{k % 10}-{x}".replace("-", "x") for x in r.integers(0, 30, 12)).encode()) for k in range(40)])
    rows = []
    names = sorted(items.place, key=items.place.get)
    kinds = [np.array([items.place[n] for n in names if n.startswith(b"g%dx" % g)]) for g in range(10)]
    for k in range(2000):
        own = np.sort(r.choice(kinds[k % 10], min(10, len(kinds[k % 10])), replace=False))
        rows.append((own, r.integers(1, 1000, len(own))))
    ptr = np.concatenate(([0], np.cumsum([len(t) for t, _ in rows])))
    tree = balltree.Tree(items, ptr, np.concatenate([t for t, _ in rows]), np.concatenate([v for _, v in rows]), 16)
    opened = sum(tree.search(q, list(range(len(rows))), [], 10) for q in range(40))
    assert opened < 0.25 * 40 * len(tree.leaves)

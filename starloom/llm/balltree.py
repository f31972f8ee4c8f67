"""Ranked lexical search by exact inner products over sparse ball trees.

A document is the sparse vector of its term weights, an item (query) that of
its terms' repeats; the score is their inner product. Only coordinates that
some item has can count, so vectors hold these alone.

Each task builds ball trees over some thousand documents at a time: a node's
members are parted at the median between two far members, down to leaves. A
node keeps its centroid c, the radius r of the ball around it, and how far
its members reach beyond the centroid along each coordinate. No member d of
it scores more than

    q.d <= q.c + min(|q| r, sum of q_t reach_t)

(the second radius is the ball's in the query's own directions). The sums
are in doubles and rounded up by more than their error, so the bound is safe;
a search opens the subtrees best-first and ends where the bound falls below
the k-th score. Scores at the leaves are exact 64-bit integers. The best of a
task are carried from tree to tree, and the best of all tasks ranked.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm import divergence
from starloom.llm.common import utf8

#: Documents, and coordinates other than 0, of a tree.
TREE, ENTRIES = 4096, 1_000_000
#: Documents of a leaf.
LEAF = 32
#: Bytes of the items that are asked in one pass over the documents.
ASKED = 1 << 20
#: Groups in which the best of all tasks are ranked before they are ranked together.
GROUPS = 64
#: Relative rounding error that the bounds allow for (sums of up to a million
#: terms in doubles stay below a tenth of it).
SLACK = 1e-9

#: Every byte that is no part of a term becomes a blank; A-Z become a-z.
FOLD = bytes(b if 0x30 <= b <= 0x39 else other for b, other in enumerate(divergence.FOLD))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text: runs of ASCII letters (in lower case),
    digits and characters beyond ASCII."""
    return text.translate(FOLD).split()


def places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every run."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class Items:
    """The items of one pass: their terms are the coordinates."""

    def __init__(self, items: list[tuple[int | None, bytes]]) -> None:
        self.ids: list[int | None] = []
        self.rows: list[int] = []
        self.place: dict[bytes, int] = {}
        ptr, terms_, repeats = [0], [], []
        for row, (item, text) in enumerate(items):
            found = [self.place.setdefault(t, len(self.place)) for t in terms(text)]
            if not found:
                continue
            own, times = np.unique(np.array(found), return_counts=True)
            self.ids.append(item)
            self.rows.append(row)
            terms_.append(own)
            repeats.append(times)
            ptr.append(ptr[-1] + len(own))
        self.ptr = np.array(ptr)
        self.terms = np.concatenate([np.empty(0, np.int64), *terms_])
        self.repeats = np.concatenate([np.empty(0, np.int64), *repeats])
        self.norm = np.sqrt(np.add.reduceat(self.repeats.astype(float) ** 2, self.ptr[:-1])) if self.ids else np.empty(0)

    def dot(self, values: np.ndarray) -> np.ndarray:
        """The inner product of every item with a dense vector."""
        return np.add.reduceat(self.repeats * values[self.terms], self.ptr[:-1])


class Tree:
    """A ball tree over sparse rows, and what each item can reach in it."""

    def __init__(self, items: Items, ptr: np.ndarray, terms_: np.ndarray, values: np.ndarray, leaf: int) -> None:
        self.items, self.ptr, self.terms, self.values = items, ptr, terms_, values
        self.size = np.diff(ptr)
        self.square = np.add.reduceat(values.astype(float) ** 2, ptr[:-1])
        self.children: list[tuple[int, int] | None] = []
        self.leaves: dict[int, tuple[np.ndarray, ...]] = {}
        bounds: list[np.ndarray] = []
        #: nodes to be made: their rows and their place in the parent
        todo: list[tuple[np.ndarray, int, int]] = [(np.arange(len(ptr) - 1), -1, 0)]
        while todo:
            rows, parent, side = todo.pop()
            node = len(self.children)
            if parent >= 0:
                self.children[parent] = (node, self.children[parent][1]) if side == 0 else (self.children[parent][0], node)
            bound, halves = self._node(rows, leaf)
            bounds.append(bound)
            if halves is None:
                self.children.append(None)
                self.leaves[node] = self._leaf(rows)
            else:
                self.children.append((-1, -1))
                todo += [(halves[0], node, 0), (halves[1], node, 1)]
        self.bounds = np.array(bounds)

    def _node(self, rows: np.ndarray, leaf: int) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray] | None]:
        at = places(self.ptr[rows], self.size[rows])
        terms_, values, starts = self.terms[at], self.values[at].astype(float), np.cumsum(self.size[rows]) - self.size[rows]
        width = len(self.items.place)
        center = np.bincount(terms_, values, width) / len(rows)
        most = np.zeros(width)
        np.maximum.at(most, terms_, values)

        def dots(dense: np.ndarray) -> np.ndarray:
            return np.add.reduceat(values * dense[terms_], starts)

        squares, own = self.square[rows], float(center @ center)
        away = squares - 2 * dots(center) + own + SLACK * (squares + own)
        radius = math.sqrt(max(float(away.max()), 0.0))
        near = self.items.dot(center)
        reach = np.minimum(self.items.norm * radius, self.items.dot(np.maximum(most - center, 0.0)))
        bound = (near + reach) * (1 + SLACK)
        if len(rows) <= leaf:
            return bound, None
        a = self._dense(rows[int(away.argmax())], width)
        b = self._dense(rows[int((squares - 2 * dots(a)).argmax())], width)
        order = np.argsort(dots(a - b), kind="stable")
        half = len(rows) // 2
        return bound, (rows[order[:half]], rows[order[half:]])

    def _dense(self, row: int, width: int) -> np.ndarray:
        out = np.zeros(width)
        out[self.terms[self.ptr[row] : self.ptr[row + 1]]] = self.values[self.ptr[row] : self.ptr[row + 1]]
        return out

    def _leaf(self, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        """The rows of a leaf, by coordinate."""
        at = places(self.ptr[rows], self.size[rows])
        order = np.argsort(self.terms[at], kind="stable")
        terms_ = self.terms[at][order]
        first = np.concatenate(([0], np.flatnonzero(np.diff(terms_)) + 1))
        return rows, terms_[first], np.append(first, len(terms_)), np.repeat(np.arange(len(rows)), self.size[rows])[order], self.values[at][order]

    def scores(self, node: int, item: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows of a leaf with their exact scores for an item."""
        rows, terms_, ptr, of, values = self.leaves[node]
        span = slice(self.items.ptr[item], self.items.ptr[item + 1])
        asked, repeats = self.items.terms[span], self.items.repeats[span]
        k = np.minimum(np.searchsorted(terms_, asked), len(terms_) - 1)
        hit = terms_[k] == asked
        k, repeats = k[hit], repeats[hit]
        lengths = ptr[k + 1] - ptr[k]
        at = places(ptr[k], lengths)
        out = np.zeros(len(rows), np.int64)
        np.add.at(out, of[at], values[at] * np.repeat(repeats, lengths))
        return rows, out

    def search(self, item: int, ids: list[int], best: list[tuple[int, int]], k: int) -> int:
        """Puts the rows that belong there into ``best``, a heap of the k best
        (score, -id). Returns the number of leaves opened."""
        opened = 0
        bounds = self.bounds[:, item]
        heap = [(-float(bounds[0]), 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < 1 or (len(best) == k and -bound < best[0][0]):
                break
            if self.children[node] is not None:
                for child in self.children[node]:
                    heapq.heappush(heap, (-float(bounds[child]), child))
                continue
            opened += 1
            rows, scores = self.scores(node, item)
            for x in np.flatnonzero(scores >= (max(1, best[0][0]) if len(best) == k else 1)).tolist():
                entry = (int(scores[x]), -ids[rows[x]])
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return opened


#: The id of a document without one in the order of ids: behind all others.
NO_ID = 1 << 63

FOUND = pa.schema([("row", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _counted(items):
    """Texts -> in how many of them each coordinate stands; -1: those with
    any term; -2: all terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = items.value.place
        docs, some, all_terms = np.zeros(len(place), np.int64), 0, 0
        for batch in batches:
            for text in batch.column(0):
                found = terms(text.as_py())
                some += bool(found)
                all_terms += len(found)
                docs[[place[t] for t in set(found) if t in place]] += 1
        at = np.flatnonzero(docs)
        yield pa.RecordBatch.from_arrays([pa.array([*at.tolist(), -1, -2], pa.int64()), pa.array([*docs[at].tolist(), some, all_terms], pa.int64())], ["place", "n"])

    return run


def impacts(tf: np.ndarray, weights: np.ndarray, length: int, docs: int, all_terms: int) -> np.ndarray:
    """The weights of a document's terms, in whole numbers."""
    m = 100 - 75 + 75 * length * docs // all_terms
    return weights * (1_000_000_000 * tf // (1000 * tf + 8 * m))


def _searched(items, weights, docs: int, all_terms: int, k: int):
    """Documents -> the k best of this task for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: Items = items.value
        weight = weights.value
        get = asked.place.get
        best: list[list[tuple[int, int]]] = [[] for _ in asked.ids]
        ids: list[int] = []
        rows: list[tuple[np.ndarray, np.ndarray]] = []
        entries = 0

        def searched() -> None:
            ptr = np.concatenate(([0], np.cumsum([len(t) for t, _ in rows])))
            tree = Tree(asked, ptr, np.concatenate([t for t, _ in rows]), np.concatenate([v for _, v in rows]), LEAF)
            for item, own in enumerate(best):
                tree.search(item, ids, own, k)
            ids.clear()
            rows.clear()

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = terms(text.as_py())
                places_ = [p for p in map(get, found) if p is not None]
                if not places_:
                    continue
                own, tf = np.unique(np.array(places_), return_counts=True)
                value = impacts(tf, weight[own], len(found), docs, all_terms)
                own, value = own[value > 0], value[value > 0]
                if not len(own):
                    continue
                ids.append(NO_ID if doc is None else doc)
                rows.append((own, value))
                entries += len(own)
                if len(ids) >= TREE or entries >= ENTRIES:
                    searched()
                    entries = 0
        if ids:
            searched()
        flat = [(asked.rows[x], asked.ids[x], None if -doc == NO_ID else -doc, score) for x, own in enumerate(best) for score, doc in own]
        if flat:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*flat), FOUND.types)], schema=FOUND)

    return run


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of highest score
    above 0 for each row of ``items`` (all, if fewer).

    A term's weight is floor(1000 ln((2 N + 2) / (2 df + 1))), N the
    documents with any term and df those with this one; a document's term
    counts weight * (10^9 tf div (1000 tf + 8 m)), m = 25 + 75 n N div L for
    a document of n terms, L the terms of all; the score is the sum over the
    item's terms, repeats included. Statistics are over all documents.

    Equal scores rank by ascending id (longs; null ids last, and rows of one
    id beside each other in any order); ranks are unique. Null or empty texts
    hold no term: such a document is never found, such an item finds nothing.
    Rows of ``items`` that are equal are asked each. Either table may be
    empty: no rows. Other columns are not read. Texts are read whole. Items
    are asked in passes of ``ASKED`` bytes of item text.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("data"))
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), utf8(item_text_col).alias("data"))
    passes = -(-(asked.agg(F.sum(F.length("data") + 16)).first()[0] or 0) // ASKED)
    found: list[DataFrame] = []
    for number in range(passes):
        own = asked.where(F.pmod(F.xxhash64("item_id", "data"), F.lit(passes)) == number)
        held = Items(sorted(((r["item_id"], bytes(r["data"])) for r in own.collect()), key=lambda x: (x[0] is not None, x)))
        if not held.ids:
            continue
        sent = spark.sparkContext.broadcast(held)
        counted = dict(map(tuple, texts.select("data").mapInArrow(_counted(sent), "place long, n long").groupBy("place").agg(F.sum("n")).collect()))
        n, all_terms = counted.pop(-1, 0), counted.pop(-2, 0)
        if not counted:
            continue
        weights = np.zeros(len(held.place), np.int64)
        for place, df in counted.items():
            weights[place] = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
        rows = texts.mapInArrow(_searched(sent, spark.sparkContext.broadcast(weights), n, all_terms, k), "row long, item_id long, doc_id long, score long")
        found.append(rows.withColumn("pass", F.lit(number)))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    every = reduce(DataFrame.unionByName, found)
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    some = every.withColumn("group", F.pmod(F.xxhash64("doc_id", "score"), F.lit(GROUPS)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("pass", "row", "group").orderBy(*order))).where(F.col("rank") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("pass", "row").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")

"""Unigram token counts by dynamic programming shared over a trie.

A text is cut into pre-tokens; each has a best segmentation under a unigram
model over a byte vocabulary. Distinct pre-tokens are inserted into a trie,
and the forward scores (the best cost and token count of the bytes so far)
are computed once for each trie node, so a prefix that many pre-tokens share
is scored once. A terminal node stores its pre-token's count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.bpe import read_ranks, vocabulary
from starloom.llm.common import begin, keeps

#: Bytes of a pre-token that the trie holds; the scores of further bytes are
#: computed each time.
MAX_DEPTH = 64
#: A worker's trie and its memo of counts begin anew at so many nodes and
#: entries: memory bounds, without effect on any count.
MAX_NODES, MEMO_ENTRIES = 700_000, 400_000


def costs(ranks: dict[bytes, int]) -> dict[bytes, int]:
    """Unigram costs of a rank-ordered vocabulary: Zipf's law, the cost
    -log p of rank r being log(r + 2), in whole millionths (so that sums are
    exact and ties well defined)."""
    return {token: round(1e6 * math.log(rank + 2)) for token, rank in ranks.items()}


class Counter:
    """Token counts of pre-tokens; among segmentations of least cost, the
    one of fewest tokens counts. A byte that no token holds counts as one
    token at the highest cost."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.find = regex.compile(pattern).findall
        self.cost = costs(ranks)
        self.unknown = max(self.cost.values(), default=0) + 1_000_000
        #: Token lengths by last byte: only these suffixes can be tokens.
        self.lengths: list[list[int]] = [[] for _ in range(256)]
        for token in self.cost:
            if len(token) not in self.lengths[token[-1]]:
                self.lengths[token[-1]].append(len(token))
        for found in self.lengths:
            found.sort()
        self.memo = Memo(self)
        self.plant()

    def plant(self) -> None:
        """A trie of the root alone: children by node << 8 | byte, and each
        node's forward score as cost << 32 | tokens."""
        self.child: dict[int, int] = {}
        self.score = [0]

    def step(self, piece: bytes, path: list[int]) -> int:
        """Forward score of the first ``len(path)`` bytes, from those of all
        shorter prefixes."""
        end, cost = len(path), self.cost.get
        best = path[-1] + (self.unknown << 32 | 1)
        for n in self.lengths[piece[end - 1]]:
            if n > end:
                break
            c = cost(piece[end - n : end])
            if c is not None and (score := path[end - n] + (c << 32 | 1)) < best:
                best = score
        return best

    def count(self, piece: bytes) -> int:
        """Inserts a pre-token; its terminal count."""
        if len(self.score) >= MAX_NODES:
            self.plant()
        child, score, node, path = self.child, self.score, 0, [0]
        for byte in piece[:MAX_DEPTH]:
            key = node << 8 | byte
            node = child.get(key, 0)
            if not node:
                node = child[key] = len(score)
                score.append(self.step(piece, path))
            path.append(score[node])
        while len(path) <= len(piece):
            path.append(self.step(piece, path))
        return path[-1] & 0xFFFFFFFF

class Memo(dict):
    """Pre-token -> count."""

    def __init__(self, counter: Counter) -> None:
        super().__init__()
        self.counter = counter

    def __missing__(self, piece: str) -> int:
        n = self.counter.count(piece.encode("utf-8", "surrogatepass"))
        if len(piece) <= MAX_DEPTH:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[piece] = n
        return n


@lru_cache(maxsize=2)
def counter(blob: bytes, pattern: str) -> Counter:
    """One counter a worker process, kept between tasks."""
    return Counter(read_ranks(blob), pattern)


keeps("tokencount", counter.cache_clear)


def count_tokens(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_pretokens, n_tokens`` for every row.

    A null text counts as empty: no tokens. A null id stays null; repeated
    rows each give a row; columns of other names are not read.
    """
    blob = vocabulary(docs, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("tokencount")
        c = counter(blob.value, pattern)
        for batch in batches:
            found = []
            for text in batch.column(1):
                pieces = c.find(text.as_py() or "")
                found.append((len(pieces), sum(map(c.memo.__getitem__, pieces))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())],
                ["doc_id", "n_pretokens", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")

"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Each pre-token is a linked list of byte spans. Every adjacent pair that is a
vocabulary entry waits in the bucket of its rank; a two-level bitmap over the
ranks finds the lowest bucket that holds anything by find-first-set. The
leftmost position of that bucket is merged, its two neighbours get new ranks
and are queued again; entries that a merge has made stale are skipped when
they surface. A pre-token of n bytes costs O(n log n) whatever its length.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import begin, keeps

#: A vocabulary file above this is refused: it is sent to every executor.
MAX_VOCABULARY_BYTES = 64 << 20
#: Entries of a worker's memo of encoded pre-tokens; at the bound it starts anew.
MEMO_ENTRIES = 500_000
#: Longer pre-tokens are encoded each time, not remembered.
MEMO_LENGTH = 64


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.tokens: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.memo = Memo(self)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        get, n = self.ranks.get, len(piece)
        after = list(range(1, n + 2))  # start of the next span; n ends the list
        before = list(range(-1, n))
        rank_at = [-1] * (n + 1)  # of the pair that starts here, -1 for none
        buckets: dict[int, list[int]] = {}  # rank -> heap of positions
        words: dict[int, int] = {}  # rank // 64 -> bitmap of its filled buckets
        summary = 0  # bitmap of the filled words
        for i in range(n - 1):
            rank = get(piece[i : i + 2])
            if rank is None:
                continue
            rank_at[i] = rank
            if rank in buckets:
                buckets[rank].append(i)
            else:
                buckets[rank] = [i]
                w = rank >> 6
                words[w] = words.get(w, 0) | 1 << (rank & 63)
                summary |= 1 << w
        while summary:
            w = (summary & -summary).bit_length() - 1
            bits = words[w]
            rank = w << 6 | (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                words[w] = bits = bits & bits - 1
                if not bits:
                    summary &= summary - 1
            if rank_at[i] != rank:
                continue  # stale: a merge has changed or swallowed this pair
            gone = after[i]
            rank_at[gone] = -1
            after[i] = end = after[gone]
            before[end] = i
            at = i
            new = get(piece[i : after[end]]) if end < n else None
            while True:  # the pair that starts with the merged span, then the one that ends with it
                if new is None:
                    rank_at[at] = -1
                else:
                    rank_at[at] = new
                    if new in buckets:
                        heappush(buckets[new], at)
                    else:
                        buckets[new] = [at]
                        w = new >> 6
                        words[w] = words.get(w, 0) | 1 << (new & 63)
                        summary |= 1 << w
                if at != i or i == 0:
                    break
                at = before[i]
                new = get(piece[at:end])
        ranks, ids, i = self.ranks, [], 0
        while i < n:
            ids.append(ranks[piece[i : after[i]]])
            i = after[i]
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.memo.__getitem__, self.find(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Memo(dict):
    """Pre-token -> packed ids."""

    def __init__(self, encoder: Encoder) -> None:
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        ids = self.encoder.merge(piece.encode("utf-8", "surrogatepass"))
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= MEMO_LENGTH:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[piece] = packed
        return packed


def read_ranks(blob: bytes) -> dict[bytes, int]:
    """``<base64 token> <rank>`` lines."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in blob.splitlines() if line.strip())}


@lru_cache(maxsize=2)
def encoder(blob: bytes, pattern: str) -> Encoder:
    """One encoder a worker process, kept between tasks."""
    return Encoder(read_ranks(blob), pattern)


keeps("bpe", encoder.cache_clear)


def vocabulary(df: DataFrame, path: str):
    """The rank file at ``path`` (read on the driver) as a broadcast of proven size."""
    with open(path, "rb") as f:
        blob = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(blob) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is above {MAX_VOCABULARY_BYTES} bytes")
    return df.sparkSession.sparkContext.broadcast(blob)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids``: every text encoded whole.

    ``ids`` is binary, little-endian unsigned 32-bit. A null text is empty
    and has no tokens; a null id stays null; repeated rows each give a row;
    other columns, whatever their names, are not read.
    """
    blob = vocabulary(docs, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("bpe")
        e = encoder(blob.value, pattern)
        for batch in batches:
            ids = [e.encode(t) if t else b"" for t in map(pa.StringScalar.as_py, batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "n_tokens", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` (``doc_id, n_tokens, ids``) with ``decoded``, the bytes of
    the ids. Null ids decode to nothing."""
    blob = vocabulary(encoded, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("bpe")
        e = encoder(blob.value, "")
        for batch in batches:
            texts = [e.decode(x) if x else b"" for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], ["doc_id", "n_tokens", "ids", "decoded"])

    rows = encoded.select("doc_id", "n_tokens", "ids")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids, decoded_sha256, same``: ``encode``, then the
    ids decoded, and whether that gives the text's bytes again."""
    blob = vocabulary(docs, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("bpe")
        e = encoder(blob.value, pattern)
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text in map(pa.StringScalar.as_py, batch.column(1)):
                ids = e.encode(text) if text else b""
                decoded = e.decode(ids)
                for column, value in zip(out, (len(ids) // 4, ids, hashlib.sha256(decoded).hexdigest(), decoded == (text or "").encode())):
                    column.append(value)
            kinds = (pa.int64(), pa.binary(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out, kinds)], ["doc_id", "n_tokens", "ids", "decoded_sha256", "same"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded_sha256 string, same boolean")


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encode, then decode."""
    done = round_trip(docs, ranks_path, pattern)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "decoded_sha256")

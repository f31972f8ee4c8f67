"""Packing documents into training windows by lexical retrieval.

Each document is a list of token ids, closed by an end id. The ids are
written once, with the document frequency of every id (counted over all
documents) and a locality key: the least values of a few hashes over the
document's ids. Sorting by the key brings documents that share ids beside
each other, in one range partition and, there, in one shard.

A shard is some hundred thousand ids of neighbouring documents under a BM25
inverted index, whose statistics are those of all documents. Whole windows of
a long document go out first. Then each document not used yet is a seed: the
index returns the unused documents by their score for it; those that fit
fill its window in this order, and the best of the others gives the head
that is missing. Its rest stays in the shard. What fills no window goes on
to the next shard of the task.

The last ids of a task are cut at powers of two, so no sequence is padded.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm.balltree import places
from starloom.llm.common import begin, keeps, write_cut

#: Ids of a sequence.
WINDOW = 2048
#: The id that closes a document.
END = 1
#: Ids, and documents, of a shard.
SHARD, SHARD_DOCS = 1 << 19, 1024
#: Hashes of the locality key.
KEYS = 4
#: BM25's saturation and length normalisation.
K1, B = 1.2, 0.75
#: Ids that a task encodes before it hands them on.
FLUSH = 1 << 20


# --- ids -----------------------------------------------------------------------

def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: a
    printable Latin-1 character for itself, the others in order from U+0100."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


def encoder(path: str, pattern: str) -> Callable[[list[str]], list[np.ndarray]]:
    """Texts -> the ids that ``tokenizers`` gives them with the file at
    ``path``, without special tokens added.

    A plain byte-level BPE file is run by tiktoken, which is faster and gives
    the same ids: the ids of merged tokens must stand in the order of the
    merges, and there must be nothing that changes texts. The strings of
    added tokens are cut out first, as ``tokenizers`` does. Any other file
    is run by ``tokenizers`` itself.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, added = spec["model"], spec.get("added_tokens") or []
    vocab, merges = model.get("vocab"), model.get("merges")
    split = spec.get("pre_tokenizer") or {}
    simple = (model.get("type") == "BPE" and isinstance(vocab, dict) and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
              and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges"))
              and not spec.get("normalizer") and not spec.get("truncation") and not spec.get("padding")
              and not any(a.get(k) for a in added for k in ("single_word", "lstrip", "rstrip", "normalized")))
    if simple:
        letters = _byte_letters()
        joined = ["".join(m if isinstance(m, list) else m.split(" ")) for m in merges]
        ids = [vocab.get(m, -1) for m in joined]
        simple = all(c in letters for t in vocab for c in t) and ids == sorted(set(ids)) and min(ids) >= 256 and len(vocab) == 256 + len(ids)
    if not simple:
        whole = Tokenizer.from_file(path)
        return lambda texts: [np.array(e.ids, np.uint32) for e in whole.encode_batch(texts, add_special_tokens=False)]
    ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items()}
    fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    special = {a["content"]: a["id"] for a in added}
    cut = re.compile("(" + "|".join(re.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
    plain = fast.encode_ordinary
    if pattern.endswith(_BEHIND):
        plain = _by_white_space(tiktoken.Encoding("packing-plain", pat_str=pattern[: -len(_BEHIND)] + _AHEAD, mergeable_ranks=ranks, special_tokens={}), fast)

    def one(text: str) -> np.ndarray:
        if not any(mark in text for mark in special):
            return np.array(plain(text), np.uint32)
        pieces = cut.split(text)
        ids = plain(pieces[0])
        for mark, piece in zip(pieces[1::2], pieces[2::2]):
            ids = [*ids, special[mark], *plain(piece)]
        return np.array(ids, np.uint32)

    return lambda texts: list(map(one, texts))


#: How a pattern ends that leaves the last of several white spaces to what
#: follows, and the same where no two stand together before something.
_BEHIND, _AHEAD = r"|\s+(?!\S)|\s+", r"|\s+"
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
#: White space beyond ASCII, and what two ASCII ones together may begin with
#: in a text without the rarer ones.
_WIDE = ("\x85", "\xa0", "\u1680", *map(chr, range(0x2000, 0x200B)), "\u2028", "\u2029", "\u202f", "\u205f", "\u3000")
_RARE, _TWO = ("\t", "\r", "\x0b", "\x0c"), ("  ", "\n\n", " \n", "\n ")


def _by_white_space(simple: tiktoken.Encoding, whole: tiktoken.Encoding) -> Callable[[str], list[int]]:
    """``whole.encode_ordinary``, without its look ahead, which takes a slow
    search: a text is cut before the last of several white spaces that stand
    before something else, where the pattern ends a match in any case."""

    def run(text: str) -> list[int]:
        if not text.isascii() and any(c in text for c in _WIDE):
            return whole.encode_ordinary(text)
        if not any(c in text for c in _RARE) and not any(c in text for c in _TWO):
            return simple.encode_ordinary(text)
        data = text.encode("utf-8", "surrogatepass")
        white = _WHITE[np.frombuffer(data, np.uint8)]
        at = np.flatnonzero(white[:-2] & white[1:-1] & ~white[2:]) + 1
        out, edges = [], [0, *at.tolist(), len(data)]
        for a, b in zip(edges, edges[1:]):
            out += simple.encode_ordinary(data[a:b].decode("utf-8", "surrogatepass"))
        return out

    return run


_ENCODERS: dict[tuple[str, str], Callable[[list[str]], list[np.ndarray]]] = {}
keeps("packing", _ENCODERS.clear)

#: ``n``: the document's ids; ``body``: they, compressed; ``key``: locality.
#: The last row of a task has ``counts`` alone: in how many of its documents
#: each id stands.
ENCODED = pa.schema([("doc_id", pa.int64()), ("hash", pa.int64()), ("n", pa.int64()), ("body", pa.binary()), ("counts", pa.binary()), *[(f"key{k}", pa.int32()) for k in range(KEYS)]])
ENCODED_DDL = "doc_id long, hash long, n long, body binary, counts binary, " + ", ".join(f"key{k} int" for k in range(KEYS))


def _mixed(tokens: np.ndarray, seed: int) -> np.ndarray:
    x = tokens.astype(np.uint64) + np.full(1, seed + 1, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(33)


def _packed_ids(ids: np.ndarray, press: zstandard.ZstdCompressor) -> bytes:
    """Ids in two bytes each where they fit, else in four, compressed."""
    return b"\2" + press.compress(ids.astype(np.uint16).tobytes()) if int(ids.max()) < 1 << 16 else b"\4" + press.compress(ids.tobytes())


def ids_of(body: bytes) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(body[1:])
    return np.frombuffer(data, np.uint16).astype(np.uint32) if body[0] == 2 else np.frombuffer(data, np.uint32)


def _encoded(path: str, pattern: str):
    """Documents -> their ids and locality key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("packing")
        encode = _ENCODERS.get((path, pattern)) or _ENCODERS.setdefault((path, pattern), encoder(path, pattern))
        press = zstandard.ZstdCompressor(level=1)
        mixed = [_mixed(np.arange(1 << 16), k) for k in range(KEYS)]
        docs = np.zeros(1 << 16, np.int64)
        for batch in batches:
            names, hashes, texts = (batch.column(c).to_pylist() for c in range(3))
            at = 0
            while at < len(texts):
                end, size = at, 0  # a slice of the batch, by length
                while end < len(texts) and size < 4 * FLUSH:
                    size += len(texts[end])
                    end += 1
                rows: list[tuple] = []
                for doc, h, ids in zip(names[at:end], hashes[at:end], encode(texts[at:end])):
                    ids = np.append(ids, np.uint32(END))
                    own = np.unique(ids)
                    if own[-1] >= len(docs):
                        docs = np.concatenate([docs, np.zeros(int(own[-1]) + 1 - len(docs), np.int64)])
                    docs[own] += 1
                    keys = [int((m[own] if own[-1] < 1 << 16 else _mixed(own, k)).min()) for k, m in enumerate(mixed)]
                    rows.append((doc, h, len(ids), _packed_ids(ids, press), None, *keys))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), ENCODED.types)], schema=ENCODED)
                at = end
        found = np.flatnonzero(docs)
        if len(found):
            counts = press.compress(found.astype(np.uint32).tobytes() + docs[found].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([counts if f.name == "counts" else None], f.type) for f in ENCODED], schema=ENCODED)

    return run


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of tasks, an id a row."""
    for batch in batches:
        for body in batch.column(0):
            data = zstandard.ZstdDecompressor().decompress(body.as_py())
            n = len(data) // 12
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(data, np.uint32, n).astype(np.int64)), pa.array(np.frombuffer(data, np.int64, n, 4 * n))], ["token", "df"])


# --- retrieval and packing -------------------------------------------------------

def idf(df: np.ndarray, docs: int) -> np.ndarray:
    """BM25's weight of an id; 0 for one in half of all documents or more."""
    return np.maximum(np.log((docs - df + 0.5) / (df + 0.5)), 0.0)


class Index:
    """An inverted index over the documents of a shard: for every id its
    postings, each with its BM25 weight."""

    def __init__(self, texts: list[np.ndarray], weight: np.ndarray, mean: float) -> None:
        tokens, counts, sizes = [], [], []
        for ids in texts:
            own, times = np.unique(ids, return_counts=True)
            some = weight[own] > 0
            tokens.append(own[some])
            counts.append(times[some])
            sizes.append(int(some.sum()))
        self.terms = tokens
        length = np.repeat([len(t) for t in texts], sizes)
        token, tf = np.concatenate(tokens).astype(np.int64), np.concatenate(counts).astype(float)
        of = np.repeat(np.arange(len(texts)), sizes)
        score = weight[token] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))
        # (numpy sorts numbers of two bytes by their digits, far faster)
        order = np.argsort(token.astype(np.uint16) if len(token) and token.max() < 1 << 16 else token, kind="stable")
        self.of, self.score, token = of[order], score[order], token[order]
        first = np.flatnonzero(np.concatenate((token[:1] >= 0, token[1:] != token[:-1])))
        self.vocabulary, self.ptr = token[first], np.append(first, len(order))

    def neighbours(self, seed: int) -> np.ndarray:
        """BM25 scores of all documents of the shard for the ids of ``seed``."""
        at = np.searchsorted(self.vocabulary, self.terms[seed])
        lengths = self.ptr[at + 1] - self.ptr[at]
        where = places(self.ptr[at], lengths)
        return np.bincount(self.of[where], self.score[where], len(self.terms))


class Piece:
    """What is left of a document: its ids from ``start`` on."""

    __slots__ = ("doc", "ids", "start", "total")

    def __init__(self, doc: int | None, ids: np.ndarray, start: int, total: int) -> None:
        self.doc, self.ids, self.start, self.total = doc, ids, start, total

    def cut(self, n: int) -> Piece:
        """The first ``n`` ids; the others stay here."""
        head = Piece(self.doc, self.ids[:n], self.start, self.total)
        self.ids, self.start = self.ids[n:], self.start + n
        return head


def fill(pieces: list[Piece], weight: np.ndarray, mean: float, window: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Whole windows of a shard's ``pieces`` (each below a window), and what
    is left: the seed that its neighbours cannot fill up."""
    if not pieces:
        return [], []
    index = Index([p.ids for p in pieces], weight, mean)
    size = np.array([len(p.ids) for p in pieces])
    unused = np.ones(len(pieces), bool)
    out: list[list[Piece]] = []
    for seed in range(len(pieces)):
        if not unused[seed]:
            continue
        if size[unused].sum() < window:
            break
        unused[seed] = False
        own, room = [pieces[seed]], window - int(size[seed])
        ranked = np.argsort(-np.where(unused, index.neighbours(seed), -1.0), kind="stable")[: int(unused.sum())]
        best = None
        for k in ranked.tolist():
            if not room:
                break
            if size[k] <= room:
                own.append(pieces[k])
                unused[k] = False
                room -= int(size[k])
            elif best is None:
                best = k
        if room:  # the best that did not fit gives the rest
            own.append(pieces[best].cut(room))
            size[best] -= room
        out.append(own)
    return out, [pieces[k] for k in np.flatnonzero(unused).tolist()]


PACKED = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")] + [("ids", pa.binary())])
PACKED_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def _packed(weight, mean: float, window: int, shard: int, shard_docs: int):
    """Encoded documents in the order of locality -> the pieces of sequences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("packing")
        weights = weight.value
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        held: list[Piece] = []
        size = 0

        def rows(sequences: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal number
            cells: list[tuple] = []
            for own in sequences:
                at = 0
                for p in own:
                    data = p.ids.tobytes()
                    cells.append((p.doc, p.start, len(p.ids), zlib.crc32(data), p.total, number, at, data))
                    at += len(p.ids)
                number += 1
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*cells), PACKED.types)], schema=PACKED)

        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = ids_of(body.as_py())
                piece = Piece(doc, ids, 0, len(ids))
                full = len(ids) // window
                for at in range(0, full, 256):
                    yield rows([[piece.cut(window)] for _ in range(min(256, full - at))])
                if len(piece.ids):
                    held.append(piece)
                    size += len(piece.ids)
                if size >= shard or len(held) >= shard_docs:
                    done, held = fill(held, weights, mean, window)
                    size = sum(len(p.ids) for p in held)
                    if done:
                        yield rows(done)
        done, held = fill(held, weights, mean, window)
        done += cut_at_powers(held, window)
        if done:
            yield rows(done)

    return run


def cut_at_powers(pieces: list[Piece], window: int) -> list[list[Piece]]:
    """The pieces, one after the other, in sequences whose lengths are whole
    windows or powers of two, the longest first."""
    left = sum(len(p.ids) for p in pieces)
    out: list[list[Piece]] = []
    queue = list(pieces)
    while left:
        room = window if left >= window else 1 << (left.bit_length() - 1)
        left -= room
        own: list[Piece] = []
        while room:
            n = min(room, len(queue[0].ids))
            own.append(queue[0].cut(n))
            room -= n
            if not len(queue[0].ids):
                queue.pop(0)
        out.append(own)
    return out


def pack(docs: DataFrame, path: str, pattern: str, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    ids``: one row for each piece of a document in a sequence.

    ``start``: the document's ids before the piece; ``ids``: the piece's, as
    little-endian unsigned 32-bit integers; ``doc_tokens``: the document's
    with the end id; ``offset``: the place in the sequence. Sequences have
    ``window`` ids (a power of two), but for the last of a task, whose
    lengths are smaller powers of two. Every id is in one piece.

    A null or empty text is its end id alone. Rows that are equal, or have
    one id (or none), are documents each; their pieces are told apart by the
    rows' own tilings. A text of any length is packed whole. No rows give no
    rows; other columns are not read. ``sequence_id`` is unique, not dense.
    """
    if window < 1 or window & (window - 1):
        raise ValueError(f"the window must be a power of two, not {window}")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col).cast("long"), text).alias("hash"), text.alias("text"))
    encoded = write_cut(rows.mapInArrow(_encoded(path, pattern), ENCODED_DDL), "packing-ids")
    n, total = encoded.agg(F.count("n"), F.sum("n")).first()
    if not n:
        return docs.sparkSession.createDataFrame([], PACKED_DDL)
    counted = encoded.where("counts is not null").select("counts").mapInArrow(_frequencies, "token long, df long").groupBy("token").agg(F.sum("df").alias("df")).collect()
    df = np.zeros(max(r["token"] for r in counted) + 1, np.int64)
    for r in counted:
        df[r["token"]] = r["df"]
    weight = docs.sparkSession.sparkContext.broadcast(idf(df, n))
    keys = [f"key{k}" for k in range(KEYS)]
    near = encoded.where("n is not null").repartitionByRange(*keys, "hash").sortWithinPartitions(*keys, "hash", "doc_id").select("doc_id", "body")
    return near.mapInArrow(_packed(weight, total / n, window, SHARD, SHARD_DOCS), PACKED_DDL)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The pieces without their ids."""
    return pack(docs, path, pattern).drop("ids")

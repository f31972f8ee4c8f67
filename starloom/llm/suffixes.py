"""Exact substring dedup over a distributed, anchored suffix array.

Two equal strings of ``min_length`` bytes hold the same *anchor*: the byte
k-gram of least hash in them, at the same offset. So every window of
``min_length`` bytes is sent, with the windows that share its anchor, to the
part of its anchor's hash, as one short context of text. Windows that are
equal anywhere in the corpus meet there.

Each part builds an enhanced suffix array of its contexts: the suffixes that
start a window, in an order that groups common prefixes, and the lengths
these share (LCP). A stack scan of the array walks its common-prefix
interval tree; an interval whose suffixes are preceded by different bytes
(left-extension diversity) is a maximal repeat within its contexts, and is
given out with all its occurrences. Repeats longer than a context come as
overlapping pieces, one for each anchor.

Contexts that are equal within one map task are combined there: the first
is sent on, the others are given out as its repeats.

A k-gram that very many places share (a common line, the edge of a common
passage) would bring all of them to one part. A first pass over a sample
finds these k-grams, at most ``MAX_HOT`` of them; they are anchors only of
windows that hold no other. Such windows, wherever their contexts differ, go
on one by one, each to the part of its own hash. The sample decides how the
work is dealt, never what is found: windows that are equal choose alike.

A part is dealt in units that a task reads one after the other. An anchor
of more windows than fit (``CHUNK``) is treated as single windows, some
ranges of their hashes at a time.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import drop_cut, even_labels, utf8, write_cut
from starloom.llm.links import groups

#: Bytes of an anchor's k-gram.
ANCHOR = 24
#: Bytes of text cut at a time; longer documents are cut in pieces that
#: overlap by ``min_length - 1``.
PIECE = 1 << 21
#: Bytes of context that a map task gathers before it hands them on.
FLUSH = 48 << 20
#: Windows of a unit that are treated at a time.
CHUNK = 400_000
#: Units of a part, read one after the other.
UNITS = 4
#: One of so many stretches of so many bytes is sampled for common k-grams.
SAMPLE, STRETCH = 128, 4096
#: Occurrences in the sample from which a k-gram is hot (about 6,400 in all),
#: and how many hot ones there may be: the first rises where it must, so what
#: reaches the driver and the tasks is 8 MB at most.
HOT, MAX_HOT = 50, 1 << 20
#: The offset of a context that meets others by the hash of all its bytes.
WHOLE = 0xFFFF
#: Windows of hot anchors that a map task treats at a time.
SINGLE = 200_000
#: Rows, and bytes, that are handed to Spark at a time.
HANDED, HANDED_BYTES = 256, 4 << 20

_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
_POSITION = np.uint64((1 << 24) - 1)


def words(data: np.ndarray) -> np.ndarray:
    """A mixed 64-bit value of the eight bytes from each place."""
    b = data.astype(np.uint64)
    for n in (1, 2, 4):
        b = b[:-n] | b[n:] << np.uint64(8 * n)
    b ^= b >> np.uint64(32)
    b *= _M[0]
    b ^= b >> np.uint64(29)
    b *= _M[1]
    b ^= b >> np.uint64(32)
    return b


def span_hash(mixed: np.ndarray, n: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hash of the n >= 8 bytes from each place (or from the places ``at``)."""
    offsets = [*range(0, n - 7, 8), *([n - 8] if n % 8 else [])]
    size = len(mixed) - offsets[-1]
    out = np.zeros(size if at is None else len(at), np.uint64)
    for k, o in enumerate(offsets):
        out += mixed[o : o + size] if at is None else mixed[at + o]
        out *= _M[2 + k % 3]
        out ^= out >> np.uint64(31)
    return out


class Hot:
    """Sorted hashes, behind a table that most others miss."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = hashes
        self.table = np.zeros(1 << 20, bool)
        self.table[hashes >> np.uint64(44)] = True

    def among(self, h: np.ndarray) -> np.ndarray:
        """Which of ``h`` are held."""
        out = np.zeros(len(h), bool)
        some = np.flatnonzero(self.table[h >> np.uint64(44)])
        if len(some):
            out[some] = self.hashes[np.minimum(np.searchsorted(self.hashes, h[some]), len(self.hashes) - 1)] == h[some]
        return out


def anchors(data: np.ndarray, n: int, hot: Hot) -> tuple[np.ndarray, ...]:
    """Runs of windows (n bytes) of ``data`` that have one anchor: the first
    window, how many, the anchor's place and hash, whether it is ``hot``
    (then all k-grams of these windows are), and the mixed words."""
    mixed = words(data)
    h = span_hash(mixed, ANCHOR)
    low = (h >> np.uint64(1) & ~_POSITION) | np.arange(len(h), dtype=np.uint64)
    if len(hot.hashes):
        low |= hot.among(h).astype(np.uint64) << np.uint64(63)
    width, have = n - ANCHOR + 1, 1
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    at = (low & _POSITION).astype(np.int64)
    first = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
    return first, np.diff(np.append(first, len(at))), at[first], h[at[first]], low[first] >> np.uint64(63) != 0, mixed


def gathered(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every run."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


#: What a row of a blob holds: a document (whether its id is null; the id, or
#: a hash of the text; the hash of both), a place in it, a number of windows or
#: bytes, a name, a flag.
ROW = np.dtype([("none", "?"), ("doc", "<i8"), ("key", "<u8"), ("name", "<u8"), ("start", "<u4"), ("size", "<u4"), ("first", "?")])
ROWS = np.empty(0, ROW)


def table(**columns: np.ndarray) -> np.ndarray:
    out = np.zeros(len(columns["doc"]), ROW)
    for name, values in columns.items():
        out[name] = values
    return out


def pack(rows: np.ndarray) -> bytes:
    """Column by column, compressed."""
    return zstandard.ZstdCompressor(level=3).compress(b"".join(np.ascontiguousarray(rows[c]).tobytes() for c in ROW.names))


def unpack(blob: bytes) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n, at = len(data) // ROW.itemsize, 0
    out = np.zeros(n, ROW)
    for c in ROW.names:
        kind = ROW[c]
        out[c] = np.frombuffer(data, kind, n, at)
        at += n * kind.itemsize
    return out


MAPPED = pa.schema([("part", pa.int64()), ("unit", pa.int32()), ("head", pa.binary()), ("body", pa.binary())])
SENT = "part long, unit int, head binary, body binary"
#: A row of it.
Blob = tuple[int, int, bytes, bytes | None]


def handed(blobs: Iterator[Blob]) -> Iterator[pa.RecordBatch]:
    """Blobs, some at a time."""
    held: list[Blob] = []
    size = 0
    for blob in blobs:
        held.append(blob)
        size += len(blob[2]) + len(blob[3] or b"")
        if len(held) >= HANDED or size >= HANDED_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), MAPPED.types)], schema=MAPPED)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), MAPPED.types)], schema=MAPPED)


def by_unit(h: np.ndarray, labels: list[int]) -> Iterator[tuple[int, int, np.ndarray]]:
    """Part (its label), unit and indices of the hashes ``h`` for each unit
    that has any."""
    n = len(labels) * UNITS
    at = (h % np.uint64(n)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    edges = np.searchsorted(at[order], np.arange(n + 1))
    for k in np.flatnonzero(np.diff(edges)).tolist():
        yield labels[k % len(labels)], k // len(labels), order[edges[k] : edges[k + 1]]


class Contexts:
    """Contexts gathered by a map task, to be handed on by part."""

    def __init__(self, n: int, labels: list[int], hot: np.ndarray) -> None:
        self.n, self.labels, self.hot = n, labels, Hot(hot)
        self.clear()

    def clear(self) -> None:
        self.size = 0
        self.rows: list[np.ndarray] = []
        self.anchor: list[np.ndarray] = []
        self.offset: list[np.ndarray] = []
        self.text: list[np.ndarray] = []

    def add(self, none: bool, doc: int, key: int, offset: int, data: np.ndarray) -> None:
        first, count, place, anchor, hot, mixed = anchors(data, self.n, self.hot)
        ends = span_hash(mixed, self.n, np.concatenate([first, first + count - 1]))
        name = ends[: len(first)] * _M[3] ^ ends[len(first) :] * _M[4] ^ count.astype(np.uint64)
        self.rows.append(table(doc=np.full(len(first), doc), none=none, key=np.uint64(key), name=name, start=first + offset, size=count))
        self.anchor.append(anchor)
        self.offset.append(np.where(hot, WHOLE, place - first).astype(np.uint16))
        self.text.append(data[gathered(first, count + self.n - 1)])
        self.size += len(self.text[-1])

    def flush(self) -> Iterator[Blob]:
        if not self.rows:
            return
        rows, anchor, offset, text = (np.concatenate(x) for x in (self.rows, self.anchor, self.offset, self.text))
        self.clear()
        length = rows["size"].astype(np.int64) + self.n - 1
        at = np.cumsum(length) - length
        again = yield from self.repeats(rows, text, at, length)
        rows, anchor, offset, at = (x[~again] for x in (rows, anchor, offset, at))
        whole = offset == WHOLE
        yield from self.sent(rows[~whole], anchor[~whole], offset[~whole], text, at[~whole])
        yield from self.singles(rows[whole], text, at[whole])

    def singles(self, rows: np.ndarray, text: np.ndarray, at: np.ndarray) -> Iterator[Blob]:
        """Windows of hot anchors, each a context of its own."""
        ends = np.cumsum(rows["size"].astype(np.int64))
        for low in range(0, int(ends[-1]) if len(ends) else 0, SINGLE):
            window = np.arange(low, min(low + SINGLE, int(ends[-1])))
            of = np.searchsorted(ends, window, "right")
            place = window - (ends[of] - rows["size"][of])
            body = text[gathered(at[of] + place, np.full(len(of), self.n))]
            start, length = np.arange(len(of)) * self.n, np.full(len(of), self.n)
            h = span_hash(words(body), self.n, start)
            own = rows[of]
            own["start"] += place.astype(np.uint32)
            own["size"], own["name"] = 1, h * _M[3] ^ h * _M[4] ^ np.uint64(1)
            again = yield from self.repeats(own, body, start, length)
            yield from self.sent(own[~again], h[~again], np.full(int((~again).sum()), WHOLE, np.uint16), body, start[~again])

    def repeats(self, rows: np.ndarray, text: np.ndarray, at: np.ndarray, length: np.ndarray) -> Generator[Blob, None, np.ndarray]:
        """Gives out the contexts that equal an earlier one, and tells which."""
        again, same_row = self.combined(rows, text, at, length)
        if (again & ~same_row).any():
            found = rows[again & ~same_row]
            found["size"] = length[again & ~same_row]
            for part, unit, own in by_unit(found["key"], self.labels):
                yield part, unit, pack(found[own]), None
        return again

    def sent(self, rows: np.ndarray, meet: np.ndarray, offset: np.ndarray, text: np.ndarray, at: np.ndarray) -> Iterator[Blob]:
        """Contexts, to the part of the hash by which they ``meet``."""
        press = zstandard.ZstdCompressor(level=6)
        length = rows["size"].astype(np.int64) + self.n - 1
        rows["name"] = 0
        for part, unit, own in by_unit(meet, self.labels):
            yield part, unit, pack(rows[own]), press.compress(offset[own].tobytes() + text[gathered(at[own], length[own])].tobytes())

    def combined(self, rows: np.ndarray, text: np.ndarray, at: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which contexts equal one that starts earlier here (or at the same
        place of a repeated row: the second result)."""
        order = np.lexsort((rows["start"], rows["key"], rows["doc"], ~rows["none"], rows["name"]))
        same = np.concatenate(([False], rows["name"][order][1:] == rows["name"][order][:-1]))
        lead = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
        out, same_row = np.zeros(len(rows), bool), np.zeros(len(rows), bool)
        copies, heads = order[same], lead[same]
        same_row[copies] = np.all([rows[c][copies] == rows[c][heads] for c in ("none", "doc", "key", "start")], axis=0)
        fits = length[copies] == length[heads]
        copies, heads = copies[fits], heads[fits]
        for k in range(0, len(copies), 20_000):  # names may collide: the bytes decide
            c, h = copies[k : k + 20_000], heads[k : k + 20_000]
            differ = text[gathered(at[c], length[c])] != text[gathered(at[h], length[c])]
            out[c] = np.add.reduceat(differ, np.cumsum(length[c]) - length[c], dtype=np.int64) == 0
        return out, same_row


def _contexts(n: int, labels: list[int], hot: np.ndarray = np.empty(0, np.uint64)):
    """Map side: (none, doc, key, bytes) -> contexts, and the repeats combined here."""

    def blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[Blob]:
        held = Contexts(n, labels, hot)
        for batch in batches:
            names = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_numpy().view(np.uint64).tolist())
            for (none, doc, key), value in zip(names, batch.column(3)):
                data = np.frombuffer(value.as_buffer(), np.uint8)
                for at in range(0, len(data) - n + 1, PIECE):
                    held.add(none, doc, key, at, data[at : at + PIECE + n - 1])
                    if held.size >= FLUSH:
                        yield from held.flush()
        yield from held.flush()

    return lambda batches: handed(blobs(batches))


def intervals(lcp: list[int], left: list[int], rank: list[int], n: int) -> Iterator[tuple[int, int, int, int]]:
    """Stack scan of an enhanced suffix array: the maximal repeats as (first
    place, last place, length, least rank).

    ``lcp[k]``: bytes that suffixes k - 1 and k share. ``left[k]``: the byte
    before suffix k, -1 if its context starts there. An interval is given
    out only if the left bytes in it differ or are open.
    """
    # open intervals: [length, first place, least and largest left byte, least rank]
    stack: list[list[int]] = []
    for k in range(1, len(lcp) + 1):
        now = lcp[k] if k < len(lcp) else 0
        begin, low, high, least = k - 1, left[k - 1], left[k - 1], rank[k - 1]
        # the suffix before joins the open interval, or opens one with this
        while stack and stack[-1][0] > now:
            length, first, a, b, r = stack.pop()
            low, high, least, begin = min(low, a), max(high, b), min(least, r), first
            if low != high or low < 0:
                yield first, k - 1, length, least
        if now < n:
            continue
        if stack and stack[-1][0] == now:
            top = stack[-1]
            top[2], top[3], top[4] = min(top[2], low), max(top[3], high), min(top[4], least)
        else:
            stack.append([now, begin, low, high, least])


def maximal(rows: np.ndarray, data: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Maximal repeats among contexts (``rows``, their bytes ``data`` one
    after the other): for each occurrence its context, its place in it, the
    repeat's length, and whether it is the repeat's first; and the name."""
    count = rows["size"].astype(np.int64)
    length = count + n - 1
    at = np.cumsum(length) - length
    of = np.repeat(np.arange(len(rows)), count)
    place = gathered(np.zeros(len(rows), np.int64), count)
    where = at[of] + place
    h = span_hash(words(data), n, where)
    order = np.argsort(h, kind="stable")
    h = h[order]
    edge = np.concatenate(([0], np.flatnonzero(h[1:] != h[:-1]) + 1, [len(h)]))
    sizes = np.diff(edge)
    before = np.where(place > 0, data[where - 1].astype(np.int16), np.int16(-1))[order]
    low, high = np.minimum.reduceat(before, edge[:-1]), np.maximum.reduceat(before, edge[:-1])
    chosen = np.repeat((sizes > 1) & ((low != high) | (low < 0)), sizes)
    order, kind, before = order[chosen], np.repeat(np.arange(len(sizes)), sizes)[chosen], before[chosen]
    if not len(order):
        return
    of, place, where = of[order], place[order], where[order]
    rest = count[of] - 1 - place  # bytes of the context behind the window
    wide = max(1, int(rest.max()))
    tail = np.zeros((len(of), -(-wide // 8) * 8), np.uint8)
    some = gathered(np.zeros(len(of), np.int64), rest)
    tail[np.repeat(np.arange(len(of)), rest), some] = data[np.repeat(where + n, rest) + some]
    keys = tail.view(">u8")
    order = np.lexsort((rest, *[keys[:, k] for k in range(keys.shape[1] - 1, -1, -1)], kind))
    of, place, where, rest, kind, before, tail = (x[order] for x in (of, place, where, rest, kind, before, tail))
    differ = tail[1:] != tail[:-1]
    shared = np.where(differ.any(1), differ.argmax(1), tail.shape[1])
    shared = np.minimum(shared, np.minimum(rest[1:], rest[:-1])) + n
    equal = kind[1:] == kind[:-1]
    for k in range(0, len(equal), 50_000):  # hashes may collide: the bytes decide
        a, b = where[k : k + 50_001][:-1], where[k + 1 : k + 50_001]
        window = np.arange(n)
        equal[k : k + 50_000] &= (data[a[:, None] + window] == data[b[:, None] + window]).all(1)
    lcp = np.concatenate(([0], np.where(equal, shared, 0)))
    triple = (rows["start"][of] + place, rows["key"][of], rows["doc"][of], ~rows["none"][of])
    by = np.lexsort(triple)
    rank = np.empty(len(of), np.int64)  # equal for the same place of repeated rows
    rank[by] = np.concatenate(([0], np.cumsum(np.any([x[by][1:] != x[by][:-1] for x in triple], axis=0))))
    found = np.array(list(intervals(lcp.tolist(), before.tolist(), rank.tolist(), n)), np.int64).reshape(-1, 4)
    if not len(found):
        return
    size = found[:, 1] - found[:, 0] + 1
    entry = gathered(found[:, 0], size)
    long = np.repeat(found[:, 2], size)
    name = np.repeat(_names(data, where[found[:, 0]], found[:, 2]), size)
    yield of[entry], place[entry], long, rank[entry] == np.repeat(found[:, 3], size), name


def _names(data: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Names of repeats: a hash of their bytes."""
    mixed = words(data)
    ends = span_hash(mixed, ANCHOR, at) * _M[3] ^ span_hash(mixed, ANCHOR, at + length - ANCHOR) * _M[4]
    for k in range(0, int(length.max()) - 8, 8):
        ends += np.where(k + 8 <= length, mixed[at + np.minimum(k, length - 8)] * _M[k // 8 % 5], np.uint64(0))
        ends ^= ends >> np.uint64(27)
        ends *= _M[1]
    return ends ^ length.astype(np.uint64)


def _repeats(n: int, labels: list[int], every: bool):
    """Reduce side: contexts by part -> repeats by the part of their document.

    ``every``: all occurrences of all maximal repeats; else only the longest
    for each place, and no firsts.
    """

    def settle(rows: np.ndarray, data: np.ndarray) -> Iterator[np.ndarray]:
        for of, place, length, first, name in maximal(rows, data, n):
            if not every:
                of, place, length, name = of[~first], place[~first], length[~first], name[~first]
                order = np.lexsort((-length, place, of))
                keep = np.concatenate(([True], (np.diff(of[order]) != 0) | (np.diff(place[order]) != 0))) if len(order) else np.empty(0, bool)
                order = order[keep]
                of, place, length, name = of[order], place[order], length[order], name[order]
                first = np.zeros(len(of), bool)
            yield table(doc=rows["doc"][of], none=rows["none"][of], key=rows["key"][of], name=name, start=rows["start"][of] + place, size=length, first=first)

    def one(heads: list[np.ndarray], bodies: list[bytes]) -> Iterator[np.ndarray]:
        rows = np.concatenate(heads)
        expand = zstandard.ZstdDecompressor()
        offset, text = [], []
        for head, body in zip(heads, bodies):
            raw = expand.decompress(body)
            offset.append(np.frombuffer(raw, np.uint16, len(head)))
            text.append(np.frombuffer(raw, np.uint8, offset=2 * len(head)))
        offset, text = np.concatenate(offset), np.concatenate(text)
        length = rows["size"].astype(np.int64) + n - 1
        at = np.cumsum(length) - length
        anchor = np.zeros(len(rows), np.uint64)
        for own, place, size in ((np.flatnonzero(offset != WHOLE), at + offset, ANCHOR), (np.flatnonzero(offset == WHOLE), at, n)):
            for k in np.array_split(own, len(own) * size // 2_400_000 + 1):
                if len(k):
                    anchor[k] = span_hash(words(text[gathered(place[k], np.full(len(k), size))]), size, np.arange(len(k)) * size)
        order = np.argsort(anchor, kind="stable")
        edge = np.concatenate(([0], np.flatnonzero(np.diff(anchor[order])) + 1, [len(order)]))
        several = np.diff(edge) > 1
        windows = np.add.reduceat(rows["size"][order].astype(np.int64), edge[:-1]) * several
        for k in np.flatnonzero(windows > CHUNK).tolist():
            yield from singly(rows, text, at, order[edge[k] : edge[k + 1]])
        several &= windows <= CHUNK
        windows *= several
        chunk = np.cumsum(windows) // CHUNK
        for c in np.unique(chunk[several]).tolist():
            own = np.flatnonzero((chunk == c) & several)
            picked = order[gathered(edge[own], edge[own + 1] - edge[own])]
            yield from settle(rows[picked], text[gathered(at[picked], length[picked])])

    def singly(rows: np.ndarray, text: np.ndarray, at: np.ndarray, picked: np.ndarray) -> Iterator[np.ndarray]:
        """The windows of one large anchor, each a context of its own, by
        ranges of their hashes."""
        count = rows["size"][picked].astype(np.int64)
        h = np.empty(int(count.sum()), np.uint64)
        ends = np.cumsum(count)
        for low in range(0, len(picked), 4096):
            own, high = picked[low : low + 4096], min(low + 4096, len(picked))
            length = count[low:high] + n - 1
            begin = np.cumsum(length) - length
            mixed = words(text[gathered(at[own], length)])
            h[ends[low] - count[low] : ends[high - 1]] = span_hash(mixed, n, gathered(begin, count[low:high]))
        slices = -(-len(h) // (CHUNK // 2))
        kind = ((h >> np.uint64(20)) % np.uint64(slices)).astype(np.int32)
        del h
        for k in range(slices):
            window = np.flatnonzero(kind == k)
            if not len(window):
                continue
            of = np.searchsorted(ends, window, "right")
            place = window - (ends[of] - count[of])
            own = rows[picked[of]]
            own["start"] += place.astype(np.uint32)
            own["size"] = 1
            yield from settle(own, text[gathered(at[picked[of]] + place, np.full(len(of), n))])

    def blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[Blob]:
        held: list[np.ndarray] = []
        for g in groups(batches, ["part", "unit"]):
            heads, bodies = [unpack(h) for h in g.column("head").to_pylist()], g.column("body").to_pylist()
            held += [h for h, b in zip(heads, bodies) if b is None]
            sent = [k for k, b in enumerate(bodies) if b is not None]
            if sent:
                held += one([heads[k] for k in sent], [bodies[k] for k in sent])
            if sum(map(len, held)) >= 1_000_000:
                yield from given(held)
                held = []
        yield from given(held)

    def given(held: list[np.ndarray]) -> Iterator[Blob]:
        found = np.concatenate([ROWS, *held])
        if not every:
            found["name"] = 0
        for part, unit, own in by_unit(found["key"], labels):
            yield part, unit, pack(found[own]), None

    return lambda batches: handed(blobs(batches))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``none, doc, key, data``: whether the id is null; the id, or a hash of
    the text in its place; 64 bits of the hash of id and text. So rows without
    an id are told apart by 128 bits. Null ids come first in their order."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("data"))
    return rows.select(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.xxhash64(F.lit(7), "data")).alias("doc"),
                       F.xxhash64("doc_id", "data").alias("key"), "data")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of text -> the hashes of their k-grams, and how many."""
    for batch in batches:
        held = [span_hash(words(np.frombuffer(x.as_buffer(), np.uint8)), ANCHOR) for x in batch.column(0)]
        found, times = np.unique(np.concatenate(held), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(times)], ["h", "times"])


def hot_anchors(keyed: DataFrame, n: int) -> np.ndarray:
    """Sorted hashes of the k-grams that stand in very many places."""
    picked = F.filter(F.sequence(F.lit(0), F.floor((F.length("data") - ANCHOR) / STRETCH).cast("int")),
                      lambda k: F.pmod(F.xxhash64("doc", "key", k), F.lit(SAMPLE)) == 0)
    cut = F.transform(picked, lambda k: F.substring("data", k * STRETCH + 1, F.lit(STRETCH + ANCHOR - 1)))
    sample = keyed.where(F.length("data") >= n).select(F.explode(cut).alias("data")).mapInArrow(_counted, "h long, times long")
    grams = sample.groupBy("h").agg(F.sum("times").alias("times")).where(F.col("times") >= HOT)
    grams = write_cut(grams, "suffix-hot")
    # so many at most have as many occurrences as this: all of them have HOT
    # times MAX_HOT together
    least = max(HOT, -(-(grams.agg(F.sum("times")).first()[0] or 0) // MAX_HOT))
    common = grams.where(F.col("times") >= least).select("h").toArrow()
    drop_cut(grams)
    return np.sort(common.column(0).to_numpy().astype(np.int64).view(np.uint64))


def _found(keyed: DataFrame, n: int, labels: list[int], every: bool) -> DataFrame:
    if not ANCHOR + 8 <= n <= 1 << 16:
        raise ValueError(f"min_length must be from {ANCHOR + 8} to {1 << 16}")
    contexts = keyed.where(F.length("data") >= n).select("none", "doc", "key", "data").mapInArrow(_contexts(n, labels, hot_anchors(keyed, n)), SENT)
    return contexts.repartition("part").sortWithinPartitions("part", "unit").mapInArrow(_repeats(n, labels, every), SENT)


def maximal_repeats(docs: DataFrame, min_length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``repeat, length, doc_id, start, first``: every occurrence of every
    maximal repeat of ``min_length`` bytes or more, within contexts (longer
    repeats come as overlapping pieces). ``first``: no occurrence starts in
    a document of smaller id, or earlier in the same. Copies of a context
    that a map task combined come under the name of the whole context."""
    labels = even_labels(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for head in batch.column(2).to_pylist():
                rows = unpack(head)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["name"].view(np.int64)), pa.array(rows["size"].astype(np.int64)), pa.array(rows["doc"], mask=rows["none"]),
                     pa.array(rows["start"].astype(np.int64)), pa.array(rows["first"])], ["repeat", "length", "doc_id", "start", "first"])

    found = _found(_keyed(docs, id_col, text_col), min_length, labels, True)
    return found.mapInArrow(run, "repeat long, length long, doc_id long, start long, first boolean")


def _texts(labels: list[int]):
    """Whole texts, packed by the unit of their document."""

    def blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[Blob]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            none, doc, key = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            data = batch.column(3).to_pylist()
            rows = table(doc=doc, none=none, key=key.view(np.uint64), size=np.array([len(x) for x in data], np.int64))
            for part, unit, own in by_unit(rows["key"], labels):
                yield part, unit, pack(rows[own]), press.compress(b"".join([data[k] for k in own.tolist()]))

    return lambda batches: handed(blobs(batches))


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts and repeats of a part -> texts without the bytes of the repeats."""
    names = ["doc_id", "n_bytes", "spans", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
    expand = zstandard.ZstdDecompressor()
    for g in groups(batches, ["part", "unit"]):
        heads, bodies = [unpack(h) for h in g.column("head").to_pylist()], g.column("body").to_pylist()
        spans = np.concatenate([ROWS, *[h for h, b in zip(heads, bodies) if b is None]])
        spans = spans[np.argsort(spans["key"], kind="stable")]
        for rows, body in zip(heads, bodies):
            if body is None:
                continue
            data, at = expand.decompress(body), 0
            begin, end = np.searchsorted(spans["key"], rows["key"], "left"), np.searchsorted(spans["key"], rows["key"], "right")
            out: list[list] = [[], [], [], []]
            for none, doc, size, a, b in zip(rows["none"].tolist(), rows["doc"].tolist(), rows["size"].tolist(), begin.tolist(), end.tolist()):
                text = data[at : at + size]
                at += size
                own = spans[a:b]
                own = own[(own["doc"] == doc) & (own["none"] == none)]
                edges = []
                if len(own):
                    step = np.zeros(size + 1, np.int32)
                    start = own["start"].astype(np.int64)
                    np.add.at(step, start, 1)
                    np.add.at(step, start + own["size"], -1)
                    gone = np.cumsum(step[:-1]) > 0
                    turn = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False]))))
                    edges = [{"start": int(x), "end": int(y)} for x, y in zip(turn[::2], turn[1::2])]
                    text = np.frombuffer(text, np.uint8)[~gone].tobytes()
                for column, value in zip(out, (None if none else doc, size, edges, text)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], names)


def dedup(docs: DataFrame, min_length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: every text (UTF-8 bytes) without the
    bytes that a string of ``min_length`` bytes covers which also starts
    earlier: in a document of smaller id, or further ahead in the same.

    ``spans``: the maximal removed runs (start, end). Strings are judged on
    the input. A null text is empty; an empty or short one keeps all. Null
    ids come before all others. Rows of one id with different texts are
    documents in an order of their own; rows equal in id and text are one
    document, and each gets its result. No rows give no rows; columns of
    other names are not read.
    """
    labels = even_labels(docs.sparkSession)
    keyed = _keyed(docs, id_col, text_col)
    texts = keyed.select("none", "doc", "key", "data").mapInArrow(_texts(labels), SENT)
    both = texts.unionByName(_found(keyed, min_length, labels, False)).repartition("part").sortWithinPartitions("part", "unit")
    return both.mapInArrow(_removed, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return dedup(docs).select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))

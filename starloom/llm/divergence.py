"""Source divergence audit by a minimal-perfect-hash recount.

Which sources of a language use its vocabulary unlike the others, and which
terms make the difference?

The first pass counts, exactly, in how many documents of a language each
term stands, and keeps the terms of three or more. The kept terms of a
language are dealt into shards by hash, and each shard gets a minimal
perfect hash: bitmaps, level under level, where a key that shares its place
moves on to the next level; the rank of its bit is its slot. The keys are
stored in slot order, so a term that was not kept is told from those that
were.

The second pass counts the terms of every (language, source) group again, in
dense arrays of slots. Where all shards together are small (``BROADCAST``
bytes, measured before) every task has them and adds to slots at once.
Where they are not, each task sends the terms it has counted to their
shard, and the same lookup runs there. The results are the same.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import drop_cut, utf8, write_cut
from starloom.llm.links import in_blocks

#: Documents of a language that a kept term stands in, at least.
MIN_DOCS = 3
#: Terms of a shard, about.
SHARD = 1 << 15
#: Bytes of perfect hashes that are broadcast, at most; beyond, the counted
#: terms travel to their shard.
BROADCAST = 32 << 20
#: Distinct terms that a task counts before it hands them on.
HELD = 400_000
#: Bytes of dense slots that a task holds before it hands them on.
DENSE = 64 << 20
#: Sources of a block: a unit of work compares two blocks over one shard.
BLOCK = 64
#: Ranks of the ``term`` part.
TOP = 200
SCALE = 1_000_000_000

#: Every byte that is no part of a term becomes a blank; A-Z become a-z.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text: runs of ASCII letters (in lower case) and
    of characters beyond ASCII."""
    return text.translate(FOLD).split()


def hashed(keys: list[bytes]) -> np.ndarray:
    """The hash that ``F.xxhash64`` gives the same bytes, unsigned."""
    return np.fromiter((xxhash.xxh64_intdigest(k, 42) for k in keys), np.uint64, len(keys))


# --- minimal perfect hash ---------------------------------------------------

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _places(h: np.ndarray, level: int, size: int) -> np.ndarray:
    x = h + np.full(1, level + 1, np.uint64) * _MIX[0]
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Slots 0 .. n - 1 of n distinct keys; -1 for any other bytes.

    Keys that no level parts (equal 64-bit hashes, or the last few) have the
    last slots and are found by their bytes.
    """

    LEVELS = 24

    def __init__(self, levels: list[np.ndarray], offsets: np.ndarray, blob: np.ndarray) -> None:
        self.levels, self.offsets, self.blob = levels, offsets, blob
        self.ranks, start = [], 0
        for words in levels:
            ones = np.bitwise_count(words).astype(np.int64)
            self.ranks.append(start + np.cumsum(ones) - ones)
            start += int(ones.sum())
        data = blob.tobytes()
        self.rest = {data[a:b]: k for k, (a, b) in enumerate(zip(offsets[start:-1].tolist(), offsets[start + 1 :].tolist()), start)}

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @classmethod
    def build(cls, keys: list[bytes]) -> PerfectHash:
        h = hashed(keys)
        left, levels, order = np.arange(len(keys)), [], []
        for level in range(cls.LEVELS):
            if not len(left):
                break
            words = -(-2 * len(left) // 64)
            place = _places(h[left], level, 64 * words)
            alone = np.bincount(place, minlength=64 * words)[place] == 1
            bits = np.zeros(64 * words, bool)
            bits[place[alone]] = True
            levels.append(np.packbits(bits, bitorder="little").view(np.uint64))
            order.append(left[alone][np.argsort(place[alone])])
            left = left[~alone]
        slots = np.concatenate([np.empty(0, np.int64), *order, left])
        stored = [keys[k] for k in slots.tolist()]
        offsets = np.concatenate(([0], np.cumsum([len(k) for k in stored], dtype=np.int64))).astype(np.int64)
        return cls(levels, offsets, np.frombuffer(b"".join(stored), np.uint8))

    def slots(self, keys: list[bytes], h: np.ndarray) -> np.ndarray:
        """The slot of each of ``keys`` (``h``: their hashes)."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (words, ranks) in enumerate(zip(self.levels, self.ranks)):
            if not len(open_):
                break
            place = _places(h[open_], level, 64 * len(words))
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            value = words[word]
            hit = (value >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(value & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[open_[hit]] = (ranks[word] + below)[hit]
            open_ = open_[~hit]
        found = np.flatnonzero(out >= 0)  # the stored key decides
        sizes = np.fromiter((len(keys[k]) for k in found.tolist()), np.int64, len(found))
        same = self.offsets[out[found] + 1] - self.offsets[out[found]] == sizes
        out[found[~same]] = -1
        found, sizes = found[same], sizes[same]
        if len(found):
            data = np.frombuffer(b"".join([keys[k] for k in found.tolist()]), np.uint8)
            ends = np.cumsum(sizes)
            stored = self.blob[np.repeat(self.offsets[out[found]] - (ends - sizes), sizes) + np.arange(ends[-1])]
            out[found[np.add.reduceat(stored != data, ends - sizes, dtype=np.int64) > 0]] = -1
        if self.rest:
            for k in np.flatnonzero(out < 0).tolist():
                out[k] = self.rest.get(keys[k], -1)
        return out

    def key(self, slot: int) -> bytes:
        return self.blob[self.offsets[slot] : self.offsets[slot + 1]].tobytes()

    def dump(self) -> bytes:
        parts = [np.array([len(self.levels), len(self)], np.int64).tobytes(), np.array([len(x) for x in self.levels], np.int64).tobytes()]
        return b"".join([*parts, *[x.tobytes() for x in self.levels], self.offsets.tobytes(), self.blob.tobytes()])

    @classmethod
    def load(cls, data: bytes) -> PerfectHash:
        n, size = np.frombuffer(data, np.int64, 2).tolist()
        at, levels = 16 + 8 * n, []
        for words in np.frombuffer(data, np.int64, n, 16).tolist():
            levels.append(np.frombuffer(data, np.uint64, words, at))
            at += 8 * words
        offsets = np.frombuffer(data, np.int64, size + 1, at)
        return cls(levels, offsets, np.frombuffer(data, np.uint8, offset=at + 8 * (size + 1)))


# --- first pass: exact document frequencies ----------------------------------

FOUND = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("docs", pa.int64())])


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Counter] = defaultdict(Counter)

    def handed() -> Iterator[pa.RecordBatch]:
        for lang, counted in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counted), pa.string()), pa.array(list(counted), pa.binary()), pa.array(list(counted.values()), pa.int64())], schema=FOUND)
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("data")):
            held[lang].update(set(terms(text.as_py())))
            if sum(map(len, held.values())) > HELD:
                yield from handed()
    yield from handed()


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, term, docs``: the terms of a language that ``min_docs`` of its
    documents hold, with the number of these (``docs``: ``lang, data``)."""
    counted = docs.select("lang", "data").mapInArrow(_document_counts, "lang string, term binary, docs long")
    return counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)


HASHES = "lang string, shard int, body binary"


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms sorted by language and shard -> a perfect hash for each."""
    at, keys = None, []

    def done() -> Iterator[pa.RecordBatch]:
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array([at[0]], pa.string()), pa.array([at[1]], pa.int32()), pa.array([PerfectHash.build(keys).dump()], pa.binary())], ["lang", "shard", "body"])

    for batch in batches:
        for lang, shard, term in zip(*(batch.column(c).to_pylist() for c in ("lang", "shard", "term"))):
            if at != (lang, shard):
                yield from done()
                at, keys = (lang, shard), []
            keys.append(term)
    yield from done()


# --- second pass: counts in dense slots --------------------------------------

def packed(counts: np.ndarray) -> bytes:
    """Dense slots as their places and values other than 0, compressed."""
    at = np.flatnonzero(counts)
    return zstandard.ZstdCompressor(level=1).compress(at.astype(np.uint32).tobytes() + counts[at].astype(np.int64).tobytes())


def unpacked(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(body)
    n = len(data) // 12
    return np.frombuffer(data, np.uint32, n).astype(np.int64), np.frombuffer(data, np.int64, n, 4 * n)


#: ``kind``: 0 a perfect hash, 1 counts of slots, 2 counted terms.
SENT = pa.schema([("lang", pa.string()), ("shard", pa.int32()), ("kind", pa.int32()), ("source", pa.string()), ("body", pa.binary())])
SENT_DDL = "lang string, shard int, kind int, source string, body binary"


def _sent(lang: str, shard: int, kind: int, source: str, body: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((lang, shard, kind, source, body), SENT.types)], schema=SENT)


def _group_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, Counter]]:
    """Terms of each (language, source) group with their occurrences."""
    held: dict[tuple[str, str], Counter] = defaultdict(Counter)
    for batch in batches:
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("data")):
            held[lang, source].update(terms(text.as_py()))
            if sum(map(len, held.values())) > HELD:
                yield from ((*k, v) for k, v in held.items())
                held.clear()
    yield from ((*k, v) for k, v in held.items())


def _by_shard(h: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Indices of the keys of each shard that has any."""
    shard = np.mod(h.view(np.int64), shards)
    order = np.argsort(shard, kind="stable")
    edges = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(edges)).tolist():
        yield s, order[edges[s] : edges[s + 1]]


def _recount_here(hashes, shards: int):
    """Second pass where every task holds all perfect hashes (broadcast)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, dict[int, PerfectHash]] = defaultdict(dict)
        for lang, shard, body in hashes.value:
            tables[lang][shard] = PerfectHash.load(body)
        dense: dict[tuple[str, int, str], np.ndarray] = {}
        size = 0
        for lang, source, counted in _group_counts(batches):
            own = tables.get(lang)
            if not own:
                continue
            keys, times = list(counted), np.fromiter(counted.values(), np.int64, len(counted))
            h = hashed(keys)
            for s, k in _by_shard(h, shards):
                table = own.get(s)
                if table is None:
                    continue
                slot = table.slots([keys[x] for x in k.tolist()], h[k])
                k, slot = k[slot >= 0], slot[slot >= 0]
                if not len(k):
                    continue
                if (lang, s, source) not in dense:
                    dense[lang, s, source] = np.zeros(len(table), np.int64)
                    size += 8 * len(table)
                dense[lang, s, source][slot] += times[k]
            if size > DENSE:
                yield from (_sent(l, s, 1, g, packed(counts)) for (l, s, g), counts in dense.items())
                dense, size = {}, 0
        yield from (_sent(l, s, 1, g, packed(counts)) for (l, s, g), counts in dense.items())

    return run


def _counted_terms(shards: int):
    """Second pass where the terms travel: the counts of a task, by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for lang, source, counted in _group_counts(batches):
            keys, times = list(counted), np.fromiter(counted.values(), np.int64, len(counted))
            for s, k in _by_shard(hashed(keys), shards):
                yield _sent(lang, s, 2, source, press.compress(len(k).to_bytes(8, "little") + times[k].tobytes() + b" ".join([keys[x] for x in k.tolist()])))

    return run


SLOTS = pa.schema([("lang", pa.string()), ("shard", pa.int32()), ("source", pa.string()), ("whole", pa.bool_()), ("total", pa.int64()), ("body", pa.binary())])
SLOTS_DDL = "lang string, shard int, source string, whole boolean, total long, body binary"


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by language, shard, kind and source: the perfect hash,
    then counts of slots (or of terms) -> the slots of every source, and
    (``whole``) of the language."""
    at = source = table = counts = lang_counts = None

    def row(name: str | None, values: np.ndarray) -> pa.RecordBatch:
        cells = (*at, name, name is None, int(values.sum()), packed(values))
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(cells, SLOTS.types)], schema=SLOTS)

    for batch in batches:
        for lang, shard, kind, name, body in zip(*(batch.column(c).to_pylist() for c in SENT.names)):
            if kind == 0 or name != source:
                if source is not None:
                    yield row(source, counts)
                    lang_counts += counts
                source = None
            if kind == 0:
                if at is not None:
                    yield row(None, lang_counts)
                at, table = (lang, shard), PerfectHash.load(body)
                lang_counts = np.zeros(len(table), np.int64)
                continue
            if source is None:
                source, counts = name, np.zeros(len(table), np.int64)
            if kind == 1:
                slot, times = unpacked(body)
            else:
                data = zstandard.ZstdDecompressor().decompress(body)
                n = int.from_bytes(data[:8], "little")
                times, keys = np.frombuffer(data, np.int64, n, 8), data[8 + 8 * n :].split(b" ")
                slot = table.slots(keys, hashed(keys))
                slot, times = slot[slot >= 0], times[slot >= 0]
            counts[slot] += times
    if source is not None:
        yield row(source, counts)
        lang_counts += counts
    if at is not None:
        yield row(None, lang_counts)


# --- the audit ---------------------------------------------------------------

def shares(counts: np.ndarray, total: int, size: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / (total + size)), exactly."""
    whole = int(total) + int(size)
    if whole > 9_000_000_000_000_000:  # a step below would leave 64 bits
        return np.array([1 + SCALE * (int(c) + 1) // whole for c in counts], np.int64)
    rest = counts + 1
    out, rest = rest // whole, rest % whole
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // whole, rest % whole
    return out + 1


AUDITED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.binary()), ("value", pa.int64())])
AUDITED_DDL = "lang string, source string, part string, item binary, value long"


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by language, shard, pair of blocks and kind (0 the perfect
    hash, 1 the language's slots, 2 a source's slots) -> this shard's part of
    every pair's value, and the leading terms of every source."""
    at = table = None
    unit: list[tuple[int, str, np.ndarray]] = []

    def done() -> Iterator[pa.RecordBatch]:
        if not unit:
            return
        lang, _, lo, hi = at
        out: list[tuple[str, str, bytes, int]] = []
        share = np.stack([p for _, _, p in unit])
        for a, (own, name, p) in enumerate(unit):
            others = [b for b, (block, _, _) in enumerate(unit) if b != a and (lo == hi or block != own)]
            value = np.zeros(len(others), np.int64)
            for k in range(0, p.size, 4096):
                q = share[others, k : k + 4096]
                value += ((p[k : k + 4096] - q) ** 2 // q).sum(1)
            out += [(name, "pair", unit[b][1].encode(), v) for b, v in zip(others, value.tolist())]
        out += leading
        names, parts, items, values = zip(*out) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(([lang] * len(out), names, parts, items, values), AUDITED.types)], schema=AUDITED)

    leading: list[tuple[str, str, bytes, int]] = []
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("lang", "shard", "lo", "hi", "kind", "own", "source", "body", "total", "terms"))
        for lang, shard, lo, hi, kind, own, name, body, total, size in zip(*columns):
            if at != (lang, shard, lo, hi):
                yield from done()
                at, unit, leading, table, q = (lang, shard, lo, hi), [], [], None, None
            if kind == 0:
                table = PerfectHash.load(body)
                n_slots = len(table)
                continue
            counts = np.zeros(n_slots, np.int64)
            if body is not None:
                slot, times = unpacked(body)
                counts[slot] = times
            p = shares(counts, total, size)
            if kind == 1:
                q = p
                continue
            unit.append((own, name, p))
            if lo == hi:
                leading += [(name, "term", item, value) for item, value in _leading(table, counts, p, q)]
    yield from done()


def _leading(table: PerfectHash, counts: np.ndarray, p: np.ndarray, q: np.ndarray) -> Iterator[tuple[bytes, int]]:
    """The TOP terms that stand out, ties by their bytes."""
    own = np.flatnonzero((counts > 0) & (p > q))
    value = (p[own] - q[own]) ** 2 // q[own]
    if len(own) > TOP:
        least = np.partition(value, len(own) - TOP)[len(own) - TOP]
        own, value = own[value >= least], value[value >= least]
    ranked = sorted(zip((-value).tolist(), map(table.key, own.tolist())))
    return ((key, -v) for v, key in ranked[:TOP])


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far the sources of a
    language lie from each other (part ``pair``: item another source) and
    which terms set a source apart from its language (part ``term``: the
    ``TOP`` first).

    A language's vocabulary is the terms of ``min_docs`` or more of its
    documents. A share is 1 + floor(10^9 (count + 1) / (N + V)) with N the
    group's occurrences of the V kept terms; a term's value is
    floor((p - q)^2 / q), q the share with the other source, or with the
    language; a pair's is the sum over all kept terms (0 without any).
    Ranks go by value downwards, then by the item's bytes.

    Null texts, languages and sources count as ''. Rows that are equal count
    each. A group whose documents hold no term has its pairs and no terms; a
    single source has no pairs. No rows give no rows; other columns are not
    read, whatever their names. Texts of any length are read whole.
    """
    spark = docs.sparkSession
    empty = F.lit("")
    rows = docs.select(F.coalesce(F.col(lang_col), empty).alias("lang"), F.coalesce(F.col(source_col), empty).alias("source"), utf8(text_col).alias("data"))
    kept = write_cut(kept_terms(rows, min_docs), "divergence-terms")
    sizes = write_cut(kept.groupBy("lang").agg(F.count("*").alias("terms")), "divergence-sizes")
    shards = -(-(sizes.agg(F.max("terms")).first()[0] or 1) // SHARD)
    dealt = kept.select("lang", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int").alias("shard"), "term")
    hashes = write_cut(dealt.repartition("lang", "shard").sortWithinPartitions("lang", "shard", "term").mapInArrow(_hashes, HASHES), "divergence-hashes")
    drop_cut(kept)
    if (hashes.agg(F.sum(F.length("body") + F.length("lang") + 64)).first()[0] or 0) <= BROADCAST:
        tables = spark.sparkContext.broadcast([tuple(r) for r in hashes.collect()])
        counted = rows.mapInArrow(_recount_here(tables, shards), SENT_DDL)
    else:
        counted = rows.mapInArrow(_counted_terms(shards), SENT_DDL)
    both = counted.unionByName(hashes.select("lang", "shard", F.lit(0).alias("kind"), F.lit("").alias("source"), "body"))
    by_shard = both.repartition("lang", "shard").sortWithinPartitions("lang", "shard", "kind", "source")
    slots = write_cut(by_shard.mapInArrow(_summed, SLOTS_DDL), "divergence-slots")
    groups = write_cut(rows.select("lang", "source").distinct(), "divergence-groups")

    totals = slots.groupBy("lang", "source", "whole").agg(F.sum("total").alias("total"))
    members = groups.join(totals.where("not whole").drop("whole"), ["lang", "source"], "left").withColumn("total", F.coalesce("total", F.lit(0).cast("long")))
    members = members.join(groups.groupBy("lang").agg(F.count("*").alias("n_sources")), "lang")
    parts = hashes.select("lang", "shard").join(sizes, "lang")
    blocked = in_blocks(members, "n_sources", "source", BLOCK)
    sources = (blocked.join(parts, "lang").join(slots.where("not whole").select("lang", "shard", "source", "body"), ["lang", "shard", "source"], "left")
               .select("lang", "shard", "lo", "hi", F.lit(2).alias("kind"), "own", "source", "body", "total", "terms"))
    diagonal = blocked.where("lo = hi").select("lang", "lo", "hi").distinct()
    units = blocked.select("lang", "lo", "hi").distinct()
    nothing = F.lit(None).cast("string")
    whole = (slots.where("whole").select("lang", "shard", "body").join(totals.where("whole").select("lang", "total"), "lang").join(parts, ["lang", "shard"]).join(diagonal, "lang")
             .select("lang", "shard", "lo", "hi", F.lit(1).alias("kind"), F.lit(0).alias("own"), nothing.alias("source"), "body", "total", "terms"))
    keys = (hashes.join(units, "lang").join(sizes, "lang")
            .select("lang", "shard", "lo", "hi", F.lit(0).alias("kind"), F.lit(0).alias("own"), nothing.alias("source"), "body", F.lit(0).cast("long").alias("total"), "terms"))
    work = sources.unionByName(whole).unionByName(keys).repartition("lang", "shard", "lo", "hi").sortWithinPartitions("lang", "shard", "lo", "hi", "kind", "source")
    found = write_cut(work.mapInArrow(_audited, AUDITED_DDL), "divergence-found")
    drop_cut(hashes, slots)

    # a language without kept terms has no shard: its pairs are 0
    bare = groups.join(sizes, "lang", "left_anti")
    zero = bare.join(bare.select("lang", F.col("source").alias("item")), "lang").where("source <> item").select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value"))
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    listed = pairs.unionByName(found.where("part = 'term'")).withColumn("item", F.col("item").cast("string")).unionByName(zero)
    ranked = listed.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= TOP))

"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of word 5-grams. Equal sets are one class. MinHash bands
propose pairs of classes; each pair's MinHash values are then compared a few
at a time, and the pair is dropped as soon as the posterior probability that
its similarity reaches the threshold, given the matches so far, is below a
tolerance. The sets of what is left are compared exactly.

A pair is looked at only in the first band that it shares, so it is verified
once without any table of pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import begin, drop_cut, free, keeps, write_cut
from starloom.llm.links import block_pairs, components, groups, in_blocks, linked_batch, local_links

WORDS = 5
THRESHOLD = Fraction(4, 5)
#: Bands of ROWS MinHash values. A pair at the threshold shares none with
#: probability (1 - 0.8 ** 3) ** 21 < 3e-7.
BANDS, ROWS = 21, 3
#: MinHash values compared at a time, and in all.
STEP, HASHES = 16, 64
#: A pair is dropped when the posterior of reaching the threshold is below.
TOLERANCE = 1e-7
#: Words of a worker's memo of word hashes; at the bound it starts anew.
MEMO_ENTRIES = 300_000
#: Units of work whose members' sets have so many cells at most are compared
#: by matrix products, CHUNK_CELLS at a time.
DENSE_CELLS, CHUNK_CELLS = 1 << 25, 1 << 21

_R = np.random.Generator(np.random.PCG64(20240501))
_A = _R.integers(0, 1 << 63, HASHES, np.uint64) << np.uint64(1) | np.uint64(1)
_B = _R.integers(0, 1 << 63, HASHES, np.uint64)
_P = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


@lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    return WordHashes()


keeps("jaccard", word_hashes.cache_clear)


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of five words of a text,
    lower case, split at white space; all its words if there are fewer."""
    words = (text or "").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(word_hashes().__getitem__, words), np.uint64, len(words))
    n = max(1, len(w) - WORDS + 1)
    h = np.zeros(n, np.uint64)
    for k in range(min(WORDS, len(w))):
        x = w[k : k + n] * _P[k]
        h += x ^ x >> np.uint64(31)
        h *= _P[(k + 2) % 5]
    h ^= h >> np.uint64(29)
    h *= _P[1]
    h ^= h >> np.uint64(32)
    return np.unique(h)


def minhash(s: np.ndarray) -> np.ndarray:
    """HASHES 32-bit MinHash values."""
    out = np.empty(HASHES, np.uint64)
    for k in range(HASHES):
        out[k] = (s * _A[k] + _B[k]).min()
    out = (out ^ out >> np.uint64(32)) * _P[0]
    return (out >> np.uint64(32)).astype("<u4")


@lru_cache(maxsize=4)
def least_matches(threshold: Fraction = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """For n = 0 to HASHES compared values, the fewest matches with which a
    pair stays: with a uniform prior the posterior of similarity >= t after m
    of n matches is P(Binomial(n + 1, t) <= m)."""
    t, out = float(threshold), []
    for n in range(HASHES + 1):
        tail, m = 0.0, -1
        while tail < tolerance:
            m += 1
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def candidates(sig: np.ndarray, i: np.ndarray, j: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that incremental comparison doesn't drop, without those
    that share an earlier band."""
    need = least_matches()
    matched = np.zeros(len(i), np.int64)
    for at in range(0, HASHES, STEP):
        matched += (sig[i, at : at + STEP] == sig[j, at : at + STEP]).sum(1)
        stay = matched >= need[at + STEP]
        i, j, matched = i[stay], j[stay], matched[stay]
    if band and len(i):
        head = band * ROWS
        new = ~(sig[i, :head] == sig[j, :head]).reshape(len(i), band, ROWS).all(2).any(1)
        i, j = i[new], j[new]
    return i, j


def verified(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs reach the threshold, by exact set sizes."""
    sizes = np.array([len(s) for s in sets])
    if len(i) > 4 * len(sets):
        known, at = np.unique(np.concatenate(sets), return_inverse=True)
        if len(known) * len(sets) <= DENSE_CELLS:
            row, order = np.repeat(np.arange(len(sets), dtype=np.int32), sizes), np.argsort(at, kind="stable")
            row, at, width = row[order], at[order], max(1, CHUNK_CELLS // len(sets))
            both = np.zeros((len(sets), len(sets)), np.int64)
            for low in range(0, len(known), width):
                a, b = np.searchsorted(at, (low, low + width))
                cells = np.zeros((len(sets), width), np.float32)
                cells[row[a:b], at[a:b] - low] = 1
                both += (cells @ cells.T).astype(np.int64)
            common = both[i, j]
        else:
            common = None
    else:
        common = None
    if common is None:
        common = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j)], np.int64)
    num, den = THRESHOLD.numerator, THRESHOLD.denominator
    return common * (num + den) >= num * (sizes[i] + sizes[j])


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    begin("jaccard")
    for batch in batches:
        fp, size, sig = [], [], []
        for text in batch.column(2):
            s = shingles(text.as_py())
            size.append(len(s))
            fp.append(xxhash.xxh3_128_digest(s.tobytes()))
            sig.append(minhash(s).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(fp, pa.binary()), pa.array(size, pa.int64()), pa.array(sig, pa.binary())],
            ["doc_id", "text_hash", "fp", "size", "sig"])


def _pruned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each unit of work in which pairs stay."""
    begin("jaccard")
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary()]
    names = ["band", "bucket", "lo", "hi", "ids", "counts", "pairs"]
    out: list[tuple] = []
    for g in groups(batches, ["band", "bucket", "lo", "hi"]):
        if g.num_rows < 2:
            continue
        head = [g.column(c)[0].as_py() for c in names[:4]]
        i, j = block_pairs(g.column("own").to_numpy(), head[2], head[3])
        if not len(i):
            continue
        sig = np.frombuffer(b"".join(g.column("sig").to_pylist()), "<u4").reshape(g.num_rows, HASHES)
        kept = [candidates(sig, i[at : at + (1 << 18)], j[at : at + (1 << 18)], head[0]) for at in range(0, len(i), 1 << 18)]
        i, j = (np.concatenate(x) for x in zip(*kept))
        if not len(i):
            continue
        used, at = np.unique(np.concatenate([i, j]), return_inverse=True)
        ids, counts = g.column("fp").to_pylist(), g.column("copies").to_pylist()
        out.append((*head, [ids[x] for x in used], [counts[x] for x in used], at.astype("<u2").tobytes()))
        if len(out) >= 500:
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kinds[k]) for k in range(7)], names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kinds[k]) for k in range(7)], names)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    begin("jaccard")
    for batch in batches:
        sets = [shingles(t.as_py()).tobytes() for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["fp", "set"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    begin("jaccard")
    out: list[tuple[bytes, int, bytes]] = []
    for g in groups(batches, ["band", "bucket", "lo", "hi"]):
        g = g.sort_by("at")
        pairs = np.frombuffer(next(p for p in g.column("pairs").to_pylist() if p is not None), "<u2").astype(np.int64)
        i, j = pairs[: len(pairs) // 2], pairs[len(pairs) // 2 :]
        real = verified([np.frombuffer(s, np.uint64) for s in g.column("set").to_pylist()], i, j)
        out += local_links(g.column("fp").to_pylist(), g.column("copies").to_numpy(), i[real], j[real])
        if len(out) >= 5000:
            yield linked_batch(out)
            out = []
    yield linked_batch(out)


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, class_id, n_links, kept`` for every row.

    Two rows link if their shingle sets have Jaccard similarity 0.8 or more.
    ``class_id``: the least id reachable by links, itself included;
    ``n_links``: the rows directly linked, copies included; ``kept``: true
    for the rows of the id and text that the class is named by (repeated
    rows of it all say so; ``text_hash`` tells two texts of one id apart). A
    null or wordless text links with nothing. A null id comes last and
    names a class only where no other row is in it. No rows give no rows.
    Texts are read whole, whatever their length; other columns are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    signed = write_cut(texts.mapInArrow(_signatures, "doc_id long, text_hash long, fp binary, size long, sig binary"), "jaccard-signed")
    name = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    classes = write_cut(
        signed.where("size > 0").groupBy("fp").agg(F.min(name).alias("name"), F.count("*").alias("copies"), F.min("sig").alias("sig")), "jaccard-classes")

    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substring("sig", b * (4 * ROWS) + 1, F.lit(4 * ROWS))))
    banded = classes.select("fp", F.posexplode(keys).alias("band", "bucket"))
    shared = banded.groupBy("band", "bucket").agg(F.count("*").alias("members")).where("members > 1")
    members = banded.join(shared, ["band", "bucket"]).join(classes.select("fp", "copies", "sig"), "fp")
    unit = ["band", "bucket", "lo", "hi"]
    units = in_blocks(members, "members", "fp").select(*unit, "own", "fp", "copies", "sig")
    pruned = units.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(
        _pruned, "band int, bucket long, lo int, hi int, ids array<binary>, counts array<long>, pairs binary")
    pruned = write_cut(pruned, "jaccard-pruned")

    wanted = pruned.select(F.explode("ids").alias("fp")).distinct().join(classes.select("fp", "name.doc_id", "name.text_hash"), "fp")
    of = texts.alias("t").join(wanted.alias("w"), F.col("t.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("t.text_hash") == F.col("w.text_hash")))
    sets = of.select("fp", "text").mapInArrow(_sets, "fp binary, set binary").dropDuplicates(["fp"])
    at = F.posexplode(F.arrays_zip("ids", "counts")).alias("at", "member")
    rows = pruned.select(*unit, at, "pairs").select(
        *unit, "at", F.col("member.ids").alias("fp"), F.col("member.counts").alias("copies"), F.when(F.col("at") == 0, F.col("pairs")).alias("pairs"))
    rows = rows.join(sets, "fp").select(*unit, "at", "fp", "copies", "pairs", "set")
    linked = write_cut(rows.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(_verified, "id binary, links long, least binary"), "jaccard-linked")

    drop_cut(pruned)
    links = linked.groupBy("id").agg(F.sum("links").alias("links"))
    found = components(linked.select(F.col("id").alias("a"), F.col("least").alias("b")))
    named = (classes.select("fp", "name", "copies").join(links, F.col("fp") == F.col("id"), "left").drop("id")
             .join(found, F.col("fp") == F.col("id"), "left").drop("id")
             .select("fp", "name", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "fp").alias("component")))
    named = write_cut(named, "jaccard-named")
    drop_cut(classes, linked)
    heads = named.groupBy(F.col("component").alias("head")).agg(F.min("name").alias("class"))
    named = named.join(heads, F.col("component") == F.col("head")).select(F.col("fp").alias("_fp"), "class", "n_links")
    out = signed.select("doc_id", "text_hash", "fp", "size").join(named, (F.col("fp") == F.col("_fp")) & (F.col("size") > 0), "left")
    first = F.col("doc_id").eqNullSafe(F.col("class.doc_id")) & F.col("text_hash").eqNullSafe(F.col("class.text_hash"))
    return out.select(
        "doc_id", "text_hash", F.when(F.col("_fp").isNull(), F.col("doc_id")).otherwise(F.col("class.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), (F.col("_fp").isNull() | first).alias("kept"))


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (``doc_id, text`` and any others) that name their
    near-duplicate class, one of each; equal rows are one."""
    a, b, nth = (free(name, docs.columns) for name in ("_a", "_b", "_nth"))

    def keyed(df: DataFrame, text_hash) -> DataFrame:
        return df.withColumn(a, F.xxhash64("doc_id", text_hash)).withColumn(b, F.xxhash64(F.lit(1), "doc_id", text_hash))

    kept = keyed(join(docs).where("kept"), F.col("text_hash")).select(a, b).distinct()
    first = Window.partitionBy(a, b).orderBy(*[F.col(c) for c in docs.columns if c != "text"])
    found = keyed(docs, F.xxhash64("text")).join(kept, [a, b])
    return found.withColumn(nth, F.row_number().over(first)).where(F.col(nth) == 1).select(*docs.columns)

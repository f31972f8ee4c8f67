"""Document fingerprints by locally consistent parsing.

A text is parsed into phrases again and again. On each level, runs of one
symbol become a symbol; deterministic coin tossing then gives every symbol a
label below six that differs from its neighbours' and depends on a few
symbols before it alone; a phrase starts at each local maximum of the labels
and its name is a hash of its symbols. Phrase borders depend on their
surroundings only, so equal substrings have the same phrase names in their
interior wherever they stand, on every level. The fingerprint is a MinHash
sketch of the phrase names.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import even_labels

#: Levels whose phrase names are sketched, the lowest left out: its phrases
#: are a few characters long and common to all texts of a language.
FIRST_LEVEL, LEVELS = 2, 5
#: MinHash values of a fingerprint.
VALUES = 64
#: Code points parsed at a time (whole texts always).
BATCH = 1 << 19

_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]
_G = np.random.Generator(np.random.PCG64(20240601))
_A = _G.integers(0, 1 << 63, VALUES, np.uint64) << np.uint64(1) | np.uint64(1)
_B = _G.integers(0, 1 << 63, VALUES, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * _M[0]
    x = (x ^ x >> np.uint64(29)) * _M[1]
    return x ^ x >> np.uint64(32)


def tossed(x: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """Labels below six, unlike their neighbours': each round replaces a
    label by 2 i + b, i being the lowest bit in which it differs from the
    one before and b its own bit there. ``opens``: where a text begins; what
    stands before it counts as the complement of its first symbol."""
    for _ in range(5):  # 64 bits -> 7 -> 4 -> 3 -> 3 -> 3, below six
        before = np.empty_like(x)
        before[1:] = x[:-1]
        before[opens] = ~x[opens]
        differ = x ^ before
        at = np.bitwise_count((differ & -differ) - x.dtype.type(1))
        x = at << 1 | (x >> at.astype(x.dtype) & x.dtype.type(1)).astype(np.uint8)
    return x


def names(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A name for each phrase (``starts``: the first symbol of each)."""
    which = np.zeros(len(symbols), np.int64)
    which[starts[1:]] = 1
    offset = np.arange(len(symbols)) - starts[np.cumsum(which)]
    place = _PLACE[np.minimum(offset, len(_PLACE) - 1)]
    return mixed(np.add.reduceat((symbols ^ place) * (place | np.uint64(1)), starts))


#: A value for each place in a phrase (six labels bound a phrase's length).
_PLACE = mixed(np.arange(1, 33, dtype=np.uint64) * _M[2])


def level(symbols: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrase names of one level, and the text of each.

    ``text``: the number of each symbol's text, ascending.
    """
    new = np.concatenate(([True], (symbols[1:] != symbols[:-1]) | (text[1:] != text[:-1])))
    runs = np.flatnonzero(new)
    length = np.diff(np.append(runs, len(symbols))).astype(np.uint64)
    symbols, text = symbols[runs], text[runs]
    symbols = np.where(length > 1, mixed(symbols ^ mixed(length * _M[2])), symbols)
    opens = np.concatenate(([True], text[1:] != text[:-1]))
    labels = tossed(symbols, opens)
    closes = np.concatenate((opens[1:], [True]))
    up = np.empty(len(labels), bool)
    up[1:] = labels[1:] > labels[:-1]
    down = np.empty(len(labels), bool)
    down[:-1] = labels[:-1] > labels[1:]
    up[opens], down[closes] = True, False
    starts = np.flatnonzero(up & down | opens)
    return names(symbols, starts), text[starts]


def nth(symbols: np.ndarray, text: np.ndarray) -> np.ndarray:
    """How many equal symbols stand before each in its text."""
    order = np.lexsort((symbols, text))
    new = np.concatenate(([True], (symbols[order][1:] != symbols[order][:-1]) | (text[order][1:] != text[order][:-1])))
    at = np.arange(len(order))
    out = np.empty(len(order), np.uint64)
    out[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    return out


def sketches(texts: list[str]) -> list[bytes]:
    """A fingerprint for each text: VALUES 32-bit MinHash values over the
    phrase names (counted as often as they occur) of the levels from
    FIRST_LEVEL on, until a text is one phrase; none for an empty text."""
    points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    sizes = np.array([len(p) for p in points])
    out = [b""] * len(texts)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    text = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    symbols = mixed(np.concatenate([points[k] for k in full.tolist()]).astype(np.uint64) + np.uint64(1))
    least = np.full((len(texts), VALUES), np.iinfo(np.uint64).max, np.uint64)
    for n in range(1, LEVELS + 1):
        symbols, text = level(symbols, text)
        if n >= FIRST_LEVEL:
            begin = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
            here = text[begin]
            marked = mixed(symbols + _PLACE[n] + nth(symbols, text) * _M[0])
            for k in range(VALUES):
                least[here, k] = np.minimum(least[here, k], np.minimum.reduceat(marked * _A[k] + _B[k], begin))
            more = np.bincount(text, minlength=len(texts))[text] > 1  # a text of one phrase is done
            symbols, text = symbols[more], text[more]
            if not len(text):
                break
    packed = (mixed(least) >> np.uint64(32)).astype(">u4")
    for k in full.tolist():
        out[k] = packed[k].tobytes()
    return out


def likeness(a: bytes, b: bytes) -> float:
    """The share of equal values; 1 for two empty texts, 0 for one."""
    if not a or not b:
        return float(a == b)
    return float((np.frombuffer(a, ">u4") == np.frombuffer(b, ">u4")).mean())


def fingerprints(texts: list[str]) -> list[bytes]:
    """``sketches`` of any number of texts, some at a time."""
    out, some, size = [], [], 0
    for t in texts:
        some.append(t)
        size += len(t)
        if size >= BATCH:
            out += sketches(some)
            some, size = [], 0
    return out + sketches(some)


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, fingerprint`` (lower-case hex; empty for an empty
    or null text) for every row. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([f.hex() for f in fingerprints(texts)])],
                ["doc_id", "n_chars", "fingerprint"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def bounds(rows: DataFrame, parts: int) -> list[tuple[bool, int, int]]:
    """At most ``parts`` - 1 borders in the order of ``rows`` (``rank, h``):
    (null, rank, h) from which the next stretch begins. Quantiles of the
    rank; a rank that several of them name is cut by ranges of its texts'
    hashes, and so are the null ranks, by their share."""
    at = [k / parts for k in range(1, parts)]
    if not at:
        return []
    found = rows.agg(F.count("*").alias("n"), F.count("rank").alias("ranked"), F.percentile_approx("rank", at, 20_000).alias("q")).first()
    if not found["n"]:
        return []
    nulls = found["n"] - found["ranked"]
    pieces = max(1, round(parts * nulls / found["n"])) if nulls else 0
    ranked, q = parts - pieces, sorted(found["q"] or [])
    cut = [q[min(len(q) - 1, k * len(q) // ranked)] for k in range(1, ranked)] if q else []
    out: list[tuple[bool, int, int]] = []
    for rank in sorted(set(cut)):
        n = cut.count(rank)
        out += [(False, rank, _LEAST + k * (2**64 // n)) for k in range(n)]
    out += [(True, 0, _LEAST + k * (2**64 // pieces)) for k in range(pieces)]
    return out[: parts - 1]


_LEAST = -(1 << 63)


def constant(values: list, ddl: str):
    """A list as one constant (many literals would swell the plan)."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{ddl}>")


def stretch(borders: list[tuple[bool, int, int]]):
    """How many of the sorted ``borders`` a row (``rank, h``) is not before:
    first among every so many of them, then within one run of these."""
    if not borders:
        return F.lit(0)
    width = max(1, math.isqrt(len(borders)))
    kind = "struct<n:boolean,r:bigint,h:bigint>"
    rows = [{"n": n, "r": r, "h": h} for n, r, h in borders]
    here = F.struct(F.col("rank").isNull().alias("n"), F.coalesce("rank", F.lit(0).cast("long")).alias("r"), F.col("h").alias("h"))
    coarse = F.size(F.filter(constant(rows[width - 1 :: width], kind), lambda b: b <= here))
    return coarse * width + F.size(F.filter(F.slice(constant(rows, kind), coarse * width + 1, F.lit(width)), lambda b: b <= here))


def in_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``part, lead, rank, h, doc_id, text``: the rows of ``docs`` dealt in
    stretches of their order, each stretch a part of its own, and the first
    row of every stretch once more (``lead``) with the stretch before it.

    The order is by descending id, null last, ties by a hash of the text;
    the row after the last is the first. Stretches are ranges of ids between
    quantiles, or of hashes within an id of many rows (``bounds``). These and
    the first row's id and hash of each stretch come to the driver: no more
    than there are shuffle partitions.
    """
    labels = even_labels(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("rank", F.bitwise_not("doc_id")).withColumn("h", F.xxhash64("text"))
    borders = bounds(rows, len(labels))
    rows = rows.withColumn("number", stretch(borders))
    found = rows.groupBy("number").agg(F.min(F.struct(F.col("rank").isNull(), "rank", "h")).alias("first")).collect()
    found = {r["number"]: r["first"] for r in found}
    filled = sorted(found)
    earlier = {n: filled[k - 1] for k, n in enumerate(filled)}
    told = [{"p": labels[n], "b": labels[earlier[n]], "r": found[n]["rank"], "h": found[n]["h"]} if n in found else None for n in range(len(borders) + 1)]
    at = F.get(constant(told, "struct<p:bigint,b:bigint,r:bigint,h:bigint>"), F.col("number"))
    own = F.struct(at["p"].alias("part"), F.lit(False).alias("lead"))
    first = F.col("rank").eqNullSafe(at["r"]) & (F.col("h") == at["h"])
    to = F.when(first, F.array(own, F.struct(at["b"].alias("part"), F.lit(True).alias("lead")))).otherwise(F.array(own))
    return rows.withColumn("to", F.explode(to)).select("to.part", "to.lead", "rank", "h", "doc_id", "text")


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many (or
    all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _beside_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part, their lead behind them: a row needs the one
    after it alone, so some hundred are held at a time."""
    before: tuple[int, bool, int | None, str] | None = None
    for batch in batches:
        for low in range(0, batch.num_rows, 500):
            some = batch.slice(low, 500)
            rows = list(zip(*(some.column(c).to_pylist() for c in ("part", "lead", "doc_id", "text"))))
            rows = [before, *rows] if before else rows
            before = rows[-1]
            texts = [r[3] for r in rows]
            own = fingerprints(texts)
            # the row after a lead is of another part, or a lead again
            at = [k for k in range(len(rows) - 1) if not rows[k][1] and rows[k][0] == rows[k + 1][0]]
            changed = [edited(texts[k], texts[k + 1]) for k in at]
            other = fingerprints(changed)
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows[k][2] for k in at], pa.int64()), pa.array([len(texts[k]) for k in at], pa.int64()),
                 pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], pa.string()),
                 pa.array([own[k].hex() for k in at], pa.string()), pa.array([f.hex() for f in other], pa.string()),
                 pa.array([likeness(own[k], b) for k, b in zip(at, other)], pa.float64()), pa.array([likeness(own[k], own[k + 1]) for k in at], pa.float64())],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def beside_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next`` for every row: the fingerprint of its text, that
    of its text with the second half replaced by the beginning of the next
    document's, and the likeness of its own to this and to the next
    document's.

    A null text is empty; an empty one has an empty fingerprint. Repeated
    rows stand beside each other in the order; one row alone is its own
    next. No rows give no rows. Columns of other names are not read.
    """
    placed = in_order(docs, id_col, text_col).repartition("part")
    placed = placed.sortWithinPartitions("part", "lead", F.asc_nulls_last("rank"), "h")
    return placed.mapInArrow(
        _beside_next, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")

"""Language ID by bit-sliced Bloom filters over character n-grams.

Learning counts, for each language, the documents that hold each trigram and
keeps the trigrams that belong to it. All languages share one table of
bitmask rows: row h(gram) has bit l set if language l may hold the gram, so
the AND of the rows of k hashes gives *all* languages of a gram at once. A
text is decided by per-language popcounts over its trigrams, corrected for
each filter's false-positive rate.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import begin, ddl, drop_cut, write_cut

UNDETERMINED = "und"
#: Rows of the bit-sliced table (a power of two) and hashes a gram. Any number
#: of grams goes in; more of them raise the false-positive rate, which is known
#: and taken out of the counts.
SLOTS, HASHES = 1 << 20, 3
#: A language holds a gram that so many of its documents have at least,
MIN_DOCS = 3
#: ... if their share is this fraction at least of the gram's highest share.
OF_BEST = 0.3
#: More languages than this are refused: the table is sent to every executor.
MAX_LANGUAGES = 256
#: Code points treated at once, and distinct grams gathered before a flush.
SLICE, FLUSH = 1 << 20, 1 << 20

@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def grams(text: str) -> Iterator[np.ndarray]:
    """Trigram codes of a text, a slice at a time: lower case, every run of
    other characters one blank, a blank at both ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters()[points]
    if not is_letter.any():
        return
    points = np.where(is_letter, points, 32)
    points = points[np.concatenate(([True], is_letter[1:] | is_letter[:-1]))]
    points = points[int(points[0] == 32) : len(points) - int(points[-1] == 32)]
    points = np.concatenate(([32], points, [32])).astype(np.uint64)
    for at in range(0, len(points) - 2, SLICE):
        p = points[at : at + SLICE + 2]
        yield p[:-2] | p[1:-1] << np.uint64(21) | p[2:] << np.uint64(42)


def slots(codes: np.ndarray) -> Iterator[np.ndarray]:
    """The HASHES rows of each gram: separate bits of one 64-bit hash."""
    h = (codes ^ codes >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    width = SLOTS.bit_length() - 1
    for k in range(HASHES):
        yield (h >> np.uint64(64 - width * (k + 1)) & np.uint64(SLOTS - 1)).astype(np.int64)


def _gram_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per language: documents that hold each gram; gram -1 counts documents."""
    begin("langid")
    held: dict[str, list[np.ndarray]] = {}
    seen: dict[str, int] = {}
    size = 0

    def flush():
        for lang, parts in held.items():
            code, n = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.empty(0, np.uint64), np.empty(0, np.int64))
            yield pd.DataFrame({"lang": lang, "gram": np.append(code.astype(np.int64), -1), "n": np.append(n, seen[lang])})

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            own = [np.unique(x) for x in grams(text)]
            own = np.unique(np.concatenate(own)) if len(own) > 1 else own[0] if own else np.empty(0, np.uint64)
            held.setdefault(lang, []).append(own)
            seen[lang] = seen.get(lang, 0) + 1
            size += len(own)
            if size >= 8 * FLUSH:
                yield from flush()
                held, seen, size = {}, {}, 0
    yield from flush()


def profiles(labelled: DataFrame) -> DataFrame:
    """``lang, gram, rate``: the grams that each language holds.

    ``labelled``: ``lang, text``. All its rows count; null texts and
    languages do not.
    """
    known = labelled.where("lang is not null and text is not null").select("lang", "text")
    counts = (known.mapInPandas(_gram_counts, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    counts = write_cut(counts, "langid-counts")
    total = counts.where("gram = -1").select("lang", F.col("n").alias("docs"))
    rate = counts.where("gram >= 0").join(total, "lang").select("lang", "gram", "n", (F.col("n") / F.col("docs")).alias("rate"))
    best = rate.groupBy("gram").agg(F.max("rate").alias("best"))
    kept = rate.where(F.col("n") >= MIN_DOCS).join(best, "gram").where(F.col("rate") >= OF_BEST * F.col("best")).select("lang", "gram", "rate")
    kept = write_cut(kept, "langid-profiles")
    drop_cut(counts)
    return kept


def _bits(langs: list[str]):
    """Grams of languages -> the bits that they set: word, slot, mask."""
    number = {lang: l for l, lang in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            l = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
            codes = batch.column(1).to_numpy().view(np.uint64)
            at = np.concatenate(list(slots(codes)))
            masks = np.tile((np.uint64(1) << (l & 63).astype(np.uint64)).view(np.int64), HASHES)
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(l >> 6, HASHES)), pa.array(at), pa.array(masks)], ["word", "slot", "mask"])

    return run


class Filters:
    """The bit-sliced table: ``rows[slot, word]``, bit l of the words for language l."""

    def __init__(self, langs: list[str], fallback: str, rows: np.ndarray) -> None:
        self.langs, self.fallback, self.rows = langs, fallback, rows
        fill = [np.count_nonzero(rows[:, l >> 6] & (np.uint64(1) << np.uint64(l & 63))) / SLOTS for l in range(len(langs))]
        self.false_rate = np.array(fill) ** HASHES

    @classmethod
    def of(cls, langs: list[str], fallback: str, grams_of: dict[str, np.ndarray]) -> Filters:
        """The filters of sets of grams at hand."""
        rows = np.zeros((SLOTS, max(1, -(-len(langs) // 64))), np.uint64)
        for l, lang in enumerate(langs):
            for at in slots(grams_of[lang]):
                rows[at, l >> 6] |= np.uint64(1) << np.uint64(l & 63)
        return cls(langs, fallback, rows)

    def languages_of(self, codes: np.ndarray) -> list[np.ndarray]:
        """Bitmasks of the languages that hold each gram, 64 languages a word."""
        at = list(slots(codes))
        masks = []
        for word in range(self.rows.shape[1]):
            rows = self.rows[:, word]
            mask = rows[at[0]]
            for more in at[1:]:
                mask &= rows[more]
            masks.append(mask)
        return masks

    def popcounts(self, codes: np.ndarray) -> np.ndarray:
        """Grams that each language holds."""
        masks, n = self.languages_of(codes), len(self.langs)
        if n <= 12:
            kinds = np.bincount(masks[0].astype(np.int64), minlength=1 << n)
            return kinds @ (np.arange(1 << n)[:, None] >> np.arange(n) & 1)
        return np.array([np.count_nonzero(masks[l >> 6] & np.uint64(1) << np.uint64(l & 63)) for l in range(n)], np.int64)

    def decide(self, text: str | None) -> tuple[str, float]:
        """Language and the share (0 to 1) of the text's grams that it holds
        beyond false positives. Ties go to the first name; without a letter
        ``und``; without evidence the commonest learned language, score 0."""
        counts, n = np.zeros(len(self.langs), np.int64), 0
        for codes in grams(text or ""):
            n += len(codes)
            counts += self.popcounts(codes)
        if not n or not self.langs:
            return UNDETERMINED, 0.0
        real = np.clip((counts - n * self.false_rate) / np.maximum(1 - self.false_rate, 1e-9), 0, n)
        best = int(np.argmax(real))
        return (self.langs[best], float(real[best] / n)) if real[best] > 0 else (self.fallback, 0.0)


def learn(labelled: DataFrame) -> Filters:
    """Filters from all rows of ``labelled`` (``lang, text``).

    The bits of all grams are united by Spark; what reaches the driver is
    the table itself, SLOTS rows for 64 of at most MAX_LANGUAGES languages,
    however many grams they hold.
    """
    kept = profiles(labelled)
    found = kept.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    langs = sorted(r["lang"] for r in found)
    most = labelled.where("lang is not null and text is not null").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(1).collect()
    bits = kept.select("lang", "gram").mapInArrow(_bits(langs), "word long, slot long, mask long").groupBy("word", "slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    rows = np.zeros((SLOTS, max(1, -(-len(langs) // 64))), np.uint64)
    word, slot, mask = (bits.column(c).to_numpy() for c in range(3))
    rows[slot, word] = mask.view(np.uint64)
    drop_cut(kept)
    return Filters(langs, most[0]["lang"] if most else UNDETERMINED, rows)


def label(docs: DataFrame, filters: Filters, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred, score`` (existing columns of these names
    are replaced).

    The prediction reads the text alone. A null text, or one without a
    letter, is ``und`` with score 0; repeated rows get equal answers; with
    nothing learned every text is ``und``.
    """
    rows = docs.drop("lang_pred", "score")
    model = docs.sparkSession.sparkContext.broadcast(filters)
    at = rows.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("langid")
        f = model.value
        for batch in batches:
            found = [f.decide(t.as_py()) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                [*batch.schema.names, "lang_pred", "score"])

    return rows.mapInArrow(run, ddl(rows, "lang_pred string", "score double"))


def fold(id_col: str = "doc_id"):
    """The fixed fold of a document, 0 to 2 (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``documents``:
    learned from the folds 0 and 2, predicted from the text alone. A row
    with a null id is neither learned from nor held out."""
    filters = learn(docs.where(fold() != 1).select("lang", "text"))
    return label(docs.select("doc_id", "text"), filters).select(
        "doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")

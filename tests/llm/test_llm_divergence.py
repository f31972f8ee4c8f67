"""Source divergence audit: the perfect hash, and the audit against a plain one."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import CLASHING, LONG

from pyspark.sql import functions as F
from starloom.llm import divergence
from starloom.llm.common import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain(rows, min_docs=3, top=200):
    """rows: (text, lang, source), the contract said in plain Python."""
    found = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")))
             for text, lang, source in rows]
    docs = Counter((lang, t) for lang, _, w in found for t in set(w))
    kept = defaultdict(set)
    for (lang, t), n in docs.items():
        if n >= min_docs:
            kept[lang].add(t)
    counts = defaultdict(Counter)
    for lang, source, w in found:
        for key in ((lang, source), (lang, None)):
            counts[key].update(t for t in w if t in kept[lang])

    def share(key, t):
        return 1 + 10**9 * (counts[key][t] + 1) // (sum(counts[key].values()) + len(kept[key[0]]))

    out = []
    for lang, source in {(a, b) for a, b, _ in found}:
        pairs = [(sum((share((lang, source), t) - share((lang, o), t)) ** 2 // share((lang, o), t) for t in kept[lang]), o)
                 for a, o in {(a, b) for a, b, _ in found} if a == lang and o != source]
        own = [((share((lang, source), t) - share((lang, None), t)) ** 2 // share((lang, None), t), t) for t in kept[lang]
               if counts[lang, source][t] and share((lang, source), t) > share((lang, None), t)]
        for part, listed, most in (("pair", pairs, None), ("term", own, top)):
            listed.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (value, item) in enumerate(listed[:most])]
    return sorted(out)


def audited(spark, rows, extra=False):
    df = spark.createDataFrame([(k, *r, None) for k, r in enumerate(rows)], SCHEMA)
    if extra:
        df = df.withColumns({c: F.lit("clash") for c in [*CLASHING, "shard", "term", "kind", "body", "item", "part", "value", "total"] if c not in df.columns})
    out = divergence.audit(df)
    assert dict(out.dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"}
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in out.collect())


def some_rows(n=300):
    r = random.Random(11)
    words = ["Été", "ZÜRICH", "zürich", "señor", "漢字", "x1y", "don't", "a-b", "The", "the", *[f"w{c}{d}" for c in "abcdefgh" for d in "klmnopq"]]
    rows = [(" ".join(r.choices(words, k=r.randrange(30))), r.choice(["en", "de", "", None]), f"s{min(r.randrange(12), 7)}") for _ in range(n)]
    # a hot source, repeated rows, no term, no text, a language without kept terms
    rows += [rows[0]] * 150 + [("12 34 !!", "en", "numbers"), (None, "en", None), ("", "fr", "a"), ("once only", "fr", "b"), (LONG, "en", "long"), (LONG, "en", "long"), (LONG, None, "s1")]
    return rows


def test_equals_plain_version(spark):
    ship(spark)
    rows = some_rows()
    assert audited(spark, rows, extra=True) == plain(rows)


def test_terms_travel_where_the_hashes_are_large(spark, monkeypatch):
    """No broadcast, many shards, several blocks of sources, many flushes: the same result."""
    ship(spark)
    rows = some_rows()
    for name, value in (("BROADCAST", -1), ("SHARD", 7), ("BLOCK", 2), ("HELD", 50)):
        monkeypatch.setattr(divergence, name, value)
    assert audited(spark, rows) == plain(rows)


def test_flushes_of_dense_slots(spark, monkeypatch):
    ship(spark)
    rows = some_rows(80)
    for name, value in (("SHARD", 16), ("HELD", 40), ("DENSE", 100)):
        monkeypatch.setattr(divergence, name, value)
    assert audited(spark, rows) == plain(rows)


def test_no_rows(spark):
    ship(spark)
    assert audited(spark, []) == []


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash(n):
    keys = [b"k%d" % k for k in range(n)]
    table = divergence.PerfectHash.load(divergence.PerfectHash.build(keys).dump())
    slots = table.slots(keys, divergence.hashed(keys))
    assert sorted(slots.tolist()) == list(range(n))
    assert all(table.key(s) == k for s, k in zip(slots.tolist(), keys))
    others = [b"", b"k", *[b"o%d" % k for k in range(n)], *[k + b"x" for k in keys]]
    assert (table.slots(others, divergence.hashed(others)) == -1).all()


def test_perfect_hash_keys_of_one_hash(monkeypatch):
    """Keys that no level can part are found by their bytes."""
    monkeypatch.setattr(divergence, "hashed", lambda keys: np.array([len(k) for k in keys], np.uint64))
    keys = [b"aa", b"bb", b"cc", b"d", b"eee"]
    table = divergence.PerfectHash.load(divergence.PerfectHash.build(keys).dump())
    asked = [*keys, b"zz", b"q", b"qqqq"]
    slots = table.slots(asked, divergence.hashed(asked)).tolist()
    assert sorted(slots[:5]) == [0, 1, 2, 3, 4] and slots[5:] == [-1, -1, -1]
    assert [table.key(s) for s in slots[:5]] == keys


def test_shares_are_exact_beyond_64_bits():
    for total, size in ((10, 3), (8_999_999_999_999_000, 7), (10**16, 10**6), (4 * 10**18, 5)):
        counts = np.array([0, 1, 12345, total // 3, total - 1], np.int64)
        assert divergence.shares(counts, total, size).tolist() == [1 + 10**9 * (int(c) + 1) // (total + size) for c in counts]


def test_hash_is_that_of_the_session(spark):
    keys = [b"", b"a", "漢字".encode(), b"x" * 100]
    rows = spark.createDataFrame([(bytearray(k),) for k in keys], "k binary").select(F.xxhash64("k")).collect()
    assert [r[0] for r in rows] == divergence.hashed(keys).view(np.int64).tolist()

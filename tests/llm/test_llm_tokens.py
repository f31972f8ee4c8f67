"""Byte-level BPE and unigram token counts."""

import random
from hashlib import sha256

import numpy as np
import pytest
import tiktoken
from conftest import SF_SMALL
from llm_cases import EDGE, documents

from starloom.llm import bpe, tokencount
from starloom.llm.common import ship
from starloom.llm.queries import PATTERN, RANKS


@pytest.fixture(scope="module")
def blob():
    with open(RANKS, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def reference(blob):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(blob), special_tokens={})


@pytest.mark.parametrize("alphabet", ["aab", "ab \n\t", "the ", "aAé漢́ 1²٣\x1c\x85​　😀", "!?.. \n"])
def test_encoder_equals_tiktoken(blob, reference, alphabet):
    e, r = bpe.encoder(blob, PATTERN), random.Random(1)
    for _ in range(300):
        text = "".join(r.choice(alphabet) for _ in range(r.randrange(200)))
        ids = e.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
        assert e.decode(ids) == text.encode()


def test_very_long_pretokens(blob, reference):
    e = bpe.encoder(blob, PATTERN)
    for text in ("ab" * 20_000, "".join(random.Random(2).choice("abcdefgh") for _ in range(30_000))):
        assert np.frombuffer(e.encode(text), "<u4").tolist() == reference.encode_ordinary(text)


def test_memo_bound_changes_nothing(blob, reference, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 3)
    e = bpe.Encoder(bpe.read_ranks(blob), PATTERN)
    text = "one two three four five six one two three four five six"
    assert np.frombuffer(e.encode(text), "<u4").tolist() == reference.encode_ordinary(text)
    assert len(e.memo) <= 3


def test_digests(spark, reference):
    ship(spark)
    docs = documents(spark, EDGE, extra=True).unionByName(
        spark.read.parquet(f"{SF_SMALL}/documents.parquet"), allowMissingColumns=True)
    got = sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digests(docs, RANKS, PATTERN).collect())
    want = []
    for i, text in docs.select("doc_id", "text").collect():
        ids = reference.encode_ordinary(text or "")
        want.append((i or -1, len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want)


def test_empty_table(spark):
    ship(spark)
    none = documents(spark, EDGE).limit(0)
    assert bpe.digests(none, RANKS, PATTERN).count() == 0
    assert tokencount.count_tokens(none, RANKS, PATTERN).count() == 0


def test_vocabulary_size_is_checked(spark, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_VOCABULARY_BYTES", 10)
    with pytest.raises(ValueError, match="above"):
        bpe.encode(documents(spark, EDGE), RANKS, PATTERN)


def least_tokens(counter, piece):
    best = [(0, 0)]
    for end in range(1, len(piece) + 1):
        ways = [(best[end - 1][0] + counter.unknown, best[end - 1][1] + 1)]
        ways += [(best[k][0] + counter.cost[piece[k:end]], best[k][1] + 1) for k in range(end) if piece[k:end] in counter.cost]
        best.append(min(ways))
    return best[-1][1]


def test_trie_counts_equal_plain_dynamic_programming(blob, monkeypatch):
    monkeypatch.setattr(tokencount, "MAX_NODES", 500)
    c = tokencount.Counter(bpe.read_ranks(blob), PATTERN)
    r = random.Random(3)
    pieces = ["", "a" * 300, "thethe" * 40, "漢字", "été"] + ["".join(r.choice("therionga ") for _ in range(r.randrange(1, 14))) for _ in range(400)]
    for p in pieces:
        assert c.count(p.encode()) == least_tokens(c, p.encode())


def test_unknown_bytes_count_one_each():
    c = tokencount.Counter({b"a": 0, b"aa": 1}, r".+")
    assert c.count(b"aaxa") == least_tokens(c, b"aaxa") == 3


def test_token_counts(spark, blob):
    ship(spark)
    docs = documents(spark, EDGE, extra=True)
    c = tokencount.Counter(bpe.read_ranks(blob), PATTERN)
    got = sorted((r["doc_id"] or -1, r["n_pretokens"], r["n_tokens"]) for r in tokencount.count_tokens(docs, RANKS, PATTERN).collect())
    want = [(i or -1, len(c.find(t or "")), sum(least_tokens(c, p.encode()) for p in c.find(t or ""))) for i, t in EDGE if i != 5]
    assert [g for g in got if g[0] != 5] == sorted(want)
    assert len([g for g in got if g[0] == 5]) == 2

"""Packing: ids, retrieval against plain BM25, and every id in one place."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL
from llm_cases import CLASHING, EDGE, documents
from tokenizers import Tokenizer

from starloom.llm import packing
from starloom.llm.common import ship

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
TOKENIZER = Tokenizer.from_file(PATH)


def ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, packed, window=2048):
    """Every document's ids in one piece each, sequences gapless, none padded."""
    left = defaultdict(list)
    for doc, text in rows:
        left[doc].append(ids(text))
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in packed:
        own = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert len(own) == r["length"] > 0 and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
        pieces[r["doc_id"]].append((r["start"], r["doc_tokens"], own))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert pieces.keys() == left.keys()
    for doc, whole in left.items():
        # ids of one document, or of several rows of one id
        found = Counter((s + k, n, t) for s, n, own in pieces[doc] for k, t in enumerate(own))
        assert found == Counter((k, len(w), t) for w in whole for k, t in enumerate(w))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= window and at & (at - 1) == 0
    return sequences


def collected(docs, **kw):
    out = packing.pack(docs, PATH, PATTERN, **kw)
    return out.collect()


def test_documents_of_the_table(spark):
    ship(spark)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    packed = collected(docs)
    sequences = check([(r["doc_id"], r["text"]) for r in docs.collect()], packed)
    assert sum(sum(n for _, n in own) == 2048 for own in sequences.values()) > 30
    digest = packing.digests(docs, PATH, PATTERN)
    assert digest.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and all(t == "bigint" for _, t in digest.dtypes)


def test_edge_rows(spark, monkeypatch):
    ship(spark)
    monkeypatch.setattr(packing, "SHARD_DOCS", 5)
    rows = [*EDGE, (7, "<|endoftext|> stands in a text"), (None, None), (None, ""), *[(20, "copy " * 50)] * 30]
    check(rows, collected(documents(spark, rows, extra=True)))
    check(rows, collected(documents(spark, rows), window=64), 64)


def test_no_rows_and_bad_window(spark):
    ship(spark)
    assert collected(documents(spark, [])) == []
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(documents(spark, EDGE), PATH, PATTERN, window=100)


def test_ids_are_those_of_the_tokenizer():
    encode = packing.encoder(PATH, PATTERN)
    r = random.Random(4)
    letters = "abc ABC  \n\t'sé漢😀  ́<|endoftext|>019٣ⅷ!?.,_\x00\x85"
    texts = ["", " ", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext|", *["".join(r.choices(letters, k=r.randrange(60))) for _ in range(500)],
             *["".join(r.choices("ab é\n \t\r\x0b\x0c\x1c", k=r.randrange(40))) for _ in range(800)], *["".join(r.choices("a1. \n\xa0\u2003\u3000", k=r.randrange(30))) for _ in range(300)],
             "  a", "a  ", " \n ", "\n\na", "a\n\n b", "a \n", "  ", "x   y", "'s  's", "x" * 3000 + " y" * 2000]
    assert [x.tolist() for x in encode(texts)] == [e.ids for e in TOKENIZER.encode_batch(texts, add_special_tokens=False)]
    other = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(other)
    assert [x.tolist() for x in packing.encoder(other, PATTERN)(texts)] == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_ids_of_four_bytes():
    press = packing.zstandard.ZstdCompressor()
    for ids in ([1], [0, 65535], [70000, 3, 1], list(range(5000))):
        ids = np.array(ids, np.uint32)
        found = packing.ids_of(packing._packed_ids(ids, press))
        assert found.dtype == np.uint32 and found.tolist() == ids.tolist()


def plain_scores(texts, weight, mean, seed):
    out = []
    for ids_ in texts:
        tf = Counter(ids_.tolist())
        out.append(sum(weight[t] * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(ids_) / mean)) for t in set(texts[seed].tolist()) if tf[t]))
    return out


def test_neighbours_are_those_of_plain_bm25():
    r = random.Random(9)
    texts = [np.array(r.choices(range(k % 3 * 40, k % 3 * 40 + 60), k=r.randrange(1, 80)), np.uint32) for k in range(60)]
    df = np.bincount(np.concatenate([np.unique(t) for t in texts]), minlength=200)
    weight = packing.idf(df, 60)
    assert all(w == max(math.log((60 - d + 0.5) / (d + 0.5)), 0) for w, d in zip(weight.tolist(), df.tolist()))
    index = packing.Index(texts, weight, 40.0)
    for seed in range(60):
        assert np.allclose(index.neighbours(seed), plain_scores(texts, weight, 40.0, seed))


def test_windows_are_filled_by_rank():
    """Each window: the seed, then in the order of score those that fit, then the head of the best that did not."""
    r = random.Random(2)
    texts = [np.array(r.choices(range(k % 4 * 50, k % 4 * 50 + 70), k=r.randrange(5, 60)), np.uint32) for k in range(80)]
    weight = packing.idf(np.bincount(np.concatenate([np.unique(t) for t in texts]), minlength=300), 80)
    windows, rest = packing.fill([packing.Piece(k, t, 0, len(t)) for k, t in enumerate(texts)], weight, 30.0, 128)
    size, unused = {k: len(t) for k, t in enumerate(texts)}, set(range(80))
    for own in windows:
        seed = min(unused)
        room, unused = 128 - size[seed], unused - {seed}
        score = plain_scores(texts, weight, 30.0, seed)
        expected, best = [seed], None
        for k in sorted(unused, key=lambda k: (-round(score[k], 9), k)):
            if size[k] <= room:
                expected.append(k)
                room -= size[k]
                unused = unused - {k}
            elif best is None:
                best = k
            if not room:
                break
        if room:
            expected.append(best)
            size[best] -= room
        assert [p.doc for p in own] == expected and sum(len(p.ids) for p in own) == 128
    assert sorted(p.doc for p in rest) == sorted(unused) and sum(len(p.ids) for p in rest) < 128


def test_kin_share_windows(spark):
    """Documents of four vocabularies: most windows hold documents of one."""
    ship(spark)
    r = random.Random(5)
    kinds = [[f"{a}{b}" for b in ("ka", "ri", "no", "tes", "lum", "vor", "pin", "dra")] for a in ("zo", "mi", "qua", "ber")]
    rows = [(k, " ".join(r.choices(kinds[k % 4], k=r.randrange(60, 200)))) for k in range(400)]
    kinds_of = defaultdict(set)
    for p in collected(documents(spark, rows)):
        kinds_of[p["sequence_id"]].add(p["doc_id"] % 4)
    assert sum(len(k) == 1 for k in kinds_of.values()) > 0.8 * len(kinds_of)


def test_rest_is_cut_at_powers():
    pieces = [packing.Piece(k, np.arange(n, dtype=np.uint32), 0, n) for k, n in enumerate((5, 1, 30, 2))]
    out = packing.cut_at_powers(pieces, 32)
    assert [sum(len(p.ids) for p in own) for own in out] == [32, 4, 2]
    assert [(p.doc, p.start, len(p.ids)) for own in out for p in own] == [(0, 0, 5), (1, 0, 1), (2, 0, 26), (2, 26, 4), (3, 0, 2)]

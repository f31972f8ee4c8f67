"""Mixing and chat formatting: DataFrame operations only, against brute force."""

from hashlib import md5

import pytest
from conftest import SF_SMALL, plan_text
from llm_cases import CLASHING, EDGE, documents

from pyspark.sql import functions as F
from starloom.llm import chat, mixing

PYTHON = ("Python", "Pandas", "Arrow", "ExternalRDD")


def water(budget, children):
    """children: name -> (weight, cap); shares by raising the level step by step."""
    left = {k: v for k, v in children.items() if v[0] and v[0] > 0}
    out = {k: 0.0 for k in children}
    while left:
        level = budget / sum(w for w, _ in left.values())
        full = {k: c for k, (w, c) in left.items() if c <= level * w}
        if not full:
            return out | {k: level * w for k, (w, _) in left.items()}
        out |= full
        budget -= sum(full.values())
        left = {k: v for k, v in left.items() if k not in full}
    return out


def brute_mix(rows, weights, share, epochs, seed):
    """rows: (id, (domain, lang, source), tokens) -> copies by row."""
    tokens = {}
    for _, leaf, n in rows:
        tokens[leaf] = tokens.get(leaf, 0) + n
    budget, depth = {(): float(int(sum(tokens.values()) * share))}, 3
    for d in range(depth):
        for node in [k for k in budget if len(k) == d]:
            caps = {}
            for leaf, n in tokens.items():
                if leaf[:d] == node:
                    caps[leaf[: d + 1]] = caps.get(leaf[: d + 1], 0) + n * epochs
            budget |= water(budget[node], {k: (weights(d, k[d]), c) for k, c in caps.items()})
    out = []
    for leaf, n in tokens.items():
        full, rest = divmod(int(budget[leaf]), n) if n else (0, 0)
        own = sorted((md5(f"{seed}:{full}:{'null' if i is None else i}".encode()).hexdigest(), t, i) for i, x, t in rows if x == leaf)
        total = 0
        for _, t, i in own:
            total += t
            out.append((-1 if i is None else i, t, full + (total <= rest)))
    return sorted(out)


def mixed(df, **more):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["copies"]) for r in mixing.select(df, mixing.LEVELS, **more).collect())


@pytest.mark.parametrize(("share", "epochs"), [(1.0, 2), (0.4, 1), (3.0, 2), (1.0, 5)])
def test_mix_equals_brute_force(spark, share, epochs):
    rows = [(k, (f"d{k % 3}", ["en", "de", None][k % 7 % 3], f"s{k % 11}" if k % 5 else "hot"), (k * 37) % 50) for k in range(600)]
    df = spark.createDataFrame([(i, *leaf, n) for i, leaf, n in rows], "doc_id long, domain string, lang string, source string, n_tokens long")
    got = mixed(df, weights={"domain": F.when(F.col("domain") == "d1", 3.0).otherwise(1.0), "lang": F.when(F.col("lang") == "de", 0.0).otherwise(1.0)}, share=share, max_epochs=epochs)
    assert got == brute_mix(rows, lambda d, x: 3.0 if x == "d1" else 0.0 if x == "de" and d == 1 else 1.0, share, epochs, 42)


def test_mix_edge_rows(spark):
    docs = documents(spark, EDGE)
    got = mixing.mix_documents(docs).collect()
    assert len(got) == len(EDGE)
    assert {r["n_tokens"] for r in got if r["doc_id"] in (1, 2, 3)} == {0}
    assert mixing.mix_documents(docs.limit(0)).count() == 0
    blank = docs.where("doc_id in (1, 2, 3)")
    assert {r["copies"] for r in mixing.mix_documents(blank).collect()} <= {0, 1}
    nulls = docs.withColumns({"source": F.lit(None).cast("string"), "lang": F.lit(None).cast("string")})
    assert mixing.mix_documents(nulls).count() == len(EDGE)


def test_take_repeats_rows(spark):
    docs = documents(spark, EDGE, extra=True)
    copies = {(r["doc_id"], r["n_tokens"]): r["copies"] for r in mixing.mix_documents(docs).collect()}
    got = mixing.take(docs)
    assert got.columns == docs.columns
    assert got.where("doc_id = 6").count() == copies[6, len(EDGE[7][1].split())]
    assert got.count() == sum(r["copies"] for r in mixing.mix_documents(docs).collect())
    assert mixing.take(docs.limit(0)).count() == 0


def test_no_python_in_native_plans(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    conversations = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    for df in (mixing.mix_documents(docs), mixing.take(docs), chat.render(conversations)):
        text = plan_text(df, "formatted")
        assert not any(x in text for x in PYTHON)


def rendered(turns):
    return "".join(f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in turns)


def brute_chat(rows):
    by = {}
    for k, (conv, turn, role, text) in enumerate(rows):  # a row without conv_id stands alone
        by.setdefault(("row", k) if conv is None else conv, []).append(((turn is not None, turn), (role is not None, role), (text is not None, text)))
    logs = {c: tuple((r[1], t[1]) for _, r, t in sorted(turns)) for c, turns in by.items()}
    out = []
    for log in set(logs.values()):
        if not any(len(o) > len(log) and o[: len(log)] == log for o in logs.values()):
            same = [c for c, o in logs.items() if o == log]
            named = [c for c in same if not isinstance(c, tuple)]
            out.append((min(named) if named else -1, len(log), len(same), rendered(log)))
    return sorted(out)


def chats(df):
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in chat.render(df).collect())


def test_snapshots_collapse(spark):
    rows, k = [], 0
    for c in range(12):
        log = [(t, ["user", "assistant"][t % 2], f"text {c % 4} {t if t else 'first'}") for t in range(2 + c % 5)]
        for n in range(1, len(log) + 1):
            rows += [(k, *turn) for turn in log[:n]]
            k += 1
    rows += [(900, 0, None, "x"), (901, 0, "", "x"), (902, 0, "user", None), (903, 0, "user", ""), (903, 0, "user", ""), (None, 3, "user", "no conversation"),
             (None, 4, "user", "no conversation"), (None, None, None, None), (None, 1, "user", "text 1 first"), (None, 9, "user", None), *[(None, k, "user", "alone") for k in range(50)],
             (904, None, "user", "a"), (904, 1, "user", "b"), (905, 1, "user", "b"), (905, 1, "user", "a"), (906, 5, "user", "a"), (906, 7, "user", "b"), (907, 0, "user", "long " * 50_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert chats(df) == brute_chat(rows)
    assert chats(df.withColumns({c: F.lit("clash") for c in CLASHING})) == brute_chat(rows)
    assert chat.render(df.limit(0)).count() == 0


def test_documents_conversations(spark):
    df = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    assert chats(df) == brute_chat([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])

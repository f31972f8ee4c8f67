"""Tables and plain brute-force versions shared by the tests of this folder."""

import random

from pyspark.sql import functions as F

LONG = "word " * 4000 + "".join(random.Random(7).choices("abcdefgh ", k=60_000))
#: Null, empty, blank and one-letter texts, a null id, very long texts,
#: repeated rows, ties.
EDGE = [
    (1, None), (2, ""), (3, " \n\t"), (4, "x"), (None, "a text that has no id but is long enough to be looked at by all"),
    (5, LONG), (5, LONG), (6, "the same words stand here in two documents of other ids"),
    (7, "the same words stand here in two documents of other ids"), (8, "!!! 123 ???"), (9, "été à Zürich, señor 漢字 😀"),
]
#: Names that the operators use inside.
CLASHING = ["fp", "sig", "size", "part", "key", "doc", "data", "head", "rank", "h", "copies", "band", "bucket", "lo", "hi", "own", "links",
            "least", "component", "lang_pred", "score", "entities", "n_tokens", "ids", "conv", "at", "n", "logged", "budget", "domain", "cap", "weight", "leaf", "node"]


def documents(spark, rows, extra=False):
    df = spark.createDataFrame(
        [(i, t, "en", "src1", len(t) if t is not None else None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("clash") for c in CLASHING}) if extra else df


def shingle_set(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]

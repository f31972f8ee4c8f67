"""The pipeline: each stage against a plain version of it, and the registry."""

import hashlib
import subprocess
import sys

import numpy as np
import pytest
import tiktoken
from conftest import ROOT, SF_SMALL
from llm_cases import EDGE, documents, roots, shingle_set

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from oracle_check import compare, duck
from starloom.llm import bpe, langid, mixing, surrogates
from starloom.llm.oracle import ORACLE
from starloom.llm.queries import PATTERN, QUERIES, RANKS

COLUMNS = list(corpus_pipeline.COLUMNS)
STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def source(spark):
    """sf0.001, null and blank texts, repeated rows, and clashing columns."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    edge = documents(spark, [(None if i is None else i + 1000, t) for i, t in EDGE], extra=True)
    return docs.unionByName(edge, allowMissingColumns=True).cache()


def rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_language_stage(spark, source):
    got = STAGE["language_id"](spark, source, SF_SMALL)
    assert got.columns == COLUMNS
    filters = langid.learn(source.where(langid.fold() != 1).select("lang", "text"))
    want = [(i, t, filters.decide(t)[0], s, n) for i, t, _, s, n in rows(source) if filters.decide(t)[0] != "und" and filters.decide(t)[1] > 0]
    assert rows(got) == sorted(want, key=repr)
    assert not any(t is None or not any(c.isalpha() for c in t) for _, t, *_ in want)


def test_duplicate_stage(spark, source):
    got = rows(STAGE["ngram_jaccard"](spark, source, SF_SMALL))
    given = rows(source)
    sets = [shingle_set(r[1]) for r in given]
    pairs = [(a, b) for a in range(len(given)) for b in range(a) if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    groups = {}
    for k, c in enumerate(roots(len(given), pairs)):
        groups.setdefault(c, []).append(given[k])
    want = {min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()}
    assert got == sorted(want, key=repr)


def test_personal_data_stage(spark, source):
    got = STAGE["pii"](spark, source, SF_SMALL)
    want = [(i, None if t is None else surrogates.replaced(t, surrogates.EXAMPLE_KEY)[0], lang, s, n) for i, t, lang, s, n in rows(source)]
    assert rows(got) == sorted(((i, t, lang, s, len(t) if t is not None else n) for i, t, lang, s, n in want), key=repr)


def test_mixing_stage(spark, source):
    got = rows(STAGE["mixing"](spark, source, SF_SMALL))
    copies = {}
    for r in mixing.mix_documents(source).collect():
        copies[r["doc_id"], r["n_tokens"]] = copies.get((r["doc_id"], r["n_tokens"]), 0) + r["copies"]
    want = {}
    for r in rows(source):
        want[r[0], len((r[1] or "").split())] = want.get((r[0], len((r[1] or "").split())), 0)
    assert len(got) == sum(copies.values())
    assert {r[0] for r in got} == {i for (i, _), n in copies.items() if n}


def test_encoding_stage(spark, source):
    with open(RANKS, "rb") as f:
        reference = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(f.read()), special_tokens={})
    got = STAGE["byte_bpe"](spark, source, SF_SMALL).collect()
    want = [(i, np.array(reference.encode_ordinary(t or ""), "<u4").tobytes()) for i, t, *_ in rows(source)]
    assert sorted(((r["doc_id"], bytes(r["ids"])) for r in got), key=repr) == sorted(want, key=repr)


def test_run_chains_the_stages(spark):
    got = corpus_pipeline.run(spark, SF_SMALL).select("doc_id", "n_tokens").collect()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF_SMALL).collect(), "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in got) == sorted(r["doc_id"] for r in docs.collect())
    assert len(got) > 50


def test_byte_bpe_stage_decodes(spark, source):
    got = STAGE["byte_bpe"](spark, source, SF_SMALL).select("doc_id", "decoded_sha256", "same").collect()
    want = [(r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest(), True) for r in source.select("doc_id", "text").collect()]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_pipeline_of_an_empty_table(spark):
    docs = documents(spark, EDGE).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_SMALL).count() == 0, name


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert {k for k in oracle_sql() if k.startswith("op")} == set(ORACLE)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_sql(spark, key):
    r = compare(spark, duck(SF_SMALL), SF_SMALL, key, queries()[key], ORACLE[key])
    assert r["status"] == "ok", r


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_returns_every_row(spark, key):
    found = queries()[key](spark, SF_SMALL)
    if key.startswith("op13"):  # a row a piece
        found = found.select("doc_id").distinct()
    assert found.count() == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()


def test_rest_works_without_this_subpackage(tmp_path):
    """The entry point imports where the subpackage and the pipeline are absent."""
    import shutil

    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{ROOT}/starloom", tmp_path / "starloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; assert e.queries() and set(e.oracle_sql()) == set(e.queries()); print(len(e.queries()))"
    r = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120, env={"PATH": "/usr/bin:/bin"})
    assert r.returncode == 0, r.stderr[-2000:]


@pytest.mark.parametrize("package", ["xxhash", "regex", "public_tokenizers"])
def test_a_missing_package_leaves_the_other_queries(package):
    """Whatever the subpackage cannot import, the rest stays registered."""
    code = f"import sys; sys.modules['{package}'] = None; import __spark_entry__ as e; q = e.queries(); assert len(q) >= 75 and not any(k.startswith('op') for k in q) and set(e.oracle_sql()) == set(q)"
    r = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert r.returncode == 0 and "left out" in r.stderr, r.stderr[-2000:]


def test_other_tests_work_without_these_folders(tmp_path):
    """With the subpackage, its tests and the pipeline gone, every other test is found and a part of them is run."""
    import shutil

    for name in ("__spark_entry__.py", "bench.py"):
        shutil.copy(f"{ROOT}/{name}", tmp_path)
    for name in ("starloom", "tests"):
        shutil.copytree(f"{ROOT}/{name}", tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__", ".pytest_cache"))
    run = lambda *a: subprocess.run([sys.executable, "-m", "pytest", "-q", "-p", "no:cacheprovider", *a], cwd=tmp_path, capture_output=True, text=True, timeout=600)
    found = run("--collect-only", "tests")
    assert found.returncode == 0, found.stdout[-2000:]
    some = run("tests/test_functions.py", "tests/test_deliveries.py", "-k", "test_functions or one_row_a_code or registered_once or rejected_values")
    assert some.returncode == 0 and "passed" in some.stdout, some.stdout[-2000:]


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_plans_hold_no_cross_join(spark, key):
    from conftest import plan_text

    text = plan_text(QUERIES[key](spark, SF_SMALL), "formatted")
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text  # no function a row

"""Every registered query against its DuckDB statement (names, types, rows,
order-insensitive value hash). Runs at sf0.001; the driver's check runs the
same pairs at sf0.01 (``python tests/oracle_check.py`` does it locally)."""

import pytest
from conftest import SF_SMALL

from __spark_entry__ import entry
from __spark_entry__ import queries as registered
from oracle_check import compare, duck
from starloom.plans.oracle import ORACLE
from starloom.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) <= set(registered())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, con, SF_SMALL, key, QUERIES[key], ORACLE.get(key))
    assert r["status"] == "ok", r


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["o_orderstatus", "o_orderpriority", "data", "qtd_clientes"]
    assert df.count() > 0


ANSI_SENSITIVE = ["scalar_cast", "recode_map", "parse_age_text", "code_prefix", "scalar_regexp",
                  "filter_code_eq", "star_srag_conformed", "star_vaccination_fact", "csv_preamble_scan"]


@pytest.mark.parametrize("key", ANSI_SENSITIVE)
def test_conform_keys_match_oracle_with_ansi_off(spark, con, key):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        r = compare(spark, con, SF_SMALL, key, QUERIES[key], ORACLE[key])
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert r["status"] == "ok", r


def test_contract_loads_by_path_from_another_directory(tmp_path):
    import os
    import subprocess
    import sys
    entry_file = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    code = ("import importlib.util as u; s = u.spec_from_file_location('e', %r); m = u.module_from_spec(s); "
            "s.loader.exec_module(m); q, o = m.queries(), m.oracle_sql(); "
            "assert q and set(o) <= set(q) and all(callable(f) for f in q.values()); print(len(q))") % entry_file
    r = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert r.returncode == 0, r.stderr[-2000:]
    assert int(r.stdout.strip()) == len(registered())

"""Plan shape: no Python workers, pushdown and pruning at the scan, no hidden
jobs, partial aggregation before every shuffle."""

import re

import pytest
from conftest import SF_SMALL, plan_text

from starloom.plans.queries import QUERIES

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")
# Queries that write an intermediate table before they return.
WRITES = {"csv_scan", "csv_glob_scan", "csv_preamble_scan", "csv_part_token", "parquet_roundtrip",
          "partitioned_roundtrip", "stream_ingest", "star_vaccination_jobs", "star_deaths_jobs",
          "star_notification_jobs", "star_vaccination_tables", "ingest_incremental", "write_counted",
          "srag_year_selection", "star_census_conformed"}


@pytest.fixture(scope="module")
def plans(spark):
    """The formatted plan of every query, built once."""
    return {key: plan_text(fn(spark, SF_SMALL), "formatted") for key, fn in QUERIES.items()}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_in_plan(plans, key):
    assert not any(n in plans[key] for n in PY_NODES), key


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_few_pattern_replacements_in_a_plan_node(plans, key):
    """Casts and age texts name their input once: filters that Spark copies
    below an aggregate don't multiply it."""
    for node in plans[key].split("\n("):
        assert node.count("regexp_replace") <= 2 * max(1, node.count("AS ")), key


def test_census_scan_has_no_pattern_replacement(plans):
    assert "regexp_replace" not in plans["csv_preamble_scan"]


@pytest.mark.parametrize("key", sorted(set(QUERIES) - WRITES))
def test_planning_starts_no_job_but_schema_inference(spark, key):
    """A group of jobs of its own for the query's building; Parquet schema
    inference is one job a scanned table."""
    context = spark.sparkContext
    context.setJobGroup(f"plan-{key}", key)
    try:
        text = plan_text(QUERIES[key](spark, SF_SMALL), "formatted")
    finally:
        context.setJobGroup("rest", "rest")
    jobs = context.statusTracker().getJobIdsForGroup(f"plan-{key}")
    assert len(jobs) <= 8 and len(jobs) <= text.count("Location: ") + 2, (key, jobs)


def test_a_capped_write_starts_no_more_jobs(spark, workdir):
    from starloom.sources import write_parquet

    fact, context, seen = QUERIES["fact_count"](spark, SF_SMALL), spark.sparkContext, []
    for n, cap in enumerate((None, 4)):
        context.setJobGroup(f"write-{n}-{workdir}", "write")
        write_parquet(fact, f"{workdir}/{n}", max_files=cap)
        seen.append(len(context.statusTracker().getJobIdsForGroup(f"write-{n}-{workdir}")))
    context.setJobGroup("rest", "rest")
    assert seen[1] <= seen[0] + 1  # the stage that deals the rows, which AQE runs as a job; none to count them


def test_a_capped_write_leaves_the_aggregate_its_partitions(spark, workdir):
    """The cap's shuffle stands above the aggregate's own, and the write keeps the cap."""
    from unittest import mock

    from pyspark.sql import DataFrameWriter

    from starloom.sources import write_parquet

    fact, seen = QUERIES["fact_count"](spark, SF_SMALL), []
    with mock.patch.object(DataFrameWriter, "save", lambda self, path: seen.append(self._df)):
        write_parquet(fact, "unused", max_files=3)
    tree = [ln.strip(" +-:*") for ln in plan_text(seen[0], "formatted").split("\n\n")[0].splitlines()]
    kinds = [re.sub(r" \(.*", "", ln) for ln in tree]
    assert kinds[:5] == ["== Physical Plan ==", "AdaptiveSparkPlan", "Exchange", "HashAggregate", "Exchange"], kinds
    assert "Coalesce" not in kinds
    import glob

    big = spark.range(0, 3_000_000, 1, 16).selectExpr("id", "id * 7 % 1000003 as v")
    for cap in (1, 3, 5):
        write_parquet(big, f"{workdir}/{cap}", max_files=cap)
        assert 1 <= len(glob.glob(f"{workdir}/{cap}/*.parquet")) <= cap
        assert spark.read.parquet(f"{workdir}/{cap}").agg({"id": "sum"}).first()[0] == 3_000_000 * 2_999_999 // 2


def test_deaths_fact_filters_reach_the_layer_scan(plans):
    pushed = re.search(r"PushedFilters: \[(.*)\]", plans["star_deaths_jobs"]).group(1)
    for f in ("EqualTo(cod_evolucao_num,2)", "GreaterThanOrEqual(cod_idade,10)", "In(cod_sexo", "EqualTo(cod_uf_paciente,SE)"):
        assert f in pushed, f


def test_fact_filters_reach_parquet_scan(spark):
    text = plan_text(QUERIES["fact_count_distinct"](spark, SF_SMALL), "formatted")
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    for f in ("In(o_orderstatus", "GreaterThanOrEqual(o_totalprice", "Not(EqualTo(o_orderpriority",
              "GreaterThanOrEqual(o_orderdate"):
        assert f in pushed
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert "o_orderkey" not in schema and "o_custkey" in schema


def test_count_distinct_is_partially_aggregated(spark):
    text = plan_text(QUERIES["fact_count_distinct"](spark, SF_SMALL), "formatted")
    assert "partial_count(distinct" in text
    assert text.count("Exchange") >= 2


def test_having_moves_below_aggregate(spark):
    text = plan_text(QUERIES["fact_sum_shifted"](spark, SF_SMALL), "formatted")
    scan_filter = text.split("(2) Filter")[1].split("(3)")[0]
    assert "+ 9) >= 10" in scan_filter


def test_geo_dimension_dedups_then_broadcasts_lookup(spark):
    text = plan_text(QUERIES["dim_geo_join"](spark, SF_SMALL), "formatted")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    # the fact-side codes are deduplicated (aggregate) before the join
    tree = text.split("\n\n")[0]
    join_line = next(i for i, ln in enumerate(tree.splitlines()) if "BroadcastHashJoin Inner" in ln)
    below = [ln for ln in tree.splitlines()[join_line + 1 :] if "BroadcastExchange" not in ln]
    assert "HashAggregate" in below[0]


def test_fact_over_written_layer_pushes_every_filter_to_the_scan(spark):
    text = plan_text(QUERIES["star_vaccination_jobs"](spark, SF_SMALL), "formatted")
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    for f in ("EqualTo(paciente_endereco_uf,SE)", "In(cod_sexo", "GreaterThanOrEqual(cod_idade,10)",
              "LessThanOrEqual(cod_idade,110)", "Not(EqualTo(cod_dose,0))", "GreaterThanOrEqual(data_aplicacao"):
        assert f in pushed, f
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert "vacina_nome" not in schema and "paciente_dataNascimento" not in schema

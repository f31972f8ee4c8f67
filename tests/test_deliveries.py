"""Delivery queries against DuckDB, continued facts, the one-scan tables, one row a code."""

import contextlib
import io
import os
import time

import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL, plan_text
from oracle_check import compare, duck
from pyspark.sql import functions as F

import fixtures as fx
from starloom.operators import DimSpec, FactSpec, Measure, OnePass, build_dim, build_fact, dim_conflicts, reject_account, rejected_values
from starloom.plans import continued, delivery_queries, jobs, queries, star
from starloom.plans.continued import compact, continue_fact, continued_fact
from starloom.plans.delivery_oracle import DELIVERY_ORACLE
from starloom.plans.delivery_queries import DELIVERY_QUERIES
from starloom.sources import current, read_delivered, read_rejects, read_replaced, shared_root, shuffles_released

TOKEN = r"^[^-]*-([^-.]+)"
ROWS = [r for _, r in fx.vaccination_rows()]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(DELIVERY_QUERIES))
def test_query_equals_its_statement(spark, con, key):
    assert set(DELIVERY_QUERIES) == set(DELIVERY_ORACLE)
    r = compare(spark, con, SF_SMALL, key, DELIVERY_QUERIES[key], DELIVERY_ORACLE[key])
    assert r["status"] == "ok", r


def test_names_are_registered_once():
    from __spark_entry__ import oracle_sql, queries
    from starloom.plans.queries import QUERIES

    assert not set(QUERIES) & set(DELIVERY_QUERIES)
    assert set(DELIVERY_QUERIES) <= set(queries()) and set(DELIVERY_QUERIES) <= set(oracle_sql())


def lay(workdir, name, rows, at):
    path = f"{workdir}/raw/{name}"
    fx.write_csv(path, fx.VACC_COLUMNS, rows)
    os.utime(path, (at, at))


SPECS = {
    "count": (FactSpec(("cod_sexo", "data"), Measure("count", "n", cast="float")), "bitmaps"),
    "sum": (FactSpec(("cod_vacina",), Measure("sum", "n", "cod_idade")), "bitmaps"),
    "bitmaps": (FactSpec(("cod_sexo", "cod_vacina"), Measure("count_distinct", "n", "document_id")), "bitmaps"),
    "pairs": (FactSpec(("cod_sexo", "cod_vacina"), Measure("count_distinct", "n", "document_id")), "pairs"),
}


@pytest.mark.parametrize("kind", sorted(SPECS))
def test_continued_facts_equal_the_rebuild(spark, workdir, kind):
    """New, changed, emptied and withdrawn files; ids that several files share, and a null id."""
    spec, distinct = SPECS[kind]
    layer, state = f"{workdir}/layer", f"{workdir}/state"
    rows = [{**r, "document_id": None if k == 3 else r["document_id"]} for k, r in enumerate(ROWS)]
    run = lambda **kw: jobs.deliver_vaccination(spark, f"{workdir}/raw", layer, TOKEN, **kw)

    def same():
        rebuilt = sorted(map(tuple, build_fact(read_delivered(spark, layer), spec).collect()), key=str)
        out = continued_fact(spark, state, spec, distinct)
        assert out.dtypes == build_fact(read_delivered(spark, layer), spec).dtypes
        assert sorted(map(tuple, out.collect()), key=str) == rebuilt and rebuilt

    lay(workdir, "a/vac-01.csv", rows[:6], 1000)
    lay(workdir, "b/vac-01.csv", rows[4:9], 1000)
    run()
    assert continue_fact(spark, layer, state, spec, distinct) == 2
    same()
    lay(workdir, "b/vac-01.csv", rows[5:11], 2000)
    lay(workdir, "c/vac-02.csv", rows[9:], 2000)
    run()
    assert continue_fact(spark, layer, state, spec, distinct) == 2
    same()
    assert continue_fact(spark, layer, state, spec, distinct) == 0
    lay(workdir, "a/vac-01.csv", [], 3000)
    os.rename(f"{workdir}/raw/c/vac-02.csv", f"{workdir}/gone.csv")
    run(drop_withdrawn=True)
    assert continue_fact(spark, layer, state, spec, distinct) == 1
    same()
    compact(spark, state)
    same()
    lay(workdir, "c/vac-02.csv", rows[2:], 4000)
    run()
    assert continue_fact(spark, layer, state, spec, distinct) == 1
    same()
    with pytest.raises(ValueError, match="another spec"):
        continue_fact(spark, layer, state, FactSpec(("cod_idade",), spec.measure), distinct)


def test_bitmaps_take_no_more_room_than_their_ids(spark):
    """A group of few ids, far apart, keeps a word for each; a dense one a word for 64."""
    spec = FactSpec(("k",), Measure("count_distinct", "n", "id"))
    sparse = spark.range(300).selectExpr("'f' as arquivo", "'1' as versao", "cast(id as int) as k", "id * 40000 + (1L << 33) as numero")
    dense = spark.range(6400).selectExpr("'f' as arquivo", "'1' as versao", "-1 as k", "id as numero")
    null = spark.range(1).selectExpr("'f' as arquivo", "'1' as versao", "-2 as k", "cast(null as long) as numero")
    parts = continued._partials(sparse.union(dense).union(dense).union(null), spec, "bitmaps")
    kept = {r["k"]: (r["rows"], r["bytes"]) for r in parts.groupBy("k").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.length(F.hex("parcial")) / 2).alias("bytes")).collect()}
    assert all(kept[k][0] == 1 and kept[k][1] <= 8 for k in range(300)) and kept[-1] == (100, 800)
    found = {r["k"]: r["n"] for r in continued._merged(parts.unionByName(parts), spec, "bitmaps").collect()}
    assert found == {**dict.fromkeys(range(300), 1), -1: 6400, -2: 0}


def test_a_failed_continuation_leaves_the_state(spark, workdir):
    spec, _ = SPECS["count"]
    layer, state = f"{workdir}/layer", f"{workdir}/state"
    lay(workdir, "vac-01.csv", ROWS[:6], 1000)
    jobs.deliver_vaccination(spark, f"{workdir}/raw", layer, TOKEN)
    continue_fact(spark, layer, state, spec)
    before = sorted(map(str, continued_fact(spark, state, spec).collect()))
    lay(workdir, "vac-02.csv", ROWS[6:], 1000)
    jobs.deliver_vaccination(spark, f"{workdir}/raw", layer, TOKEN)
    broken = FactSpec(spec.keys, spec.measure, where=None)
    import starloom.plans.continued as continued

    whole = continued._partials
    try:
        continued._partials = lambda rows, *a: whole(rows.withColumn("cod_sexo", F.raise_error(F.lit("midway")).cast("string")), *a)
        with pytest.raises(Exception, match="midway"):
            continue_fact(spark, layer, state, broken)
    finally:
        continued._partials = whole
    assert current(spark, state)[0] == 1
    assert sorted(map(str, continued_fact(spark, state, spec).collect())) == before
    assert continue_fact(spark, layer, state, spec) == 1
    assert sorted(map(str, continued_fact(spark, state, spec).collect())) == sorted(map(str, build_fact(read_delivered(spark, layer), spec).collect()))


def test_rejects_by_file_and_column(spark, workdir):
    bad = [{**ROWS[0], "paciente_idade": "x1", "vacina_dataAplicacao": "31/12"}, {**ROWS[0], "paciente_idade": " "}, {**ROWS[0], "paciente_idade": "a9"}]
    good = [ROWS[0]]
    lay(workdir, "vac-01.csv", bad, 1000)
    lay(workdir, "vac-02.csv", good, 1000)
    run = lambda: jobs.deliver_vaccination(spark, f"{workdir}/raw", f"{workdir}/l", TOKEN)
    found = lambda: {(r["arquivo"], r["coluna"]): (r["valores"], r["exemplo"]) for r in read_rejects(spark, f"{workdir}/l").collect()}
    base = run().rejected
    assert found().items() >= {("vac-01.csv", "paciente_idade"): (2, "a9"), ("vac-01.csv", "vacina_dataAplicacao"): (1, "31/12")}.items()
    assert base == sum(n for n, _ in found().values())
    lay(workdir, "vac-01.csv", good, 2000)  # a corrected file takes its account along
    run()
    assert not any(f == "vac-01.csv" and c == "paciente_idade" for f, c in found())


def test_rejected_values_of_any_projection(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "x"), ("b", None), ("b", "  "), ("b", "y")], "f string, t string").withColumn("v", F.expr("try_cast(t as int)"))
    rows = df.withColumn("rejeitos", rejected_values({"t": ("t", "v"), "none": (F.lit(None).cast("string"), F.lit(None).cast("int"))}))
    assert sorted(map(tuple, reject_account(rows, "f").collect())) == [("a", "t", 1, "x"), ("b", "t", 1, "y")]
    srag = star.conform_srag(spark.createDataFrame([tuple("zz" for _ in star.V.SRAG_COLUMNS)], ", ".join(f"`{c}` string" for c in star.V.SRAG_COLUMNS)), account=True)
    assert {r["coluna"] for r in srag.first()["rejeitos"]} == set(star.SRAG_READ)


def test_only_rows_with_rejects_build_the_array(spark):
    raw = spark.createDataFrame([tuple("1" for _ in fx.VACC_COLUMNS), tuple(None for _ in fx.VACC_COLUMNS)], ", ".join(f"`{c}` string" for c in fx.VACC_COLUMNS))
    rows = star.conform_vaccination(raw, account=True)
    few = spark.createDataFrame([("x", None)], "t string, v int").select(rejected_values({"t": ("t", "v")}).alias("rejeitos"))
    assert "ELSE [] END AS rejeitos" in plan_text(few)
    assert "_nascimento" not in rows.columns and [len(r["rejeitos"]) for r in rows.collect()] == [2, 0]


def test_ingest_sorts_the_raw_columns(spark, workdir, monkeypatch):
    seen, whole = [], star.conform_vaccination
    monkeypatch.setattr(star, "conform_vaccination", lambda raw: seen.append(raw) or whole(raw))
    raw = fx.write_vaccination(workdir)
    written = jobs.ingest_vaccination(spark, raw, f"{workdir}/pre")
    assert "Sort" in plan_text(seen[0], "formatted").split("\n\n")[0]
    assert jobs.read_vaccination_layer(spark, f"{workdir}/pre").count() == written > 0


def test_one_scan_gives_the_same_tables(spark, workdir):
    raw, loc = fx.write_vaccination(workdir), fx.write_localities(workdir)
    jobs.ingest_vaccination(spark, raw, f"{workdir}/pre")
    many = jobs.build_vaccination_tables(spark, f"{workdir}/pre", loc, f"{workdir}/many")
    once = jobs.build_vaccination_tables(spark, f"{workdir}/pre", loc, f"{workdir}/once", one_scan=True)
    kept = jobs.build_vaccination_tables(spark, f"{workdir}/pre", loc, f"{workdir}/kept", one_scan=True, versioned=True)
    for name in many:
        a, b, c = spark.read.parquet(many[name]), spark.read.parquet(once[name]), read_replaced(spark, kept[name])
        assert a.dtypes == b.dtypes == c.dtypes
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) == sorted(map(str, c.collect()))
    named = [jobs.build_vaccination_tables(spark, f"{workdir}/pre", loc, f"{workdir}/n{k}", one_name=True, one_scan=bool(k)) for k in (0, 1)]
    for name in named[0]:
        a, b = (spark.read.parquet(n[name]) for n in named)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
        if name.startswith("dm_"):
            assert a.count() == a.select(a.columns[0]).distinct().count()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        star.vaccination_pass(jobs.read_vaccination_layer(spark, f"{workdir}/pre")).rows.explain()
    assert text.getvalue().count("FileScan") == 1 and text.getvalue().count("Exchange") == 1


def test_one_pass_of_mixed_types(spark):
    df = spark.range(100).selectExpr("id", "cast(id % 7 as int) as a", "cast(id % 3 as string) as b", "cast(null as date) as c")
    once = OnePass(df, {"x": ({"a": "a", "b": "b"}, None), "y": ({"id": "id", "c": "c"}, F.col("id") < 5), "z": ({"bb": F.upper("b")}, F.col("a").isNull())})
    assert sorted(map(tuple, once.table(once.rows, "x").drop("_linhas").collect())) == sorted(map(tuple, df.select("a", "b").distinct().collect()))
    assert sorted(r["id"] for r in once.table(once.rows, "y").collect()) == [0, 1, 2, 3, 4]
    assert once.table(once.rows, "z").count() == 0
    assert once.table(once.rows, "x").agg(F.sum("_linhas")).first()[0] == 100


def test_one_row_a_code(spark):
    df = spark.createDataFrame([(1, "b"), (1, "b"), (1, "a"), (2, "z"), (2, "y"), (3, None), (3, None), (3, "c"), (None, "n")], "k int, v string")
    spec = DimSpec({"k": "k", "v": "v"}, unique_by=("k",))
    assert sorted(map(tuple, build_dim(df, spec).collect()), key=str) == [(1, "b"), (2, "y"), (3, None), (None, "n")]
    assert sorted(map(tuple, dim_conflicts(df, spec).collect())) == [(1, 2, 3, 1), (2, 2, 2, 1), (3, 2, 3, 1)]
    assert build_dim(df, DimSpec({"k": "k", "v": "v"})).count() == 7
    assert sorted(r["k"] for r in build_dim(df, DimSpec({"k": "k"}, not_null=("k",), unique_by=("k",))).collect()) == [1, 2, 3]


def scratch_tables(spark):
    base = f"{shared_root(spark)}/starloom".removeprefix("file:")
    return {n for n in os.listdir(base)} if os.path.isdir(base) else set()


def codecs(path):
    files = [os.path.join(r, f) for r, _, fs in os.walk(path.removeprefix("file:")) for f in fs if f.endswith(".parquet")]
    return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files if pq.ParquetFile(f).metadata.num_row_groups}


def test_writes_release_their_shuffle_files(spark, workdir):
    where = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {os.path.join(r, f) for d in where for r, _, fs in os.walk(d) for f in fs if f.startswith("shuffle_")}
    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", files()
    with shuffles_released(spark):
        assert spark.conf.get(key) == "true"
        spark.range(1000).groupBy(F.col("id") % 7).count().write.parquet(f"{workdir}/t")
    for _ in range(50):  # they are deleted behind the write
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and spark.conf.get(key) == "false"
    with pytest.raises(ZeroDivisionError), shuffles_released(spark):
        1 / 0
    assert spark.conf.get(key) == "false"


def test_tables_are_built_without_the_raw_files(spark, monkeypatch):
    seen, whole, before = {}, queries.build_vaccination_tables, scratch_tables(spark)
    write = queries._write_raw_csv

    def laid(df, path, **kw):
        write(df, path, **kw)
        seen[path.rsplit("/", 1)[1].split("-")[0]] = {n.split(".", 1)[1] for n in os.listdir(path.removeprefix("file:")) if n.startswith("part")}

    def built(spark, layer, *a, **kw):
        seen.update(left={n.split("-")[0] for n in scratch_tables(spark) - before}, codec=codecs(layer))
        return whole(spark, layer, *a, **kw)

    monkeypatch.setattr(queries, "build_vaccination_tables", built)
    monkeypatch.setattr(queries, "_write_raw_csv", laid)
    monkeypatch.setattr(queries, "PACKED_ROWS", 1000)
    found = {r["tabela"]: r["linhas"] for r in queries.star_vaccination_tables(spark, SF_SMALL).collect()}
    assert seen["tables_raw"] == {"csv.lz4"} and seen["left"] == {"tables_layer", "tables_loc"} and seen["codec"] == {"ZSTD"}
    assert found["fato_vacinas"] == star_fact(spark).count() and len(found) == 12


def star_fact(spark):
    return build_fact(star.conform_vaccination(queries._vaccination_text(spark, SF_SMALL)), star.vaccination_fact_spec())


def test_raw_files_go_before_the_state_is_continued(spark, monkeypatch):
    """The state is made while no raw file is there that no listing needs, and
    the layer is gone before the state is merged."""
    before, seen = scratch_tables(spark), []
    left = lambda: {n for n in scratch_tables(spark) - before}

    def after(layer):
        base = f"{shared_root(spark)}/starloom".removeprefix("file:")
        raw = [n for n in left() if n.startswith("delivery_raw")]
        seen.append(sorted(f for n in raw for f in os.listdir(f"{base}/{n}")))
        seen.append(codecs(layer + "/dados"))

    monkeypatch.setattr(queries, "PACKED_ROWS", 1000)
    rows = read_delivered(spark, delivery_queries._two_deliveries(spark, SF_SMALL, after))
    assert seen == [["jan"], {"ZSTD"}, [], {"ZSTD"}]
    assert rows.count() == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert rows.select("arquivo").distinct().count() > 3 and rows.where("arquivo not like '%.csv.lz4'").count() == 0


@pytest.mark.parametrize("key", ["fact_distinct_continued", "star_vaccination_continued"])
def test_a_continued_fact_leaves_its_state_alone(spark, key):
    before = scratch_tables(spark)
    assert DELIVERY_QUERIES[key](spark, SF_SMALL).count() > 0
    left = scratch_tables(spark) - before
    assert {n.split("-")[0] for n in left} == {"continued_state"}
    base = f"{shared_root(spark)}/starloom"
    assert codecs(f"{base}/{left.pop()}/parciais") == {"ZSTD"}

"""Deliveries by the ledger, header discovery, and atomic replacement."""

import os

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

import fixtures as fx
from starloom.plans import jobs, star
from starloom.sources import (
    Delivery,
    current,
    deliver,
    drop_unused,
    header_groups,
    prune,
    read_by_header,
    read_delivered,
    read_ledger,
    read_replaced,
    replace_parquet,
)

TOKEN = r"^[^-]*-([^-.]+)"
ROWS = [r for _, r in fx.vaccination_rows()]


def lay(workdir, name, rows, columns=fx.VACC_COLUMNS, at=None):
    path = f"{workdir}/raw/{name}"
    fx.write_csv(path, columns, rows)
    if at is not None:
        os.utime(path, (at, at))


def held(spark, layer):
    return {r["arquivo"]: r["count"] for r in read_delivered(spark, layer).groupBy("arquivo").count().collect()}


def test_raw_rows_are_sorted_and_find_their_file_in_a_lookup(spark, workdir):
    """What a row carries through the sort is the raw text, and its path is not searched."""
    seen = []
    conform = lambda raw: seen.append(raw) or star.conform_vaccination(raw, account=True)
    lay(workdir, "jan/vac-01.csv", ROWS[:5])
    lay(workdir, "feb/vac-01.csv", ROWS[5:8], list(reversed(fx.VACC_COLUMNS)))
    assert deliver(spark, f"{workdir}/raw", f"{workdir}/layer", conform, part_token=TOKEN, sort_within=["paciente_endereco_uf"]).rows == 8
    nodes = plan_text(seen[0], "formatted").split("\n\n")
    assert "Sort" in nodes[0] and "BroadcastHashJoin" in nodes[0]
    assert held(spark, f"{workdir}/layer") == {"jan/vac-01.csv": 5, "feb/vac-01.csv": 3}
    late = lambda raw: star.conform_vaccination(raw).withColumn("doc2", F.reverse("document_id"))
    assert deliver(spark, f"{workdir}/raw", f"{workdir}/other", late, part_token=TOKEN, sort_within=["doc2"]).rows == 8
    assert held(spark, f"{workdir}/other") == {"jan/vac-01.csv": 5, "feb/vac-01.csv": 3}


def test_deliveries(spark, workdir):
    """Equal names in two folders, a changed file, a withdrawn one, one that lost its rows."""
    layer, raw = f"{workdir}/layer", f"{workdir}/raw"
    lay(workdir, "jan/vac-01.csv", ROWS[:5], at=1000)
    lay(workdir, "feb/vac-01.csv", ROWS[5:8], at=1000)
    run = lambda **kw: jobs.deliver_vaccination(spark, raw, layer, TOKEN, **kw)
    assert run() == Delivery(2, 0, 0, 0, 8, 1)
    assert held(spark, layer) == {"jan/vac-01.csv": 5, "feb/vac-01.csv": 3}
    assert run() == Delivery(0, 0, 2, 0, 0, 1)  # no news, nothing written

    lay(workdir, "feb/vac-01.csv", ROWS[5:9], at=2000)
    lay(workdir, "mar/vac-02.csv", ROWS[9:11], at=2000)
    assert run() == Delivery(1, 1, 1, 0, 6, 2)
    assert held(spark, layer) == {"jan/vac-01.csv": 5, "feb/vac-01.csv": 4, "mar/vac-02.csv": 2}
    ledger = {r["arquivo"]: (r["parte"], r["linhas"], r["tamanho"]) for r in read_ledger(spark, layer).collect()}
    assert ledger == {f: (p, n, os.path.getsize(f"{raw}/{f}")) for f, p, n in (("jan/vac-01.csv", "01", 5), ("feb/vac-01.csv", "01", 4), ("mar/vac-02.csv", "02", 2))}

    lay(workdir, "feb/vac-01.csv", [], at=3000)  # a header and no rows
    os.rename(f"{raw}/jan/vac-01.csv", f"{workdir}/jan.csv")
    assert run() == Delivery(0, 1, 1, 1, 0, 3)
    assert held(spark, layer) == {"jan/vac-01.csv": 5, "mar/vac-02.csv": 2}  # reported, its rows kept
    assert run(drop_withdrawn=True) == Delivery(0, 0, 2, 1, 0, 4)
    assert held(spark, layer) == {"mar/vac-02.csv": 2}
    assert jobs.read_vaccination_layer(spark, layer).count() == 2


def test_an_empty_file_and_an_empty_folder(spark, workdir):
    os.makedirs(f"{workdir}/raw")
    assert jobs.deliver_vaccination(spark, f"{workdir}/raw", f"{workdir}/l", TOKEN) == Delivery(0, 0, 0, 0, 0, 0)
    open(f"{workdir}/raw/vac-01.csv", "w").close()  # no byte: not there yet
    assert jobs.deliver_vaccination(spark, f"{workdir}/raw", f"{workdir}/l", TOKEN) == Delivery(0, 0, 0, 0, 0, 0)
    lay(workdir, "vac-01.csv", [], at=1000)
    assert jobs.deliver_vaccination(spark, f"{workdir}/raw", f"{workdir}/l", TOKEN) == Delivery(1, 0, 0, 0, 0, 1)
    assert held(spark, f"{workdir}/l") == {}
    lay(workdir, "vac-01.csv", ROWS[:2], at=2000)
    assert jobs.deliver_vaccination(spark, f"{workdir}/raw", f"{workdir}/l", TOKEN) == Delivery(0, 1, 0, 0, 2, 2)
    assert held(spark, f"{workdir}/l") == {"vac-01.csv": 2}


def test_a_failed_delivery_changes_nothing(spark, workdir):
    layer, raw = f"{workdir}/layer", f"{workdir}/raw"
    lay(workdir, "vac-01.csv", ROWS[:5], at=1000)
    jobs.deliver_vaccination(spark, raw, layer, TOKEN)
    lay(workdir, "vac-01.csv", ROWS[:9], at=2000)

    def fails_midway(df):
        bad = F.when(F.col("document_id") == ROWS[8]["document_id"], F.raise_error(F.lit("midway"))).otherwise(F.col("document_id"))
        return star.conform_vaccination(df).withColumn("document_id", bad.cast("string"))

    with pytest.raises(Exception, match="midway"):
        deliver(spark, raw, layer, fails_midway, part_token=TOKEN)
    assert held(spark, layer) == {"vac-01.csv": 5} and current(spark, layer)[0] == 1
    assert jobs.deliver_vaccination(spark, raw, layer, TOKEN) == Delivery(0, 1, 0, 0, 9, 2)
    assert held(spark, layer) == {"vac-01.csv": 9}


def test_later_files_may_bring_columns(spark, workdir):
    layer = f"{workdir}/layer"
    lay(workdir, "vac-01.csv", ROWS[:2], at=1000)
    jobs.deliver_vaccination(spark, f"{workdir}/raw", layer, TOKEN)
    lay(workdir, "vac-02.csv", [{**r, "lote": "x"} for r in ROWS[2:4]], [*reversed(fx.VACC_COLUMNS), "lote"], at=1000)
    jobs.deliver_vaccination(spark, f"{workdir}/raw", layer, TOKEN)
    assert {r["arquivo"]: r["lote"] for r in read_delivered(spark, layer).select("arquivo", "lote").collect()} == {"vac-01.csv": None, "vac-02.csv": "x"}


def test_a_failed_replacement_leaves_the_old_version(spark, workdir):
    base = f"{workdir}/t"
    assert replace_parquet(spark.range(10), base) == 1
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("midway")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="midway"):
        replace_parquet(broken, base)
    assert read_replaced(spark, base).count() == 10 and current(spark, base)[0] == 1
    reader = read_replaced(spark, base)
    assert replace_parquet(spark.range(20), base, max_files=2) == 2
    assert read_replaced(spark, base).count() == 20
    assert reader.count() == 10  # an open reader keeps its version
    assert len(prune(spark, base)) == 2 and prune(spark, base) == []
    assert read_replaced(spark, base).count() == 20


def test_partitions_are_replaced_together_or_not_at_all(spark, workdir):
    base = f"{workdir}/years"
    rows = lambda n: spark.range(n).selectExpr("id", "cast(2020 + id % 3 as string) as ano")
    replace_parquet(rows(30), base, partition_by=["ano"])
    with pytest.raises(Exception, match="midway"):
        replace_parquet(rows(60).withColumn("id", F.when(F.col("id") == 50, F.raise_error(F.lit("midway")).cast("long")).otherwise(F.col("id"))), base, partition_by=["ano"])
    assert [r["count"] for r in read_replaced(spark, base).groupBy("ano").count().collect()] == [10, 10, 10]


def test_two_writers_of_one_version(spark, workdir):
    from starloom.sources.versions import commit

    base = f"{workdir}/t"
    replace_parquet(spark.range(3), base)
    with pytest.raises(RuntimeError, match="another writer"):
        commit(spark, base, 1, {"folder": "other"})
    assert read_replaced(spark, base).count() == 3
    with pytest.raises(ValueError, match="no version"):
        read_replaced(spark, f"{workdir}/none")


def test_headers_that_differ_in_case_or_a_mark_unite(spark, workdir):
    os.makedirs(f"{workdir}/h")
    texts = {"a-01.csv": "Idade;sexo\n30;F\n", "b-02.csv": "﻿idade;SEXO\n31;M\n", "c-03.csv": '"idade" ; "sexo"\r\n32;F\r\n',
             "d-04.csv": "SEXO;raca;IDADE\nM;1;33\n", "e-05.csv": "", "f-{6}[1].csv": "idade;sexo\n"}
    for name, text in texts.items():
        with open(f"{workdir}/h/{name}", "w", encoding="utf-8", newline="") as f:
            f.write(text)
    groups = header_groups(spark, f"{workdir}/h/*.csv")
    assert [(n, len(f)) for n, f in groups] == [(["Idade", "sexo"], 4), (["SEXO", "raca", "IDADE"], 1)]
    df = read_by_header(spark, f"{workdir}/h/*.csv", file_column="arquivo")
    assert df.columns == ["Idade", "sexo", "raca", "arquivo"]
    assert sorted(tuple(r) for r in df.collect()) == [("30", "F", None, "a-01.csv"), ("31", "M", None, "b-02.csv"), ("32", "F", None, "c-03.csv"), ("33", "M", "1", "d-04.csv")]
    fx.write_csv(f"{workdir}/h/g.csv", ["idade", "IDADE"], [])
    with pytest.raises(ValueError, match="twice"):
        header_groups(spark, f"{workdir}/h/*.csv")


def test_jobs_do_not_grow_with_the_files(spark, workdir):
    def jobs_of(n):
        folder = f"{workdir}/n{n}"
        os.makedirs(folder)
        for k in range(n):
            with open(f"{folder}/vac-{k}.csv", "w") as f:
                f.write(("idade;sexo\n" if k % 2 else "sexo;idade\n") + f"{k};x\n")
        group = f"headers-{n}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            assert read_by_header(spark, f"{folder}/*.csv").count() == n
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs_of(200) == jobs_of(80) < 12  # (Spark lists more than 32 paths in a job)


def test_versions_that_nothing_needs_are_dropped(spark, workdir):
    layer = f"{workdir}/layer"
    run = lambda: jobs.deliver_vaccination(spark, f"{workdir}/raw", layer, TOKEN)
    lay(workdir, "vac-01.csv", ROWS[:3], at=1000)
    lay(workdir, "vac-02.csv", ROWS[3:5], at=1000)
    run()
    lay(workdir, "vac-01.csv", ROWS[:4], at=2000)
    run()
    assert drop_unused(spark, layer) and held(spark, layer) == {"vac-01.csv": 4, "vac-02.csv": 2}  # an old ledger
    lay(workdir, "vac-02.csv", ROWS[3:9], at=3000)
    run()
    assert len(os.listdir(f"{layer}/dados")) >= 3
    assert len(drop_unused(spark, layer)) == 2 and drop_unused(spark, layer) == []
    assert held(spark, layer) == {"vac-01.csv": 4, "vac-02.csv": 6}
    assert sorted(d[:12] for d in os.listdir(f"{layer}/dados") if d.startswith("versao=")) == ["versao=00000"] * 2


def test_cli_delivery(workdir):
    import json
    import subprocess
    import sys

    fx.write_csv(f"{workdir}/raw/jan/vacinacao.csv", fx.VACC_COLUMNS, ROWS[:5])
    args = [sys.executable, "-m", "starloom", "vaccination-deliver", "--root", f"{workdir}/raw", "--layer", f"{workdir}/layer"]
    r = subprocess.run(args, cwd=fx.__file__.rsplit("/tests/", 1)[0], capture_output=True, text=True, timeout=300)
    assert r.returncode != 0 and "no part token" in r.stderr  # the name has none that the layout knows
    os.rename(f"{workdir}/raw/jan/vacinacao.csv", f"{workdir}/raw/jan/vacinacao-01-x.csv")
    r = subprocess.run(args, cwd=fx.__file__.rsplit("/tests/", 1)[0], capture_output=True, text=True, timeout=300)
    assert r.returncode == 0, r.stderr[-2000:]
    told = json.loads(r.stdout.strip().splitlines()[-1])
    assert (told["new"], told["rows"], told["version"]) == (1, 5, 1)


def test_srag_layer_keeps_what_was_not_read(spark, workdir):
    from starloom.operators import reject_account
    from starloom.sources import read_layer

    sources = fx.write_srag(workdir)
    assert jobs.ingest_srag(spark, sources, f"{workdir}/pre", account=True) == 7
    layer = read_layer(spark, f"{workdir}/pre", {"ano": "string"})
    account = {(r["ano"], r["coluna"]): r["valores"] for r in reject_account(layer, "ano").collect()}
    want = {}
    for r in layer.collect():
        for column, value in star.SRAG_READ.items():
            if r[column] is not None and r[column].strip() and any(x["coluna"] == column for x in r["rejeitos"]):
                want[r["ano"], column] = want.get((r["ano"], column), 0) + 1
    assert account == want

"""The batch jobs end to end on small raw extracts in the source layouts.

Expected rows are worked out by hand from the rules (see the comments in
fixtures.py) -- a brute-force reading of each fixture row."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from starloom.plans import jobs, star

D = dt.date


def rows_of(spark, path, order):
    return [tuple(r) for r in spark.read.parquet(path).orderBy(*order).collect()]


@pytest.fixture(scope="module")
def vaccination_tables(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("vacc"))
    raw = fx.write_vaccination(base)
    loc = fx.write_localities(base)
    written = jobs.ingest_vaccination(spark, raw, f"{base}/pre/vacinacao")
    paths = jobs.build_vaccination_tables(spark, f"{base}/pre/vacinacao", loc, f"{base}/structured")
    return base, written, paths


def test_vaccination_ingest_counts_and_parts(spark, vaccination_tables):
    base, written, _ = vaccination_tables
    assert written == len(fx.vaccination_rows())
    pre = spark.read.parquet(f"{base}/pre/vacinacao")
    parts = sorted(r.parte for r in pre.select(F.col("parte").cast("string").alias("parte")).distinct().collect())
    assert parts == ["1", "2"] or parts == ["01", "02"]
    from starloom.sources import read_layer
    typed = read_layer(spark, f"{base}/pre/vacinacao", {"parte": "string"})
    assert sorted(r.parte for r in typed.select("parte").distinct().collect()) == ["01", "02"]


def test_vaccination_fact(spark, vaccination_tables):
    _, _, paths = vaccination_tables
    dose = hashlib.sha256(b"1a Dose").hexdigest()
    a = ("NOV", 123, 201, 2, 86, "p1", dose, 1, "F", 45, 280030, 280030)
    got = rows_of(spark, paths["fato_vacinas"], ["data", "cod_idade", "cod_raca"])
    assert got == [
        ("NOV", 0, 0, 0, 0, "p1", dose, 1, "M", 10, 0, 0, D(2021, 1, 19), 1),   # d9
        ("0", 123, 201, 2, 86, "p1", dose, 99, "F", 10, 280030, 280030, D(2021, 1, 20), 1),  # d13
        (*a, D(2021, 1, 20), 2),                                                  # d1 twice + d2
        (*a, D(2021, 1, 21), 1),                                                  # d12
    ]


def test_vaccination_dims(spark, vaccination_tables):
    _, _, p = vaccination_tables
    dose = hashlib.sha256(b"1a Dose").hexdigest()
    assert rows_of(spark, p["dm_sexo"], ["cod_sexo"]) == [("F", "FEMININO"), ("M", "MASCULINO")]
    assert rows_of(spark, p["dm_sistemas"], ["cod_sistema_origem"]) == [("NOV", " NOVO PNI ")]
    assert rows_of(spark, p["dm_doses"], ["cod_dose"]) == [(dose, "1A DOSE")]
    assert rows_of(spark, p["dm_raca"], ["cod_raca"]) == [(1, "BRANCA"), (99, "SEM INFORMACAO")]
    assert rows_of(spark, p["dm_vacina"], ["cod_vacina", "nome_vacina"]) == [
        (0, "Coronavac", "Sinovac"), (86, "Coronavac", "Sinovac"), (86, "SEM INFORMACAO", "Sinovac")]
    assert rows_of(spark, p["dm_estabelecimento"], ["cod_estabelecimento"]) == [
        (0, "Hosp A", "SEM INFORMACAO"), (123, "Hosp A", "SEM INFORMACAO")]
    assert rows_of(spark, p["dm_paciente"], ["data_nascimento"]) == [
        ("p1", None, "49000"), ("p1", D(1976, 1, 1), "49000")]
    assert rows_of(spark, p["dm_grupo"], ["cod_grupo"]) == [(0, "Idosos"), (201, "Idosos")]
    assert rows_of(spark, p["dm_categoria"], ["cod_categoria"]) == [(0, "Faixa Etaria"), (2, "Faixa Etaria")]
    (estab,) = rows_of(spark, p["dm_regiao_estab"], ["cod_municipio_estab"])
    assert estab[:3] == (280030, "Aracaju", "SERGIPE")
    assert estab[3] == pytest.approx(-10.8, abs=1e-5) and estab[4] == pytest.approx(-37.07, abs=1e-5)
    (pac,) = rows_of(spark, p["dm_regiao_paciente"], ["cod_municipio_paciente"])
    assert pac[:4] == (280030, "Aracaju", "SERGIPE", "Brasil")


def test_srag_ingest_and_deaths(spark, workdir):
    sources = fx.write_srag(workdir)
    pre = f"{workdir}/pre/srag"
    assert jobs.ingest_srag(spark, sources, pre) == 7
    jobs.build_deaths_fact(spark, pre, f"{workdir}/obitos")
    got = rows_of(spark, f"{workdir}/obitos", ["cod_municipio_paciente", "data"])
    assert got == [(45, 0, "F", D(2021, 5, 10), 1.0),
                   (45, 280030, "F", None, 1.0),
                   (45, 280030, "F", D(2020, 3, 15), 2.0)]
    cases = spark.read.parquet(pre).orderBy("dat_notificacao", "cod_doses").collect()
    assert {r.cod_raca for r in cases} == {3, 99}
    doses_2020 = sorted(r.cod_doses for r in cases if r.dat_notificacao == D(2020, 3, 15))
    assert doses_2020 == [0, 0, 0, 1]
    assert {r.cod_risco for r in cases} == {"1", "9"}


def test_srag_single_year_rerun_keeps_other_years(spark, workdir):
    sources = fx.write_srag(workdir)
    pre = f"{workdir}/pre/srag"
    jobs.ingest_srag(spark, sources, pre)
    assert jobs.ingest_srag(spark, sources, pre, years=[2021]) == 3
    years = spark.read.parquet(pre).groupBy("ano").count().orderBy("ano").collect()
    assert [(r.ano, r["count"]) for r in years] == [(2020, 4), (2021, 3)]


def test_srag_absent_column_fill_value(spark, workdir):
    """With the source system's fill text '0', every 2020 case gets dose 1."""
    sources = fx.write_srag(workdir)
    pre = f"{workdir}/pre/srag0"
    jobs.ingest_srag(spark, sources, pre, years=[2020], fill="0")
    doses = [r.cod_doses for r in spark.read.parquet(pre).collect()]
    assert doses == [1, 1, 1, 1]


def test_notification_fact(spark, workdir):
    raw = fx.write_notifications(workdir)
    jobs.build_notification_fact(spark, raw, f"{workdir}/fato_not")
    got = rows_of(spark, f"{workdir}/fato_not", ["cod_municipio_paciente", "cod_sexo"])
    assert got == [(30, 0, "F", D(2021, 5, 20), 1.0), (30, 280030, "F", D(2021, 5, 20), 2.0),
                   (30, 280030, "M", D(2021, 5, 20), 1.0)]
    from starloom.sources import read_delimited
    conf = star.conform_notification(read_delimited(spark, raw))
    assert sorted({r.cod_doses for r in conf.collect()}) == ["1", "9"]
    assert conf.count() == 7


def test_population_and_age_dim(spark, workdir):
    census = fx.write_census(workdir)
    paths = jobs.build_population(spark, census, f"{workdir}/pop")
    assert rows_of(spark, paths["fato_populacao"], ["cod_sexo", "cod_idade"]) == [
        ("F", 280030, 19, 3), ("F", 280030, 110, 1), ("M", 280030, 10, 12)]
    ages = spark.read.parquet(paths["dm_faixa_etaria"])
    assert ages.count() == 101
    bands = {r.faixa_etaria: r["count"] for r in ages.groupBy("faixa_etaria").count().collect()}
    assert bands == {"De 10 a 19 anos": 10, "De 20 a 39 anos": 20, "De 40 a 59 anos": 20,
                     "De 60 a 89 anos": 30, "Mais de 90 anos": 21}


def test_calendar(spark, workdir):
    jobs.build_calendar(spark, f"{workdir}/cal")
    cal = spark.read.parquet(f"{workdir}/cal")
    assert cal.count() == 762
    assert cal.select("anosemana_epi").distinct().count() == 113
    r = cal.filter(F.col("data") == "2021-01-03").first()
    assert (r.dia, r.mes, r.ano, str(r.anomes), r.semana, r.semana_epi, r.anosemana_epi) == \
        ("03", "01", "2021", "2021-01-01", "53", "54", "202154")


def test_facts_have_unique_keys_and_reruns_are_identical(spark, workdir):
    raw = fx.write_vaccination(workdir)
    loc = fx.write_localities(workdir)
    jobs.ingest_vaccination(spark, raw, f"{workdir}/pre")
    first = jobs.build_vaccination_tables(spark, f"{workdir}/pre", loc, f"{workdir}/s1", concurrent_writes=1)
    snap = {n: sorted(map(repr, spark.read.parquet(p).collect())) for n, p in first.items()}
    jobs.ingest_vaccination(spark, raw, f"{workdir}/pre")           # re-run the ingest (dynamic overwrite)
    again = jobs.build_vaccination_tables(spark, f"{workdir}/pre", loc, f"{workdir}/s1")
    for n, p in again.items():
        assert sorted(map(repr, spark.read.parquet(p).collect())) == snap[n], n
    fact = spark.read.parquet(first["fato_vacinas"])
    keys = [c for c in fact.columns if c != "Qtd_Vacinas_Aplicadas"]
    assert fact.count() == fact.select(*keys).distinct().count()


def test_cli_calendar(workdir):
    import subprocess
    import sys
    out = f"{workdir}/cli_cal"
    r = subprocess.run([sys.executable, "-m", "starloom", "calendar", "--out", out, "--start", "2021-01-01",
                        "--end", "2021-01-31"], cwd=fx.__file__.rsplit("/tests/", 1)[0], capture_output=True,
                       text=True, timeout=300)
    assert r.returncode == 0, r.stderr[-2000:]
    import pyarrow.parquet as pq
    assert pq.read_table(out).num_rows == 31


def test_files_sharing_a_part_token_do_not_overwrite_each_other(spark, workdir):
    rows = [r for _, r in fx.vaccination_rows()]
    fx.write_csv(f"{workdir}/raw/vacinacao-07-a.csv", fx.VACC_COLUMNS, rows[:5])
    fx.write_csv(f"{workdir}/raw/vacinacao-07-b.csv", fx.VACC_COLUMNS, rows[5:9])
    assert jobs.ingest_vaccination(spark, f"{workdir}/raw/*.csv", f"{workdir}/pre") == 9
    from starloom.sources import read_layer
    layer = read_layer(spark, f"{workdir}/pre", {"parte": "string"})
    assert [(r.parte, r["count"]) for r in layer.groupBy("parte").count().collect()] == [("07", 9)]


def test_cli_srag_ingest_year_zero_means_all(workdir):
    import json
    import subprocess
    import sys
    sources = fx.write_srag(workdir)
    out = f"{workdir}/cli_srag"
    args = [sys.executable, "-m", "starloom", "srag-ingest", "--out", out, "--year", "0"]
    for y, p in sources.items():
        args += ["--source", f"{y}={p}"]
    r = subprocess.run(args, cwd=fx.__file__.rsplit("/tests/", 1)[0], capture_output=True, text=True, timeout=300)
    assert r.returncode == 0, r.stderr[-2000:]
    assert json.loads(r.stdout.strip().splitlines()[-1]) == {"rows": 7}


def parts(spark, layer):
    return sorted((r.parte, r.arquivo, r["count"]) for r in jobs.read_vaccination_layer(spark, layer).groupBy("parte", "arquivo").count().collect())


def test_a_token_in_two_runs_keeps_both_files(spark, workdir):
    rows = [r for _, r in fx.vaccination_rows()]
    for name, own in (("a", rows[:5]), ("b", rows[5:8])):
        fx.write_csv(f"{workdir}/{name}/vacinacao-07-{name}.csv", fx.VACC_COLUMNS, own)
        jobs.ingest_vaccination(spark, f"{workdir}/{name}/*.csv", f"{workdir}/pre", root=f"{workdir}/{name}")
    assert parts(spark, f"{workdir}/pre") == [("07", "vacinacao-07-a.csv", 5), ("07", "vacinacao-07-b.csv", 3)]
    fx.write_csv(f"{workdir}/again/vacinacao-07-b.csv", fx.VACC_COLUMNS, rows[5:9])
    jobs.ingest_vaccination(spark, f"{workdir}/again/*.csv", f"{workdir}/pre", root=f"{workdir}/again")  # a file replaces itself alone
    assert parts(spark, f"{workdir}/pre") == [("07", "vacinacao-07-a.csv", 5), ("07", "vacinacao-07-b.csv", 4)]


def test_one_file_name_in_two_folders_is_two_files(spark, workdir):
    rows = [r for _, r in fx.vaccination_rows()]
    for name, own in (("jan", rows[:5]), ("feb", rows[5:8])):
        fx.write_csv(f"{workdir}/raw/{name}/vacinacao-01.csv", fx.VACC_COLUMNS, own)
        jobs.ingest_vaccination(spark, f"{workdir}/raw/{name}/*.csv", f"{workdir}/pre", part_token=r"-([0-9]+)")
    below = workdir.lstrip("/")
    assert parts(spark, f"{workdir}/pre") == [("01", f"{below}/raw/feb/vacinacao-01.csv", 3), ("01", f"{below}/raw/jan/vacinacao-01.csv", 5)]
    jobs.ingest_vaccination(spark, f"{workdir}/raw/*/*.csv", f"{workdir}/other", part_token=r"-([0-9]+)", root=f"{workdir}/raw")
    assert parts(spark, f"{workdir}/other") == [("01", "feb/vacinacao-01.csv", 3), ("01", "jan/vacinacao-01.csv", 5)]


def test_a_file_name_without_token_fails_the_ingest(spark, workdir):
    fx.write_csv(f"{workdir}/raw/vacinacao.csv", fx.VACC_COLUMNS, [r for _, r in fx.vaccination_rows()][:5])
    with pytest.raises(Exception, match="vacinacao.csv"):
        jobs.ingest_vaccination(spark, f"{workdir}/raw/*.csv", f"{workdir}/pre")


def test_files_with_columns_in_another_order(spark, workdir):
    rows = [r for _, r in fx.vaccination_rows()]
    fx.write_csv(f"{workdir}/raw/vacinacao-01-a.csv", fx.VACC_COLUMNS, rows[:5])
    fx.write_csv(f"{workdir}/raw/vacinacao-02-b.csv", list(reversed(fx.VACC_COLUMNS)), rows[5:9])
    assert jobs.ingest_vaccination(spark, f"{workdir}/raw/*.csv", f"{workdir}/pre") == 9
    fx.write_csv(f"{workdir}/same/vacinacao-01-a.csv", fx.VACC_COLUMNS, rows[:9])
    jobs.ingest_vaccination(spark, f"{workdir}/same/*.csv", f"{workdir}/one")
    both = [sorted(map(str, jobs.read_vaccination_layer(spark, f"{workdir}/{x}").select("document_id", *star.VACCINATION_KEYS).collect())) for x in ("pre", "one")]
    assert both[0] == both[1]


def test_scope_of_another_state_reaches_facts_and_dimensions(spark, workdir):
    rows = [{**r, "paciente_endereco_uf": "BA" if r["paciente_endereco_uf"] == "SE" else r["paciente_endereco_uf"],
             "estabelecimento_uf": "BA" if r["estabelecimento_uf"] == "SE" else r["estabelecimento_uf"]} for _, r in fx.vaccination_rows()]
    fx.write_csv(f"{workdir}/raw/vacinacao-01-a.csv", fx.VACC_COLUMNS, rows)
    loc = fx.write_localities(workdir)
    text = open(loc, encoding="utf-8").read().replace("SERGIPE", "BAHIA")
    with open(f"{workdir}/other.csv", "w", encoding="utf-8") as f:
        f.write(text)
    jobs.ingest_vaccination(spark, f"{workdir}/raw/*.csv", f"{workdir}/pre")
    scope = star.Scope("BA", "BAHIA")
    p = jobs.build_vaccination_tables(spark, f"{workdir}/pre", f"{workdir}/other.csv", f"{workdir}/out", scope)
    assert spark.read.parquet(p["fato_vacinas"]).count() == 4
    assert spark.read.parquet(p["dm_regiao_estab"]).count() == spark.read.parquet(p["dm_regiao_paciente"]).count() == 1
    p = jobs.build_vaccination_tables(spark, f"{workdir}/pre", f"{workdir}/other.csv", f"{workdir}/default")
    assert spark.read.parquet(p["fato_vacinas"]).count() == spark.read.parquet(p["dm_regiao_estab"]).count() == 0


def test_an_unknown_year_is_an_error(spark, workdir):
    sources = fx.write_srag(workdir)
    with pytest.raises(ValueError, match=r"no source for the years \[1999\]"):
        jobs.ingest_srag(spark, sources, f"{workdir}/pre", years=[1999])


def test_srag_replaces_a_present_column(spark, workdir):
    """A year's column can be overwritten by the fill value though the file has it."""
    sources = fx.write_srag(workdir)
    jobs.ingest_srag(spark, sources, f"{workdir}/pre", years=[2021], fill="0", replace={2021: ["DOSE_1_COV"]})
    assert {r.cod_doses for r in spark.read.parquet(f"{workdir}/pre").collect()} == {1}

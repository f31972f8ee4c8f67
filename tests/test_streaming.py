"""Incremental ingest: each run conforms only files not seen before."""

import pytest

import fixtures as fx
from starloom.plans import star
from starloom.streaming.ingest import ingest_new_files


def test_incremental_ingest_processes_new_files_once(spark, workdir):
    rows = fx.vaccination_rows()
    src, out, ckpt = f"{workdir}/src", f"{workdir}/pre", f"{workdir}/ckpt"
    fx.write_csv(f"{src}/vacinacao-01-2021.csv", fx.VACC_COLUMNS, [r for p, r in rows if p == "01"])
    ingest_new_files(spark, src, fx.VACC_COLUMNS, star.conform_vaccination, out, checkpoint=ckpt)
    assert spark.read.parquet(out).count() == 11

    # a re-run with nothing new adds nothing
    ingest_new_files(spark, src, fx.VACC_COLUMNS, star.conform_vaccination, out, checkpoint=ckpt)
    assert spark.read.parquet(out).count() == 11

    fx.write_csv(f"{src}/vacinacao-02-2021.csv", fx.VACC_COLUMNS, [r for p, r in rows if p == "02"])
    ingest_new_files(spark, src, fx.VACC_COLUMNS, star.conform_vaccination, out, checkpoint=ckpt)
    layer = spark.read.parquet(out)
    assert layer.count() == 14
    assert {r.parte for r in layer.select("parte").distinct().collect()} == {1, 2}
    assert layer.filter("cod_sexo = 'N'").count() == 1


def test_default_checkpoint_is_the_same_for_every_session(spark, workdir):
    """Two sessions with folders of their own: the second adds the new file."""
    rows = fx.vaccination_rows()
    src, out = f"{workdir}/src", f"{workdir}/pre"
    for n, (token, total) in enumerate((("01", 11), ("02", 14))):
        session = spark.newSession()
        session.sparkContext.setCheckpointDir(f"{workdir}/own-{n}")
        fx.write_csv(f"{src}/vacinacao-{token}-2021.csv", fx.VACC_COLUMNS, [r for p, r in rows if p == token])
        ingest_new_files(session, src, fx.VACC_COLUMNS, star.conform_vaccination, out)
        assert session.read.parquet(out).count() == total


def test_output_without_its_checkpoint_is_refused(spark, workdir):
    rows = fx.vaccination_rows()
    src, out = f"{workdir}/src", f"{workdir}/pre"
    fx.write_csv(f"{src}/vacinacao-01-2021.csv", fx.VACC_COLUMNS, [r for p, r in rows if p == "01"])
    ingest_new_files(spark, src, fx.VACC_COLUMNS, star.conform_vaccination, out, checkpoint=f"{workdir}/first")
    with pytest.raises(ValueError, match="checkpoint is not at"):
        ingest_new_files(spark, src, fx.VACC_COLUMNS, star.conform_vaccination, out)

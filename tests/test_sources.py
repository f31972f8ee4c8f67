"""Scans and sinks: CSV variants, part tokens, partitioned layers, counted writes."""

import os

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from starloom.sources import (
    read_by_header,
    read_delimited,
    read_layer,
    read_positional,
    write_counted,
    write_parquet,
)


def test_glob_scan_rejects_column_order_drift(spark, workdir):
    rows = [dict(zip(fx.NOTIF_COLUMNS, map(str, range(13))))]
    fx.write_csv(f"{workdir}/n/a.csv", fx.NOTIF_COLUMNS, rows)
    fx.write_csv(f"{workdir}/n/b.csv", list(reversed(fx.NOTIF_COLUMNS)), rows)
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_delimited(spark, f"{workdir}/n/*.csv", fx.NOTIF_COLUMNS).collect()


def test_glob_scan_same_layout_reads_all_files(spark, workdir):
    rows = [dict(zip(fx.NOTIF_COLUMNS, map(str, range(13))))]
    for name in ("a", "b", "c"):
        fx.write_csv(f"{workdir}/n/{name}.csv", fx.NOTIF_COLUMNS, rows)
    assert read_delimited(spark, f"{workdir}/n/*.csv").count() == 3


def test_part_token_from_file_name(spark, workdir):
    raw = fx.write_vaccination(workdir)
    df = read_delimited(spark, raw, part_token=r"^[^-]*-([^-]+)")
    got = {r.parte: r["count"] for r in df.groupBy("parte").count().collect()}
    assert got == {"01": 11, "02": 3}


def test_positional_scan_drops_preamble_by_predicate(spark, workdir):
    path = fx.write_census(workdir)
    raw = read_positional(spark, path, ["Situacao_domicilio", "Sexo", "Cor_raca", "Cod", "Municipio", "Idade", "Qtd"])
    assert raw.count() == 3 + 1 + 12 + 2  # preamble, header, rows, notes
    kept = raw.filter(F.trim("Idade").like("%ano%"))
    assert kept.count() == 11


def test_partitioned_overwrite_is_dynamic_and_keeps_zeros(spark, workdir):
    out = f"{workdir}/layer"
    df = spark.createDataFrame([(1, "00001"), (2, "00002"), (3, "00002")], "k int, parte string")
    write_parquet(df, out, partition_by=["parte"])
    write_parquet(spark.createDataFrame([(9, "00002")], "k int, parte string"), out, partition_by=["parte"])
    layer = read_layer(spark, out, {"parte": "string"})
    assert sorted(tuple(r) for r in layer.collect()) == [(1, "00001"), (9, "00002")]
    plan = layer.filter(F.col("parte") == "00001")
    assert [tuple(r) for r in plan.collect()] == [(1, "00001")]


def test_full_refresh_and_file_cap(spark, workdir):
    out = f"{workdir}/t"
    df = spark.range(0, 1000).repartition(16)
    write_parquet(df, out, max_files=3)
    files = [f for f in os.listdir(out) if f.endswith(".parquet")]
    assert 1 <= len(files) <= 3
    write_parquet(spark.range(0, 10), out)
    assert spark.read.parquet(out).count() == 10
    single = f"{workdir}/one"
    write_parquet(spark.range(0, 10, 1, 1), single, max_files=50)   # the cap never raises the count
    assert len([f for f in os.listdir(single) if f.endswith(".parquet")]) == 1


def test_write_counted_observes_rows(spark, workdir):
    df = spark.range(0, 12345).filter(F.col("id") % 2 == 0)
    assert write_counted(df, f"{workdir}/c") == 6173
    assert spark.read.parquet(f"{workdir}/c").count() == 6173


def test_named_columns_must_match_each_files_header(spark, workdir):
    fx.write_csv(f"{workdir}/h/a.csv", ["idade", "sexo"], [{"idade": "30", "sexo": "F"}])
    assert read_delimited(spark, f"{workdir}/h/*.csv", ["idade", "sexo"]).count() == 1
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_delimited(spark, f"{workdir}/h/*.csv", ["idade", "raca"]).collect()


def test_files_of_other_headers_are_united_by_name(spark, workdir):
    rows = [{"idade": "30", "sexo": "F"}]
    fx.write_csv(f"{workdir}/d/a-01-x.csv", ["idade", "sexo"], rows)
    fx.write_csv(f"{workdir}/d/b-02-x.csv", ["sexo", "idade"], rows)
    fx.write_csv(f"{workdir}/d/c-03-x.csv", ["raca", "sexo", "idade"], [{**rows[0], "raca": "1"}])
    df = read_by_header(spark, f"{workdir}/d/*.csv", part_token=r"^[^-]*-([^-]+)", file_column="arquivo")
    assert sorted((tuple(r) for r in df.select("idade", "sexo", "raca", "parte", "arquivo").collect()), key=lambda r: r[3]) == [
        ("30", "F", None, "01", "a-01-x.csv"), ("30", "F", None, "02", "b-02-x.csv"), ("30", "F", "1", "03", "c-03-x.csv")]
    assert read_by_header(spark, f"{workdir}/d/*.csv", ["sexo"]).columns == ["sexo"]


def test_a_name_without_part_token_fails_the_read(spark, workdir):
    fx.write_csv(f"{workdir}/t/vacinacao.csv", ["idade"], [{"idade": "30"}])
    with pytest.raises(Exception, match="no part token in the file name vacinacao.csv"):
        read_delimited(spark, f"{workdir}/t/*.csv", part_token=r"^[^-]*-([^-]+)").collect()


def test_sort_within_orders_each_file(spark, workdir):
    import pyarrow.parquet as pq

    df = spark.range(100, numPartitions=1).selectExpr("id", "cast(id * 37 % 5 as string) as uf", "cast(id % 2 as string) as parte")
    write_parquet(df, f"{workdir}/sorted", partition_by=["parte"], sort_within=["uf"])
    files = [os.path.join(d, f) for d, _, names in os.walk(f"{workdir}/sorted") for f in names if f.endswith(".parquet")]
    assert len(files) == 2
    for f in files:
        uf = pq.ParquetFile(f).read().column("uf").to_pylist()
        assert uf == sorted(uf) and len(uf) == 50


def test_only_scratch_tables_are_dropped(spark, workdir):
    from starloom.sources import drop_scratch, path_exists, scratch_path

    path = scratch_path(spark, "test")
    spark.range(3).write.parquet(path)
    assert path_exists(spark, path)
    drop_scratch(spark, path)
    assert not path_exists(spark, path)
    for other in (workdir, f"{path}/part", f"{path}/../x"):
        with pytest.raises(ValueError, match="not a scratch table"):
            drop_scratch(spark, other)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from starloom.sources import shared_root

    class Cluster:
        class conf:  # noqa: N801
            @staticmethod
            def get(key, default):
                return None

        class sparkContext:  # noqa: N801
            master = "spark://somewhere:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Cluster())

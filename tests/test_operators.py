"""DataFrame operators: sentinels, alignment, facts, dims, lookups, spines."""

from conftest import plan_text
from pyspark.sql import functions as F

from starloom.operators import (
    DimSpec,
    FactSpec,
    Measure,
    align_columns,
    build_dim,
    build_fact,
    cast_columns,
    collapse_lookup,
    day_spine,
    day_spine_over,
    fill_sentinels,
    int_spine,
    lookup_dim,
    union_aligned,
)


def test_fill_sentinels_keeps_column_types(spark):
    df = spark.createDataFrame([(None, None), ("a", 5)], "s string, i int")
    out = fill_sentinels(df, {"s": 0, "i": 999})
    assert dict(out.dtypes) == {"s": "string", "i": "int"}
    assert [tuple(r) for r in out.collect()] == [("0", 999), ("a", 5)]


def test_cast_columns(spark):
    df = spark.createDataFrame([(" 12 ", "1,5", "2021-01-02"), ("x", "y", "2021-02-31")], "a string, b string, c string")
    out = cast_columns(df.withColumn("b", F.regexp_replace("b", ",", ".")), {"a": "int", "b": "float", "c": "date"})
    rows = out.collect()
    assert rows[0].a == 12 and rows[0].b == 1.5 and str(rows[0].c) == "2021-01-02"
    assert rows[1].a is None and rows[1].b is None and rows[1].c is None


def test_align_and_union(spark):
    a = spark.createDataFrame([("1", "x")], "A string, B string")
    b = spark.createDataFrame([("2",)], "a string")
    out = union_aligned([a, b], ["A", "B", "C"])
    assert out.columns == ["A", "B", "C"]
    assert sorted([tuple(r) for r in out.collect()]) == [("1", "x", None), ("2", None, None)]
    filled = align_columns(b, ["a", "Z"], fill="0")
    assert [tuple(r) for r in filled.collect()] == [("2", "0")]


def test_fact_count_distinct_and_having_shift(spark):
    df = spark.createDataFrame(
        [("k1", 1, "d1"), ("k1", 1, "d1"), ("k1", 1, "d2"), ("k2", 5, "d3"), ("k2", 200, "d4")],
        "k string, age int, doc string")
    spec = FactSpec(keys=("k", "age"), measure=Measure("count_distinct", "n", "doc"),
                    shift={"age": 9}, having=F.col("age").between(10, 110))
    got = sorted(tuple(r) for r in build_fact(df, spec).collect())
    assert got == [("k1", 10, 2), ("k2", 14, 1)]


def test_fact_count_float_and_sum(spark):
    df = spark.createDataFrame([("a", 2), ("a", 3), ("b", None)], "k string, q int")
    cnt = build_fact(df, FactSpec(keys=("k",), measure=Measure("count", "n", cast="float")))
    assert dict(cnt.dtypes)["n"] == "float"
    assert sorted(tuple(r) for r in cnt.collect()) == [("a", 2.0), ("b", 1.0)]
    s = build_fact(df, FactSpec(keys=("k",), measure=Measure("sum", "t", "q"), where=F.col("q").isNotNull()))
    assert [tuple(r) for r in s.collect()] == [("a", 5)]


def test_fact_sum_equals_filtered_rows(spark):
    """Property: the total of a count fact equals the rows passing its filter."""
    df = spark.range(0, 5000).select((F.col("id") % 7).alias("k"), (F.col("id") % 13).alias("g"))
    spec = FactSpec(keys=("k", "g"), measure=Measure("count", "n"), where=F.col("g") < 9)
    fact = build_fact(df, spec)
    assert fact.agg(F.sum("n")).first()[0] == df.filter(F.col("g") < 9).count()
    assert fact.count() == fact.select("k", "g").distinct().count()


def test_dim_defaults_not_null_having(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (None, "y"), (3, "z")], "c int, d string")
    spec = DimSpec(columns={"c": "c", "d": F.upper("d")}, defaults={"d": "SEM INFORMACAO"},
                   not_null=("c",), having=F.col("c") < 3)
    assert sorted(tuple(r) for r in build_dim(df, spec).collect()) == [(1, "SEM INFORMACAO"), (2, "X")]


def test_lookup_dim_dedups_before_join(spark):
    rows = spark.createDataFrame([(10, "SE"), (10, "SE"), (0, "-"), (20, "BA"), (30, "SE")], "k int, uf string")
    lk = collapse_lookup(
        spark.createDataFrame([(10, "A", "S", 1.0), (10, "A", "S", 2.0), (20, "B", "S", 3.0), (0, "Z", "S", 0.0)],
                              "cod int, nome string, uf string, lat double"),
        ["cod", "nome", "uf"], ["lat"])
    zero = F.col("k") == 0
    out = lookup_dim(rows, "k", lk, "cod",
                     {"k": F.col("k"), "nome": F.when(zero, "-").otherwise(F.col("nome")), "lat": F.col("lat")},
                     where=F.col("uf").isin("SE", "-"))
    assert sorted(tuple(r) for r in out.collect()) == [(0, "-", 0.0), (10, "A", 2.0)]


def test_spines(spark):
    days = day_spine(spark, "2021-01-01", "2023-02-01")
    assert days.count() == 762
    assert int_spine(spark, 10, 110, "a").count() == 101
    src = spark.createDataFrame([("2021-01-05 10:00:00",), ("2021-01-01 00:00:00",)], "t string").select(
        F.col("t").cast("timestamp").alias("t"))
    assert day_spine_over(src, "t").count() == 5


def test_align_replaces_a_present_column_on_request(spark):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    assert [tuple(r) for r in align_columns(df, ["X", "y", "z"], "0", replace=["Y"]).collect()] == [("a", "0", "0")]
    assert [tuple(r) for r in align_columns(df, ["x", "y", "z"]).collect()] == [("a", "b", None)]


def test_union_of_no_frames_is_an_error():
    import pytest

    with pytest.raises(ValueError, match="no frames"):
        union_aligned([], ["x"])


def test_lookup_dim_plans_the_join_by_size_without_a_job(spark):
    rows = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    lookup = spark.range(0, 500).select(F.col("id").cast("int").alias("cod"), (F.col("id") * 2).alias("v"))
    out = lookup_dim(rows, "k", lookup, "cod", {"k": F.col("k"), "v": F.col("v")})
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2), (2, 4)]
    text = plan_text(out)
    assert "BroadcastHashJoin" in text and "strategy=broadcast" not in text

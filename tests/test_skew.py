"""One key holding a third of all rows: results equal a brute-force reading,
and every shuffle that scales with the input sits behind a partial aggregate
(or a per-task DISTINCT), so the hot key never lands whole in one task."""

import pandas as pd
from conftest import plan_text
from pyspark.sql import functions as F

from starloom.operators import DimSpec, FactSpec, Measure, build_dim, build_fact, collapse_lookup, lookup_dim

N = 120_000


def skewed(spark):
    # key 0 holds a third of the rows; documents repeat inside the hot key
    ids = spark.range(0, N)
    return ids.select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise((F.col("id") % 997) + 1).cast("int").alias("k"),
        (F.col("id") % 5).cast("int").alias("g"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 1000).otherwise(F.col("id")).alias("doc"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("d"), (F.col("id") % 11).cast("string")))
        .alias("desc"),
    )


def test_count_distinct_fact_under_skew(spark):
    df = skewed(spark)
    fact = build_fact(df, FactSpec(keys=("k", "g"), measure=Measure("count_distinct", "n", "doc")))
    got = fact.toPandas().sort_values(["k", "g"]).reset_index(drop=True)
    pdf = df.toPandas()
    want = (pdf.groupby(["k", "g"])["doc"].nunique().reset_index(name="n")
            .sort_values(["k", "g"]).reset_index(drop=True))
    pd.testing.assert_frame_equal(got, want, check_dtype=False)
    tree = plan_text(fact, "formatted").split("\n\n")[0].splitlines()
    # each Exchange feeds from a (partial) HashAggregate below it
    for i, line in enumerate(tree):
        if "Exchange (" in line and "Broadcast" not in line:
            assert "HashAggregate" in tree[i + 1], tree


def test_distinct_dim_under_skew(spark):
    df = skewed(spark)
    dim = build_dim(df, DimSpec(columns={"k": "k", "desc": F.upper("desc")}, defaults={"desc": "SEM INFORMACAO"}))
    pdf = df.toPandas()
    want = set(zip(pdf["k"], pdf["desc"].str.upper().fillna("SEM INFORMACAO")))
    assert set(map(tuple, dim.collect())) == want


def test_lookup_dim_hot_code_reaches_join_once(spark):
    df = skewed(spark)
    lookup = collapse_lookup(
        spark.range(0, 1000).select(F.col("id").cast("int").alias("cod"), F.concat(F.lit("m"), F.col("id").cast("string"))
                                    .alias("nome"), (F.col("id") * 0.5).alias("lat")), ["cod", "nome"], ["lat"])
    out = lookup_dim(df, "k", lookup, "cod", {"k": F.col("k"), "nome": F.col("nome"), "lat": F.col("lat")})
    assert out.count() == 998          # codes 0..997, every one in the lookup, once each
    assert out.filter("k = 0").count() == 1
    tree = plan_text(out, "formatted").split("\n\n")[0]
    assert "BroadcastHashJoin" in tree


def test_hot_partition_value_is_written_by_many_tasks(spark, workdir):
    import os

    from starloom.sources import write_parquet

    df = spark.range(0, 80_000, numPartitions=8).select(
        "id", F.when(F.col("id") % 10 < 8, F.lit("quente")).otherwise(F.lit("frio")).alias("parte"))
    write_parquet(df, f"{workdir}/layer", partition_by=["parte"])
    hot = [f for f in os.listdir(f"{workdir}/layer/parte=quente") if f.endswith(".parquet")]
    assert len(hot) == 8           # one file per writing task: no shuffle funnels the hot value into one task
    assert spark.read.parquet(f"{workdir}/layer").filter("parte = 'quente'").count() == 64_000

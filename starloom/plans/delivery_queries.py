"""Operator checks of deliveries: the ledger, continued facts, rejected
values and one row a code.

The raw files are line items as vaccination text, in folders that use the
same file names. They come in two deliveries: the second changes one folder's
files (with the columns in another order and spelling), brings a new folder
and takes one away. Every query ends with the whole table's rows in force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import DimSpec, FactSpec, Measure, build_dim, dim_conflicts
from ..sources import drop_scratch, read_delivered, read_ledger, read_rejects, read_replaced, replace_parquet, scratch_path
from . import queries as Q
from . import star
from .continued import continue_fact, continued_fact
from .jobs import deliver_vaccination


_RAW = f".csv.{Q.PACKED}"


def _lay(df: DataFrame, folder: str) -> None:
    """Write ``df`` as packed raw CSV files ``vacinacao-01-<n>.csv.lz4`` in ``folder``."""
    spark, staged = df.sparkSession, scratch_path(df.sparkSession, "delivery_staged")
    Q._write_raw_csv(df, staged, packed=True)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    names = sorted(s.getPath().getName() for s in fs.listStatus(path(staged)) if s.getPath().getName().endswith(_RAW))
    for n, name in enumerate(names):
        fs.rename(path(f"{staged}/{name}"), path(f"{folder}/vacinacao-01-{n:05d}{_RAW}"))
    drop_scratch(spark, staged)


def _two_deliveries(spark: SparkSession, d: str, after: Callable[[str], None] = lambda layer: None) -> str:
    """The layer after both deliveries; ``after`` runs behind each. Raw files
    go as soon as no listing needs them, before ``after`` makes files of its own."""
    text = Q._vaccination_text(spark, d)
    line = F.col("vacina_grupoAtendimento_codigo").cast("int")  # the line's number
    raw, layer = scratch_path(spark, "delivery_raw"), scratch_path(spark, "delivery_layer")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(raw).getFileSystem(spark._jsc.hadoopConfiguration())
    _lay(text.where(line <= 3), f"{raw}/jan")
    _lay(text.where(line.isin(1, 4)), f"{raw}/feb")       # wrong: holds line 1 once more
    _lay(text.where(line <= 2), f"{raw}/jul")             # to be withdrawn
    deliver_vaccination(spark, raw, layer, glob=f"*{_RAW}")
    for folder in ("feb", "jul"):
        fs.delete(path(f"{raw}/{folder}"), True)
    after(layer)
    other = text.where(line.isin(4, 5))
    _lay(other.select(*[F.col(c).alias(c.upper()) for c in reversed(other.columns)]), f"{raw}/feb")
    _lay(text.where(line > 5), f"{raw}/mar")
    deliver_vaccination(spark, raw, layer, drop_withdrawn=True, glob=f"*{_RAW}")
    drop_scratch(spark, raw)
    after(layer)
    return layer


def ingest_delivery(spark, d):
    """Two deliveries by the ledger (S5, K2): equal file names in several
    folders, changed, new and withdrawn files; the rows in force."""
    return read_delivered(spark, _two_deliveries(spark, d)).select(*Q.STREAM_COLUMNS)


def _folder(arquivo: str = "arquivo"):
    return F.element_at(F.split(arquivo, "/"), 1)


def delivery_ledger(spark, d):
    """What the ledger holds after both deliveries: rows by folder and token."""
    ledger = read_ledger(spark, _two_deliveries(spark, d))
    return ledger.groupBy(_folder().alias("pasta"), "parte").agg(F.sum("linhas").alias("linhas"))


def rejects_account(spark, d):
    """Texts that could not be read (X11, X17, C11), by folder and column,
    observed and accounted for while the layer is written."""
    rejects = read_rejects(spark, _two_deliveries(spark, d))
    return rejects.groupBy(_folder().alias("pasta"), "coluna").agg(F.sum("valores").alias("valores"), F.min("exemplo").alias("exemplo"))


def _count_spec() -> FactSpec:
    return FactSpec(keys=("cod_idade", "cod_municipio_paciente", "cod_sexo", "data"), measure=Measure("count", "qtd_linhas", cast="float"),
                    where=F.col("cod_sexo").isin("F", "M"))


def _sum_spec() -> FactSpec:
    return FactSpec(keys=("cod_sexo", "cod_municipio_estab", "cod_raca"), measure=Measure("sum", "soma_idade", "cod_idade"),
                    shift={"cod_raca": 9}, having=F.col("cod_raca").between(10, 110))


def _distinct_spec() -> FactSpec:
    return FactSpec(keys=("cod_municipio_estab", "cod_sexo"), measure=Measure("count_distinct", "qtd_documentos", "document_id"),
                    where=F.col("paciente_endereco_uf") == "SE")


def _continued(spec: FactSpec, distinct: str = "bitmaps"):
    def run(spark, d):
        state = scratch_path(spark, "continued_state")
        layer = _two_deliveries(spark, d, lambda layer: continue_fact(spark, layer, state, spec, distinct))
        drop_scratch(spark, layer)  # the fact is merged from the state alone
        return continued_fact(spark, state, spec, distinct)
    return run


def fact_count_continued(spark, d):
    """Row counts continued over two deliveries, one of them changed (A2)."""
    return _continued(_count_spec())(spark, d)


def fact_sum_continued(spark, d):
    """Sums with a shifted key continued over two deliveries (A3)."""
    return _continued(_sum_spec())(spark, d)


def fact_distinct_continued(spark, d):
    """Distinct counts continued from stored bitmaps (A1)."""
    return _continued(_distinct_spec())(spark, d)


def star_vaccination_continued(spark, d):
    """The vaccination fact continued from stored distinct documents."""
    return _continued(star.vaccination_fact_spec(), "pairs")(spark, d)


_NAMED = DimSpec(
    columns={"cod_estabelecimento": "cod_estabelecimento", "razao_social": "estabelecimento_razaoSocial", "nome_fantasia": "estalecimento_noFantasia"},
    defaults={"razao_social": star.V.NO_INFO, "nome_fantasia": star.V.NO_INFO}, not_null=("cod_estabelecimento",), unique_by=("cod_estabelecimento",))


def dim_one_name(spark, d):
    """Establishments, one row a code: of several names that of most rows."""
    return build_dim(star.conform_vaccination(Q._vaccination_text(spark, d)), _NAMED)


def dim_name_conflicts(spark, d):
    """The audit beside it: codes with several names, and how many rows."""
    return dim_conflicts(star.conform_vaccination(Q._vaccination_text(spark, d)), _NAMED)


def dim_geo_one_name(spark, d):
    """Municipality lookup with one row a code where localities give several
    names (J1, J2): the name of most, coordinates over all."""
    loc = Q._supplier_localities(spark, d)
    other = loc.withColumns({"NM_MUNICIPIO": F.concat(F.lit("Antigo "), "NM_MUNICIPIO"), "LAT": F.lit("99,5")})
    even = F.substring("CD_GEOCODDS", 6, 1).cast("int") % 2 == 0
    every = loc.unionByName(loc.where(even)).unionByName(other)
    return star.localities_lookup(every, "AMERICA", one_name=True)


def replaced_roundtrip(spark, d):
    """A partitioned table replaced atomically twice (K1, K3), then read."""
    base = scratch_path(spark, "replaced")
    o = Q.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").cast("string").alias("ano"))
    replace_parquet(o.where("o_orderstatus <> 'F'"), base, partition_by=["ano"])
    replace_parquet(o, base, partition_by=["ano"], max_files=4)
    return read_replaced(spark, base).withColumn("ano", F.col("ano").cast("string"))


DELIVERY_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    ingest_delivery, delivery_ledger, rejects_account, fact_count_continued, fact_sum_continued, fact_distinct_continued,
    star_vaccination_continued, dim_one_name, dim_name_conflicts, dim_geo_one_name, replaced_roundtrip)}

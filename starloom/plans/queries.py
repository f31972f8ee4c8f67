"""Operator checks on the driver's tables.

Each query maps a TPC-H-style table onto the shape of one conformance or
star-schema operator and runs the library code on the *whole* table, so its
work grows with the data. Dirty values (NULLs, padding, bad text) are made
inside the query from ordinary column values, never by sampling rows.
Every function takes ``(spark, sf_dir)`` and returns a lazy DataFrame; the
round-trip queries first write an intermediate table to the shared scratch
folder and return the scan of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as X
from ..operators import (
    DimSpec,
    FactSpec,
    Measure,
    align_columns,
    build_dim,
    build_fact,
    day_spine_over,
    fill_sentinels,
    union_aligned,
)
from ..sources import (
    drop_scratch,
    read_by_header,
    read_delimited,
    read_layer,
    read_positional,
    scratch_path,
    write_counted,
    write_parquet,
)
from ..streaming.ingest import ingest_new_files
from .jobs import build_vaccination_tables, ingest_srag, ingest_vaccination, read_vaccination_layer
from . import star
from . import vocab as V


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts(day: str) -> Column:
    # Literal for comparisons with timestamp_ntz columns, so the predicate
    # stays on the stored column and reaches the Parquet scan.
    return F.lit(f"{day} 00:00:00").cast("timestamp_ntz")


def _digit(c: str) -> Column:
    return F.substring(F.col(c), 1, 1)


# ---------------------------------------------------------------- facts ----

def fact_count_distinct(spark, d):
    """Distinct customers per status, priority and day (vaccination-fact shape)."""
    orders = table(spark, d, "orders").withColumn("data_pedido", F.to_date("o_orderdate"))
    spec = FactSpec(
        keys=("o_orderstatus", "o_orderpriority", "data_pedido"),
        measure=Measure("count_distinct", "qtd_clientes", "o_custkey"),
        where=(F.col("o_orderstatus").isin("F", "O") & F.col("o_totalprice").between(1000, 110000)
               & (F.col("o_orderpriority") != "5-LOW") & (F.col("o_orderdate") >= _ts("1996-01-19"))),
        rename={"data_pedido": "data"},
    )
    return build_fact(orders, spec)


def fact_count(spark, d):
    """Row count per user ("age"), event type and day, stored as float."""
    events = table(spark, d, "events").withColumns(
        {"cod_idade": F.col("user_id").cast("int"), "data": F.to_date("ts")})
    spec = FactSpec(
        keys=("cod_idade", "event_type", "data"),
        measure=Measure("count", "qtd_eventos", cast="float"),
        where=F.col("event_type").isin("click", "view") & F.col("user_id").between(10, 110),
    )
    return build_fact(events, spec)


def fact_sum_shifted(spark, d):
    """Sum per recoded flag, supplier and quantity; the quantity key is
    emitted shifted by 9 and filtered after the aggregate."""
    li = table(spark, d, "lineitem").withColumns({
        "cod_sexo": X.recode("l_returnflag", {"A": "F", "R": "M"}, default="N"),
        "cod_municipio": F.col("l_suppkey"),
        "cod_idade": F.col("l_quantity").cast("int"),
    })
    spec = FactSpec(
        keys=("cod_sexo", "cod_municipio", "cod_idade"),
        measure=Measure("sum", "qtd_populacao", "l_linenumber"),
        shift={"cod_idade": 9},
        having=F.col("cod_idade").between(10, 50) & F.col("cod_sexo").isin("F", "M"),
    )
    return build_fact(li, spec)


# --------------------------------------------------------------- lookups ---

def _localities_text(spark, d, code: Column, municipality: str) -> DataFrame:
    """Supplier rows written as a localities extract: padded 7-digit code,
    municipality and state names, coordinates with a decimal comma."""
    nation = table(spark, d, "nation")
    region = table(spark, d, "region")
    sup = table(spark, d, "supplier")
    comma = lambda c: F.regexp_replace(F.format_string("%.2f", c), r"\.", ",")
    return (sup.join(nation, sup.s_nationkey == nation.n_nationkey)
            .join(region, nation.n_regionkey == region.r_regionkey)
            .select(F.concat(code, F.lit("1")).alias("CD_GEOCODDS"),
                    F.col(municipality).alias("NM_MUNICIPIO"),
                    F.concat(F.lit(" "), F.col("r_name")).alias("NM_UF"),
                    comma(F.col("s_acctbal")).alias("LAT"),
                    comma(-F.col("s_acctbal")).alias("LONG")))


def _nation_localities(spark, d) -> DataFrame:
    """Suppliers as localities of their nation (several to a municipality)."""
    return _localities_text(spark, d, F.lpad(F.col("s_nationkey").cast("string"), 6, "0"), "n_name")


def _supplier_localities(spark, d) -> DataFrame:
    """Suppliers as municipalities: code 280000 + key."""
    return _localities_text(spark, d, (F.col("s_suppkey") + 280000).cast("string"), "s_name")


def lookup_max_coords(spark, d):
    """Localities collapsed to one row per municipality (max coordinates)."""
    return star.localities_lookup(_nation_localities(spark, d), state_name=None)


def _customer_rows(spark, d) -> DataFrame:
    seg = F.col("c_mktsegment")
    uf = (F.when(seg.isin("BUILDING", "AUTOMOBILE"), F.lit(V.STATE_CODE))
          .when(seg == "MACHINERY", F.lit(V.NO_STATE)).otherwise(seg))
    return table(spark, d, "customer").select(
        F.col("c_nationkey").alias("cod_municipio_estab"),
        F.col("c_nationkey").alias("cod_municipio_paciente"),
        uf.alias("estabelecimento_uf"),
        F.when(seg == "HOUSEHOLD", F.lit(V.NO_STATE)).otherwise(F.lit(V.STATE_CODE)).alias("paciente_endereco_uf"),
    )


def dim_geo_join(spark, d):
    """Establishment region dimension: distinct codes joined to the lookup."""
    lookup = star.localities_lookup(_nation_localities(spark, d), state_name="AFRICA")
    return star.establishment_region_dim(_customer_rows(spark, d), lookup)


def dim_geo_join_country(spark, d):
    """Patient region dimension (adds the country column)."""
    lookup = star.localities_lookup(_nation_localities(spark, d), state_name="AFRICA")
    return star.patient_region_dim(_customer_rows(spark, d), lookup)


# ------------------------------------------------------------------ dims ---

def dim_distinct(spark, d):
    """Code/description dimension with a default for missing descriptions."""
    part = table(spark, d, "part").withColumn(
        "tipo", F.when(F.col("p_size") <= 45, F.col("p_type")))
    spec = DimSpec(columns={"cod_marca": "p_brand", "desc_tipo": F.upper("tipo")},
                   defaults={"desc_tipo": V.NO_INFO}, not_null=("p_brand",))
    return build_dim(part, spec)


def dim_label_case(spark, d):
    """The sex dimension spec over status codes recoded to F / M / I."""
    orders = table(spark, d, "orders").withColumn(
        "cod_sexo", X.recode("o_orderstatus", {"F": "F", "O": "M"}, default="I"))
    return build_dim(orders, star.sex_dim_spec())


def dim_calendar(spark, d):
    """Calendar dimension over every day between the first and last order."""
    return star.calendar_dim(day_spine_over(table(spark, d, "orders"), "o_orderdate"))


def epi_week(spark, d):
    """Epidemiological week of every order day."""
    orders = table(spark, d, "orders")
    day = F.to_date("o_orderdate")
    week = X.epi_week(day)
    return orders.select(
        "o_orderkey", day.alias("data"), week.alias("semana_epi"),
        F.concat(F.date_format(day, "yyyy"), X.two_digits(week)).alias("anosemana_epi"))


def dim_age_band(spark, d):
    """Age dimension over the distinct user ids read as ages."""
    return star.age_dim(table(spark, d, "events"), "user_id")


# ------------------------------------------------------------ conformance --

def null_sentinel(spark, d):
    """NULL -> sentinel per column, in the column's own type."""
    o = table(spark, d, "orders")
    df = o.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderstatus")).alias("cod_status"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("cod_cliente"),
        F.when(F.col("o_totalprice") < 300000, F.dayofmonth("o_orderdate")).alias("cod_idade"),
    )
    return fill_sentinels(df, {"cod_status": "0", "cod_cliente": 0, "cod_idade": 999})


def recode_map(spark, d):
    """Race digit swap, letter flag, sex codes, census sex words."""
    o = table(spark, d, "orders")
    status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
    race_text = F.when((status == "F") & (prio == "1-URGENT"), F.lit(None).cast("string")).otherwise(
        F.concat(_digit("o_orderpriority"), F.when(status == "P", F.lit("4")).otherwise(F.lit(""))))
    risk_text = (F.when(prio == "5-LOW", F.lit(None).cast("string"))
                 .when(status == "F", F.lit(" S ")).when(status == "O", F.lit("N")).otherwise(status))
    sex_text = (F.when(prio == "4-NOT SPECIFIED", F.lit(None).cast("string"))
                .when(status == "F", F.lit(" Feminino")).when(status == "O", F.lit("Masculino "))
                .otherwise(F.lit("Ignorado")))
    census_text = (F.when(status == "F", F.lit("MULHERES")).when(status == "O", F.lit("HOMENS"))
                   .otherwise(F.lit("TOTAL")))
    return o.select(
        "o_orderkey",
        X.swapped_race_code(race_text).alias("cod_raca"),
        X.letter_flag(risk_text).alias("cod_risco"),
        X.sex_code(sex_text).alias("cod_sexo"),
        X.recode(census_text, V.CENSUS_SEX, default="N").alias("cod_sexo_censo"),
    )


def first_present_case(spark, d):
    """First present column wins, else 0."""
    o = table(spark, d, "orders")
    status, prio, price = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice")
    pairs = [
        (F.when(status == "F", F.lit("1")), 1),
        (F.when(prio == "1-URGENT", F.lit("x")), 2),
        (F.when(price > 200000, F.lit(" d ")), 1),
        (F.when(prio == "2-HIGH", F.lit("01/02/2021")), 1),
        (F.when(status == "P", F.lit("y")), 2),
    ]
    return o.select("o_orderkey", X.first_present(pairs, 0).alias("cod_doses"))


def code_prefix(spark, d):
    """Six-digit municipality prefix of padded text -> int."""
    c = table(spark, d, "customer")
    text = (F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(V.STATE_CODE))
            .otherwise(F.concat(F.lit("  "), (F.col("c_custkey") + 2800000).cast("string"), F.lit("7 "))))
    return c.select("c_custkey", X.code_prefix(text).alias("cod_municipio"))


def _age_text(size: Column, ptype: Column) -> Column:
    s = size.cast("string")
    return (F.when(size == 1, F.lit("1 ano"))
            .when(ptype == "MEDIUM", F.concat(s, F.lit(" meses")))
            .when(ptype == "PROMO", F.concat(s, F.lit(" anos ou mais")))
            .when(ptype == "STANDARD", F.concat(F.lit("1 ano e "), s, F.lit(" meses")))
            .when(ptype == "LARGE", F.concat(s, F.lit(" a "), (size + 4).cast("string"), F.lit(" anos")))
            .otherwise(F.concat(s, F.lit(" anos"))))


def parse_age_text(spark, d):
    """Census age text -> years and label."""
    p = table(spark, d, "part").withColumn("Idade", _age_text(F.col("p_size"), F.col("p_type")))
    rows = p.filter(F.trim(F.col("Idade")).like("%ano%"))
    age = X.age_from_text("Idade")
    return rows.select("p_partkey", age.alias("cod_idade"), X.age_text_label("Idade", age).alias("desc_idade"))


def decimal_comma(spark, d):
    """Decimal comma repaired, text -> float."""
    p = table(spark, d, "part")
    s = F.col("p_size").cast("string")
    text = (F.when(F.col("p_type") == "SMALL", F.concat(s, F.lit("."), s))
            .when(F.col("p_type") == "LARGE", F.concat(s, F.lit(",5,1")))
            .otherwise(F.concat(F.lit(" -"), s, F.lit(",5"))))
    return p.select("p_partkey", X.decimal_comma(text).alias("valor"))


def hash_key(spark, d):
    """Dose-like dimension: hash of the trimmed text, upper-cased raw text."""
    o = table(spark, d, "orders")
    status = F.col("o_orderstatus")
    text = (F.when(status == "P", F.lit(None).cast("string"))
            .when(status == "O", F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" ")))
            .otherwise(F.lower("o_orderpriority")))
    df = o.withColumn("descricao", text).withColumn(
        "cod_dose", F.coalesce(X.hash_key(X.clean("descricao")), F.lit("0")))
    spec = DimSpec(columns={"cod_dose": "cod_dose", "desc_dose": F.upper("descricao")},
                   not_null=("descricao",))
    return build_dim(df, spec)


def array_split_max(spark, d):
    """Lexicographic largest element of a comma list."""
    e = table(spark, d, "events")
    u, h = F.col("user_id").cast("string"), F.hour("ts").cast("string")
    text = (F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
            .when(F.col("event_type") == "view", F.concat(F.lit(" "), u, F.lit(", "), h, F.lit(" ")))
            .otherwise(F.concat(u, F.lit(","), h)))
    return e.select("event_id", F.coalesce(X.split_max(text), F.lit("0")).alias("cod_doses"))


def scalar_string(spark, d):
    """trim, ltrim/rtrim, upper, substring."""
    o = table(spark, d, "orders")
    padded = F.concat(F.lit("  "), F.lower("o_orderpriority"), F.lit(" "))
    return o.select(
        "o_orderkey",
        F.trim(padded).alias("aparado"),
        F.rtrim(F.ltrim(padded)).alias("aparado_lr"),
        F.upper(F.trim(padded)).alias("maiusculo"),
        F.substring(F.upper(F.trim(padded)), 1, 3).alias("prefixo"),
        X.first_char(padded, upper=True).alias("inicial"),
    )


def scalar_regexp(spark, d):
    """regexp_replace and the 'None' -> 0 code."""
    p = table(spark, d, "part")
    code_text = (F.when(F.col("p_type") == "PROMO", F.lit("None"))
                 .when(F.col("p_type") == "SMALL", F.lit(None).cast("string"))
                 .otherwise(F.concat(F.lit(" "), F.col("p_size").cast("string"))))
    return p.select(
        "p_partkey",
        F.regexp_replace("p_name", "[aeiou]", "").alias("sem_vogais"),
        star.municipality_code(code_text).alias("cod_municipio"),
    )


def scalar_date_parse(spark, d):
    """Dates in dd/MM/yyyy and yyyy-MM-dd, impossible days NULL."""
    e = table(spark, d, "events")
    etype = F.col("event_type")
    day = F.dayofmonth("ts") + F.when(etype == "error", F.lit(10)).otherwise(F.lit(0))
    month = F.when(etype == "signup", F.lit(2)).otherwise(F.month("ts"))
    y = F.year("ts").cast("string")
    dd, mm = X.two_digits(day), X.two_digits(month)
    return e.select(
        "event_id",
        X.to_date(F.concat(dd, F.lit("/"), mm, F.lit("/"), y), "dd/MM/yyyy").alias("dat_notificacao"),
        X.to_date(F.concat(y, F.lit("-"), mm, F.lit("-"), dd)).alias("dat_encerramento"),
    )


def scalar_cast(spark, d):
    """Lenient text -> int: blanks, fractions, words, overflow."""
    o = table(spark, d, "orders")
    status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
    key = F.col("o_custkey").cast("string")
    text = (F.when(prio == "5-LOW", F.concat(key, F.lit("0000000")))
            .when(status == "O", F.concat(F.lit(" "), key, F.lit(" ")))
            .when(status == "P", F.concat(F.lit("n"), key))
            .otherwise(F.concat(key, F.lit("."), F.dayofmonth("o_orderdate").cast("string"))))
    return o.select(
        "o_orderkey",
        X.to_int(text).alias("cod_cliente"),
        X.to_int(_digit("o_orderpriority")).alias("cod_prioridade"),
        X.to_int(status).alias("cod_status"),
    )


# --------------------------------------------------------------- filters ---

def filter_predicates(spark, d):
    """Equality, IN, inclusive BETWEEN and a date lower bound given as text."""
    o = table(spark, d, "orders").withColumn("data", F.to_date("o_orderdate"))
    return o.filter((F.col("o_orderstatus") == "F") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
                    & F.col("o_totalprice").between(1000, 200000) & (F.col("data") >= "1996-01-19")).select(
        "o_orderkey", "o_custkey", "data")


def filter_trim_eq(spark, d):
    """Conjunctive equality on trimmed text (F2)."""
    o = table(spark, d, "orders")
    status = F.concat(F.lit(" "), F.col("o_orderstatus"), F.lit("  "))
    code = F.concat(_digit("o_orderpriority"), F.lit(" "))
    return o.filter((F.trim(status) == "F") & (F.trim(code) == "1")).select(
        "o_orderkey", "o_custkey", "o_totalprice")


def filter_notin_like(spark, d):
    """NOT IN after trim, and LIKE."""
    p = table(spark, d, "part")
    return p.filter(~F.trim(F.col("p_type")).isin("SMALL", "", " ")).filter(
        F.col("p_name").like("%ring%")).select("p_partkey", "p_name", "p_type")


def filter_null_rejecting(spark, d):
    """<> and NOT IN reject NULL rows."""
    o = table(spark, d, "orders").withColumn(
        "status", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderstatus")))
    return o.filter(F.col("status") != "F").filter(~F.col("o_orderpriority").isin("1-URGENT")).select(
        "o_orderkey", "status")


def filter_code_eq(spark, d):
    """Text code compared with an int after the lenient cast."""
    o = table(spark, d, "orders").withColumn("cod_evolucao", F.trim(_digit("o_orderpriority")))
    return o.filter(X.to_int("cod_evolucao") == 2).select("o_orderkey", "cod_evolucao")


# ------------------------------------------------------- column plumbing ---

def project_select(spark, d):
    """select, drop, alias."""
    c = table(spark, d, "customer")
    return (c.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
            .withColumn("desc_cliente", F.trim("c_name")).drop("c_name")
            .select(F.col("c_custkey").alias("cod_cliente"), "desc_cliente", "c_nationkey",
                    F.col("c_mktsegment").alias("segmento")))


def sql_projection(spark, d):
    """SQL text over a DataFrame argument (no global temp view) plus an
    ``expr`` column: the count fact written the way the source jobs wrote
    their SQL, planned by the same Catalyst as the DataFrame form."""
    fact = spark.sql("""
        SELECT CAST(user_id AS INT) AS cod_idade, event_type, CAST(ts AS DATE) AS data,
               CAST(COUNT(*) AS FLOAT) AS qtd_eventos
        FROM {events}
        WHERE event_type IN ('click', 'view') AND user_id BETWEEN 10 AND 110
        GROUP BY 1, 2, 3""", events=table(spark, d, "events"))
    return fact.withColumn("faixa", F.expr("CASE WHEN cod_idade < 60 THEN 'adulto' ELSE 'idoso' END"))


YEAR_COLUMNS = ["o_orderkey", "o_orderstatus", "o_orderpriority", "ano"]


def yearly_align(spark, d):
    """Yearly extracts whose columns drift (years before 1997 lack the
    priority column) aligned to one list and unioned by name."""
    orders = table(spark, d, "orders").withColumn("ano", F.year("o_orderdate").cast("string"))
    early = orders.filter(F.col("o_orderdate") < _ts("1997-01-01")).select("o_orderkey", "o_orderstatus", "ano")
    late = orders.filter(F.col("o_orderdate") >= _ts("1997-01-01")).select(*YEAR_COLUMNS)
    return union_aligned([early, late], YEAR_COLUMNS)


def yearly_fill(spark, d):
    """Alignment with a value for absent columns, which also replaces a
    column that one extract has (P5, X22)."""
    orders = table(spark, d, "orders").withColumn("ano", F.year("o_orderdate").cast("string"))
    early = orders.filter(F.col("o_orderdate") < _ts("1997-01-01")).select("o_orderkey", "o_orderstatus", "ano")
    late = orders.filter(F.col("o_orderdate") >= _ts("1997-01-01")).select(*YEAR_COLUMNS)
    return union_aligned([align_columns(early, YEAR_COLUMNS, "0"),
                          align_columns(late, YEAR_COLUMNS, "0", replace=["o_orderstatus"])], YEAR_COLUMNS)


# -------------------------------------------------------- sources / sinks --

def csv_scan(spark, d):
    """Supplier written as ';' CSV with a header, read back as text, typed."""
    path = scratch_path(spark, "csv_scan")
    table(spark, d, "supplier").write.option("header", True).option("sep", ";").csv(path)
    raw = read_delimited(spark, path, ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    return raw.select(X.to_long("s_suppkey").alias("s_suppkey"), X.clean("s_name").alias("s_name"),
                      X.to_int("s_nationkey").alias("s_nationkey"), X.to_double("s_acctbal").alias("s_acctbal"))


def csv_glob_scan(spark, d):
    """Customers written as several CSV files, read back through one glob."""
    path = scratch_path(spark, "csv_glob")
    (table(spark, d, "customer").repartition(4).write.option("header", True).option("sep", ";")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    raw = read_delimited(spark, f"{path}/*.csv")
    return raw.select(X.to_long("c_custkey").alias("c_custkey"), X.clean("c_name").alias("c_name"),
                      X.to_int("c_nationkey").alias("c_nationkey"), X.to_double("c_acctbal").alias("c_acctbal"),
                      X.clean("c_mktsegment").alias("c_mktsegment"))


def _census_lines(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    flag, qty = F.col("l_returnflag"), F.col("l_quantity").cast("int")
    sexo = F.when(flag == "A", F.lit("Homens")).when(flag == "R", F.lit("Mulheres")).otherwise(F.lit("Total"))
    idade = (F.when(qty == 1, F.lit("1 ano"))
             .when(F.col("l_linenumber") == 7, F.concat(qty.cast("string"), F.lit(" a "), (qty + 4).cast("string"), F.lit(" anos")))
             .when(qty == 50, F.lit("100 anos ou mais"))
             .otherwise(F.concat(qty.cast("string"), F.lit(" anos"))))
    qtd = F.when(F.col("l_linenumber") == 6, F.lit("-")).otherwise(F.col("l_linenumber").cast("string"))
    data = li.select(F.concat_ws(
        ";", F.lit("Urbana"), sexo, F.col("l_linestatus"),
        F.concat((F.col("l_suppkey") + 280000).cast("string"), F.lit("1")),
        F.concat(F.lit("Municipio "), F.col("l_suppkey").cast("string")), idade, qtd).alias("value"))
    notes = spark.createDataFrame(
        [("Tabela 3175 - Populacao residente",), ("Variavel - Populacao residente (Pessoas)",),
         ("Brasil e Municipio",), ("Situacao do domicilio;Sexo;Cor ou raca;Cod.;Municipio;Idade;Total",),
         ("Fonte: IBGE - Censo Demografico",)], "value string")
    return notes.unionByName(data)


def csv_preamble_scan(spark, d):
    """Census-style export (title lines, header, notes) read by position and
    run through the census conform + population fact."""
    path = scratch_path(spark, "csv_preamble")
    _census_lines(spark, d).write.text(path)
    raw = read_positional(spark, path, V.CENSUS_COLUMNS)
    return star.population_fact(star.conform_census(raw))


def csv_part_token(spark, d):
    """Files whose path carries a part token and whose columns come in two
    orders, one with a further column; read by header, the token a column."""
    path = scratch_path(spark, "csv_parts")
    o = table(spark, d, "orders").withColumn(
        "lote", F.concat(F.lit("vacinacao-"), F.col("o_orderstatus"), F.lit("-2021")))
    first = F.col("o_orderstatus") == "F"
    writer = lambda df: df.write.mode("append").option("header", True).option("sep", ";").partitionBy("lote")
    writer(o.filter(first).select("o_orderkey", "o_orderstatus", "lote")).csv(path)
    writer(o.filter(~first).select("o_orderstatus", "o_custkey", "o_orderkey", "lote")).csv(path)
    raw = read_by_header(spark, f"{path}/*/*.csv", ["o_orderkey", "o_orderstatus"],
                         part_token=r"vacinacao-([^-/]+)-", token_source="file_path")
    return raw.select(X.to_long("o_orderkey").alias("o_orderkey"), "o_orderstatus", "parte")


def parquet_roundtrip(spark, d):
    """A fact written with a file cap (full refresh, twice), then read back."""
    path = scratch_path(spark, "parquet_roundtrip")
    fact = fact_count(spark, d)
    write_parquet(fact, path, max_files=4)
    write_parquet(fact, path, max_files=4)
    return spark.read.parquet(path)


def partitioned_roundtrip(spark, d):
    """Orders partitioned by a zero-padded part token with dynamic overwrite;
    one partition is rewritten, then the whole layer is read with the token
    kept as text."""
    path = scratch_path(spark, "partitioned")
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_orderstatus",
        F.lpad(F.month("o_orderdate").cast("string"), 5, "0").alias("parte"))
    write_parquet(o, path, partition_by=["parte"])
    write_parquet(o.filter(F.col("parte") == "00002"), path, partition_by=["parte"])
    return read_layer(spark, path, {"parte": "string"})


def write_counted_rows(spark, d):
    """The row count that a counted write observed, beside the count of what
    it wrote (K5)."""
    path = scratch_path(spark, "counted")
    events = table(spark, d, "events").filter(F.col("event_type").isin("click", "view"))
    seen = write_counted(events, path)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("gravados")).withColumn("contados", F.lit(seen).cast("bigint"))


def row_count(spark, d):
    """Global row count."""
    return table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("registros"))


# ------------------------------------- star schema on raw-layout text ------
# Line items re-written as the raw text of each source layout, then run
# through the real conform projection and fact/dimension specs.

def _s(c: Column) -> Column:
    return c.cast("string")


def _null() -> Column:
    return F.lit(None).cast("string")


def _vaccination_text(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    ln, rf, ls = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus")
    qty = F.col("l_quantity").cast("int")
    muni = _s(F.col("l_suppkey") + 280000)
    applied = _s(F.add_months(F.to_date("l_shipdate"), 300))  # as yyyy-MM-dd, without a formatter
    return li.select(
        _s(F.col("l_orderkey")).alias("document_id"),
        F.when(ln == 7, _null()).when(ls == "O", F.lit(" novo pni ")).otherwise(F.lit("esus ab")).alias("sistema_origem"),
        F.when(ln <= 2, F.lit("1a Dose")).when(ln <= 4, F.lit(" 2a Dose ")).when(ln <= 6, F.lit("Reforco"))
        .alias("vacina_descricao_dose"),
        _s(F.col("l_suppkey")).alias("estabelecimento_valor"),
        _s(ln).alias("vacina_grupoAtendimento_codigo"),
        F.when(ls == "O", F.lit("2")).otherwise(F.lit("x")).alias("vacina_categoria_codigo"),
        _s(F.col("l_partkey")).alias("vacina_codigo"),
        _s(F.col("l_orderkey")).alias("paciente_id"),
        F.when(rf == "N", _null()).otherwise(F.concat(F.lit("0"), _s(ln))).alias("paciente_racaCor_codigo"),
        _s(qty * 3).alias("paciente_idade"),
        F.when(rf == "A", F.lit("F")).when(rf == "R", F.lit("M")).when(ls == "O", F.lit("F")).otherwise(F.lit("I"))
        .alias("paciente_enumSexoBiologico"),
        F.when(ln == 1, F.lit("None")).otherwise(muni).alias("paciente_endereco_coIbgeMunicipio"),
        F.when(ln == 2, _null()).otherwise(muni).alias("estabelecimento_municipio_codigo"),
        F.when((ln == 3) & (ls == "F"), F.lit("xx")).otherwise(applied).alias("vacina_dataAplicacao"),
        F.when(F.col("l_discount") > 0.08, F.lit("BA")).otherwise(F.lit("SE")).alias("paciente_endereco_uf"),
        F.when(F.col("l_tax") > 0.07, F.lit("BA")).when(F.col("l_tax") == 0, F.lit("-")).otherwise(F.lit("SE"))
        .alias("estabelecimento_uf"),
        F.when(ln == 5, F.lit("1950-02-30")).otherwise(F.concat(_s(qty + 1900), F.lit("-01-15")))
        .alias("paciente_dataNascimento"),
        F.when(ln == 4, _null()).otherwise(F.concat(F.lit(" 49"), F.lpad(_s(F.col("l_suppkey")), 3, "0")))
        .alias("paciente_endereco_cep"),
        F.concat(F.lit("Estab "), _s(F.col("l_suppkey"))).alias("estabelecimento_razaoSocial"),
        F.when(ls == "O", _null()).otherwise(F.concat(F.lit("Fantasia "), _s(F.col("l_suppkey"))))
        .alias("estalecimento_noFantasia"),
        F.when(ln == 6, _null()).otherwise(F.concat(F.lit("Vacina "), _s(F.col("l_partkey")))).alias("vacina_nome"),
        F.lit("Fab").alias("vacina_fabricante_nome"),
        F.concat(F.lit("Grupo "), _s(ln)).alias("vacina_grupoAtendimento_nome"),
        F.when(ls == "O", F.lit("Cat 2")).alias("vacina_categoria_nome"),
        F.when(rf == "N", _null()).otherwise(F.concat(F.lit("Raca "), _s(ln))).alias("paciente_racaCor_valor"),
    )


def star_vaccination_fact(spark, d):
    """Vaccination fact (13 keys, distinct documents) through the real spec."""
    return build_fact(star.conform_vaccination(_vaccination_text(spark, d)), star.vaccination_fact_spec())


def _star_dim(name: str):
    def query(spark, d):
        conformed = star.conform_vaccination(_vaccination_text(spark, d))
        if name == "dm_sexo":
            return build_dim(conformed, star.sex_dim_spec())
        return build_dim(conformed, star.vaccination_dim_specs()[name])
    query.__name__ = f"star_{name}"
    query.__doc__ = f"Vaccination dimension {name} through the real spec."
    return query


def star_dm_regiao_estab(spark, d):
    """Establishment region dimension through the real spec."""
    lookup = star.localities_lookup(_supplier_localities(spark, d), state_name="AMERICA")
    return star.establishment_region_dim(star.conform_vaccination(_vaccination_text(spark, d)), lookup)


def star_dm_regiao_paciente(spark, d):
    """Patient region dimension through the real spec."""
    lookup = star.localities_lookup(_supplier_localities(spark, d), state_name="AMERICA")
    return star.patient_region_dim(star.conform_vaccination(_vaccination_text(spark, d)), lookup)


_LATE = "1998-01-01"


def _srag_text(li: DataFrame, with_vaccine: bool) -> DataFrame:
    ln, rf, ls = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus")
    muni = _s(F.col("l_suppkey") + 280000)
    day = F.date_format("l_shipdate", "dd/MM/yyyy")
    cols = [
        F.when(ln == 7, F.lit("4")).when(ls == "O", F.lit("5")).otherwise(F.lit(" 5 ")).alias("CLASSI_FIN"),
        F.when(ln == 6, _null()).when(rf == "A", F.lit("1")).otherwise(F.lit("2")).alias("EVOLUCAO"),
        F.when(rf == "N", _null()).when(ls == "O", F.lit("S")).otherwise(F.lit("N")).alias("FATOR_RISC"),
        _s(F.col("l_quantity").cast("int") * 3).alias("NU_IDADE_N"),
        F.lit("SE").alias("SG_UF_NOT"),
        muni.alias("CO_MUN_NOT"),
        F.when(F.col("l_discount") > 0.08, F.lit("BA")).otherwise(F.lit(" SE ")).alias("SG_UF"),
        F.when(ln == 5, _null()).otherwise(muni).alias("CO_MUN_RES"),
        F.when(rf == "N", _null()).otherwise(_s(ln)).alias("CS_RACA"),
        F.when(ln.isin(1, 3, 5), F.lit("F")).when(ln.isin(2, 4, 6), F.lit("M")).otherwise(F.lit("I")).alias("CS_SEXO"),
        F.when(ls == "O", F.lit("1")).otherwise(F.lit("2")).alias("HOSPITAL"),
        F.when(rf == "R", F.lit("1")).alias("UTI"),
        F.when(ln == 4, day).alias("DT_DOSEUNI"),
        F.when(ln == 3, day).alias("DT_1_DOSE"),
        F.when(ln == 2, day).alias("DT_2_DOSE"),
        day.alias("DT_DIGITA"),
        day.alias("DT_NOTIFIC"),
    ]
    if with_vaccine:
        cols += [F.when(F.col("l_tax") == 0, F.lit("1")).otherwise(F.lit("2")).alias("VACINA_COV"),
                 F.when(ln == 1, F.lit("x")).alias("DOSE_1_COV"),
                 F.when(rf == "R", F.lit(" ")).alias("DOSE_2_COV")]
    return li.select(*cols)


def _srag_cases(spark, d) -> DataFrame:
    """Two yearly extracts (the early one lacks the vaccine columns), each
    filtered to the state's COVID-19 cases, aligned and unioned."""
    li = table(spark, d, "lineitem")
    early = _srag_text(li.filter(F.col("l_shipdate") < _ts(_LATE)), with_vaccine=False)
    late = _srag_text(li.filter(F.col("l_shipdate") >= _ts(_LATE)), with_vaccine=True)
    frames = [f.filter(star.srag_case_filter()) for f in (early, late)]
    return union_aligned(frames, V.SRAG_COLUMNS)


def star_srag_conformed(spark, d):
    """All sixteen conformed SRAG columns (race swap, flags, first dose...)."""
    return star.conform_srag(_srag_cases(spark, d)).drop(*V.SRAG_COLUMNS, "cod_evolucao_num")


def star_deaths_fact(spark, d):
    """Deaths fact through the real conform and spec."""
    return build_fact(star.conform_srag(_srag_cases(spark, d)), star.deaths_fact_spec())


def _notification_text(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
    muni = _s(F.col("o_custkey") + 2800000)
    return o.select(
        F.when(status == "F", F.lit(" Confirmado ")).when(status == "O", F.lit("Descartado")).alias("classificacaoFinal"),
        F.when(prio == "1-URGENT", F.lit("Obito")).otherwise(F.lit("Cura")).alias("evolucaoCaso"),
        F.when(F.col("o_totalprice") >= 100000, F.lit("Diabetes")).alias("condicoes"),
        _s(F.dayofmonth("o_orderdate") * 4).alias("idade"),
        muni.alias("municipioNotificacaoIBGE"),
        F.when(prio == "5-LOW", F.lit("SE")).when((prio == "4-NOT SPECIFIED") & (status == "P"), _null())
        .otherwise(muni).alias("municipioIBGE"),
        F.when(status == "P", F.lit("BA")).otherwise(F.lit(" SE ")).alias("estadoIBGE"),
        F.lit("parda").alias("racaCor"),
        F.when(prio.isin("1-URGENT", "3-MEDIUM"), F.lit("Feminino")).when(prio == "2-HIGH", F.lit(" masculino"))
        .alias("sexo"),
        F.when(status == "F", F.lit("1")).otherwise(F.lit("x")).alias("codigoRecebeuVacina"),
        F.when(status == "F", F.lit("1, 2")).when(status == "O", F.lit("9,10")).alias("codigoDosesVacina"),
        F.date_format(F.date_add(F.to_date("o_orderdate"), 10), "yyyy-MM-dd").alias("dataEncerramento"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dataNotificacao"),
    )


def star_notification_fact(spark, d):
    """Notification fact through the real conform and spec."""
    return build_fact(star.conform_notification(_notification_text(spark, d)), star.notification_fact_spec())


def star_notification_conformed(spark, d):
    """All seventeen conformed notification columns."""
    return star.conform_notification(_notification_text(spark, d))


def star_census_conformed(spark, d):
    """All conformed census columns, read by position from the export."""
    path = scratch_path(spark, "census")
    _census_lines(spark, d).write.text(path)
    return star.conform_census(read_positional(spark, path, V.CENSUS_COLUMNS))


#: A packed raw file is read by one task and sorted there with those beside it, so its rows are bounded.
PACKED, PACKED_ROWS = "lz4", 100_000


def _write_raw_csv(df: DataFrame, path: str, packed: bool = False) -> None:
    """Write text rows as raw ';' CSV extracts, blanks kept as they are;
    ``packed``: as ``.csv.lz4``, at less than half the disk."""
    writer = (df.write.option("header", True).option("sep", ";").option("ignoreLeadingWhiteSpace", False)
              .option("ignoreTrailingWhiteSpace", False))
    if packed:
        writer = writer.option("compression", PACKED).option("maxRecordsPerFile", PACKED_ROWS)
    writer.csv(path)


def star_vaccination_jobs(spark, d):
    """The two vaccination jobs as run in production: raw CSV files ->
    ``ingest_vaccination`` (one scan, ``parte`` partitions) -> fact built
    from the written layer, whose stored ``cod_*`` columns take the filters
    at the Parquet scan."""
    raw, layer = scratch_path(spark, "vacc_raw"), scratch_path(spark, "vacc_layer")
    text = _vaccination_text(spark, d)
    _write_raw_csv(text, raw)
    ingest_vaccination(spark, f"{raw}/*.csv", layer, columns=text.columns)
    drop_scratch(spark, raw)
    return build_fact(read_vaccination_layer(spark, layer), star.vaccination_fact_spec())


def ingest_incremental(spark, d):
    """Two runs of the vaccination ingest into one layer, with files of one
    part token in both runs; the layer then holds all rows."""
    layer = scratch_path(spark, "incremental_layer")
    text = _vaccination_text(spark, d)
    for half in (F.col("vacina_categoria_codigo") == "2", F.col("vacina_categoria_codigo") != "2"):
        raw = scratch_path(spark, "incremental_raw")
        _write_raw_csv(text.filter(half), raw)
        ingest_vaccination(spark, f"{raw}/*.csv", layer, columns=text.columns, part_token="^([a-z]+)-")
        drop_scratch(spark, raw)
    return read_vaccination_layer(spark, layer).select(*STREAM_COLUMNS)


def star_deaths_jobs(spark, d):
    """SRAG jobs as run in production: one raw CSV extract per year (the
    early one lacks the vaccine columns) -> ``ingest_srag`` (filter, align,
    ``ano`` partitions) -> deaths fact from the written layer."""
    li = table(spark, d, "lineitem")
    early, late = scratch_path(spark, "srag_early"), scratch_path(spark, "srag_late")
    _write_raw_csv(_srag_text(li.filter(F.col("l_shipdate") < _ts(_LATE)), with_vaccine=False), early)
    _write_raw_csv(_srag_text(li.filter(F.col("l_shipdate") >= _ts(_LATE)), with_vaccine=True), late)
    layer = scratch_path(spark, "srag_layer")
    ingest_srag(spark, {1997: f"{early}/*.csv", 1998: f"{late}/*.csv"}, layer)
    drop_scratch(spark, early, late)
    return build_fact(read_layer(spark, layer, {"ano": "string"}), star.deaths_fact_spec())


def srag_year_selection(spark, d):
    """Two of three yearly extracts chosen for the ingest (S10): rows of the
    layer per year."""
    li = table(spark, d, "lineitem")
    sources = {}
    for year in (1995, 1996, 1997):
        sources[year] = scratch_path(spark, f"srag_{year}")
        _write_raw_csv(_srag_text(li.filter(F.year("l_shipdate") == year), with_vaccine=year > 1995), sources[year])
    layer = scratch_path(spark, "srag_years")
    ingest_srag(spark, {y: f"{p}/*.csv" for y, p in sources.items()}, layer, years=[1995, 1997])
    drop_scratch(spark, *sources.values())
    return read_layer(spark, layer, {"ano": "string"}).select("ano", "cod_idade", "cod_doses", "cod_vacinado", "data")


def star_notification_jobs(spark, d):
    """Notification job as run in production: raw CSV files read through
    one header-checked glob -> conform -> notification fact."""
    raw = scratch_path(spark, "not_raw")
    text = _notification_text(spark, d)
    _write_raw_csv(text, raw)
    rows = star.conform_notification(read_delimited(spark, f"{raw}/*.csv", text.columns))
    return build_fact(rows, star.notification_fact_spec())


def star_vaccination_tables(spark, d):
    """The whole vaccination table job (fact + 11 dimensions, concurrent
    writes) from a written layer and a localities CSV with further columns in
    another order; returns the row count and a content digest of every table
    written."""
    raw, layer, loc = (scratch_path(spark, n) for n in ("tables_raw", "tables_layer", "tables_loc"))
    out = scratch_path(spark, "tables_out")
    text = _vaccination_text(spark, d)
    _write_raw_csv(text, raw, packed=True)
    wide = _supplier_localities(spark, d).withColumns({"ID": F.col("CD_GEOCODDS"), "TIPO": F.lit("URBANO")})
    _write_raw_csv(wide.select("TIPO", "LONG", "NM_UF", "LAT", "ID", "CD_GEOCODDS", "NM_MUNICIPIO"), loc)
    ingest_vaccination(spark, f"{raw}/*.csv.{PACKED}", layer, columns=text.columns)
    drop_scratch(spark, raw)  # before the tables' shuffles take disk
    paths = build_vaccination_tables(spark, layer, f"{loc}/*.csv", out, star.Scope(state_name="AMERICA"))
    drop_scratch(spark, loc, layer)
    counts = [_digest(spark.read.parquet(p)).withColumn("tabela", F.lit(n)) for n, p in paths.items()]
    return union_aligned(counts, ["tabela", "linhas", "conteudo"])


def _digest(df: DataFrame) -> DataFrame:
    """Row count and an order-free digest of all columns: each row's values
    as text, in the order of the column names, hashed, the hashes summed."""
    text = [F.col(c).cast("decimal(12,2)") if t in ("float", "double") else F.col(c) for c, t in sorted(df.dtypes)]
    row = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("~")) for c in text])
    value = F.conv(F.substring(F.md5(row.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return df.agg(F.count(F.lit(1)).alias("linhas"), F.sum(value).alias("conteudo"))


STREAM_COLUMNS = ["document_id", *star.VACCINATION_KEYS]


def stream_ingest(spark, d):
    """Raw vaccination text dropped as CSV files, conformed by the
    incremental stream ingest (availableNow, exactly-once file sink)."""
    src, out = scratch_path(spark, "stream_src"), scratch_path(spark, "stream_out")
    text = _vaccination_text(spark, d)
    _write_raw_csv(text, src)
    ingest_new_files(spark, src, text.columns, star.conform_vaccination, out, partition_by=(),
                     part_token=None, checkpoint=(ckpt := scratch_path(spark, "stream_ckpt")))
    drop_scratch(spark, src, ckpt)
    return spark.read.parquet(out).select(*STREAM_COLUMNS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "fact_count_distinct": fact_count_distinct,
    "fact_count": fact_count,
    "fact_sum_shifted": fact_sum_shifted,
    "lookup_max_coords": lookup_max_coords,
    "dim_distinct": dim_distinct,
    "dim_label_case": dim_label_case,
    "dim_geo_join": dim_geo_join,
    "dim_geo_join_country": dim_geo_join_country,
    "dim_calendar": dim_calendar,
    "epi_week": epi_week,
    "dim_age_band": dim_age_band,
    "null_sentinel": null_sentinel,
    "recode_map": recode_map,
    "first_present_case": first_present_case,
    "code_prefix": code_prefix,
    "parse_age_text": parse_age_text,
    "decimal_comma": decimal_comma,
    "hash_key": hash_key,
    "array_split_max": array_split_max,
    "scalar_string": scalar_string,
    "scalar_regexp": scalar_regexp,
    "scalar_date_parse": scalar_date_parse,
    "scalar_cast": scalar_cast,
    "filter_predicates": filter_predicates,
    "filter_trim_eq": filter_trim_eq,
    "filter_notin_like": filter_notin_like,
    "filter_null_rejecting": filter_null_rejecting,
    "filter_code_eq": filter_code_eq,
    "project_select": project_select,
    "sql_projection": sql_projection,
    "yearly_align": yearly_align,
    "yearly_fill": yearly_fill,
    "srag_year_selection": srag_year_selection,
    "csv_scan": csv_scan,
    "csv_glob_scan": csv_glob_scan,
    "csv_preamble_scan": csv_preamble_scan,
    "csv_part_token": csv_part_token,
    "parquet_roundtrip": parquet_roundtrip,
    "partitioned_roundtrip": partitioned_roundtrip,
    "row_count": row_count,
    "write_counted": write_counted_rows,
    "star_vaccination_fact": star_vaccination_fact,
    **{f"star_{n}": _star_dim(n) for n in (
        "dm_sistemas", "dm_doses", "dm_sexo", "dm_paciente", "dm_estabelecimento", "dm_vacina",
        "dm_grupo", "dm_categoria", "dm_raca")},
    "star_dm_regiao_estab": star_dm_regiao_estab,
    "star_dm_regiao_paciente": star_dm_regiao_paciente,
    "star_srag_conformed": star_srag_conformed,
    "star_deaths_fact": star_deaths_fact,
    "star_notification_fact": star_notification_fact,
    "star_notification_conformed": star_notification_conformed,
    "star_census_conformed": star_census_conformed,
    "stream_ingest": stream_ingest,
    "ingest_incremental": ingest_incremental,
    "star_vaccination_jobs": star_vaccination_jobs,
    "star_deaths_jobs": star_deaths_jobs,
    "star_notification_jobs": star_notification_jobs,
    "star_vaccination_tables": star_vaccination_tables,
}

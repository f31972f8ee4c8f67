"""The public-health star schema as declarative specs.

Five raw layouts (vaccination, SRAG hospital cases, case notifications,
census population, municipality localities) are conformed by one projection
each, then turned into four fact tables and thirteen dimensions by the
generic builders in :mod:`starloom.operators`.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as X
from ..operators import (
    DimSpec,
    FactSpec,
    Measure,
    OnePass,
    build_dim,
    build_fact,
    chosen,
    collapse_lookup,
    describe_codes,
    dim_columns,
    dim_filter,
    fill_sentinels,
    finish_dim,
    finish_fact,
    lookup_dim,
    rejected_values,
)
from . import vocab as V


@dataclass(frozen=True)
class Scope:
    """What the tables are restricted to: a state (its letters in the data,
    its name in the localities; None keeps every state's localities), the
    first day and the ages."""

    state_code: str = V.STATE_CODE
    state_name: str | None = V.STATE_NAME
    first_day: str = V.FIRST_DOSE_DAY
    age_min: int = V.AGE_MIN
    age_max: int = V.AGE_MAX


DEFAULT_SCOPE = Scope()


def _in(c: str, *values) -> Column:
    return F.col(c).isin(*values)


def _between(c: str, lo: int, hi: int) -> Column:
    return F.col(c).between(lo, hi)


# ---------------------------------------------------------------------------
# Vaccination: raw CSV rows -> conformed rows (kept with all raw columns)
# ---------------------------------------------------------------------------

def municipality_code(c: str | Column) -> Column:
    # 'None' written as text counts as 0; NULL text is 0 before the cast.
    return X.to_int(F.coalesce(X.none_as_zero(c), F.lit(V.NO_CODE)))


#: Raw vaccination columns read as numbers or days, and where the value goes.
VACCINATION_READ = {
    "estabelecimento_valor": "cod_estabelecimento", "vacina_grupoAtendimento_codigo": "cod_grupo",
    "vacina_categoria_codigo": "cod_categoria", "vacina_codigo": "cod_vacina", "paciente_racaCor_codigo": "cod_raca",
    "paciente_idade": "cod_idade", "paciente_endereco_coIbgeMunicipio": "cod_municipio_paciente",
    "estabelecimento_municipio_codigo": "cod_municipio_estab", "vacina_dataAplicacao": "data_aplicacao",
}


def conform_vaccination(raw: DataFrame, account: bool = False) -> DataFrame:
    """Add the ``cod_*`` keys and application dates to vaccination rows.
    ``account``: and ``rejeitos``, the texts that could not be read."""
    applied = X.to_date(X.clean("vacina_dataAplicacao"))
    df = raw.withColumns({
        "cod_sistema_origem": F.substring(X.clean_upper("sistema_origem"), 1, 3),
        "cod_dose": X.hash_key(X.clean("vacina_descricao_dose")),
        "cod_estabelecimento": X.to_int("estabelecimento_valor"),
        "cod_grupo": X.to_int("vacina_grupoAtendimento_codigo"),
        "cod_categoria": X.to_int("vacina_categoria_codigo"),
        "cod_vacina": X.to_int("vacina_codigo"),
        "cod_paciente": X.clean("paciente_id"),
        "cod_raca": X.to_int("paciente_racaCor_codigo"),
        "cod_idade": X.to_int("paciente_idade"),
        "cod_sexo": X.sex_code("paciente_enumSexoBiologico"),
        "cod_municipio_paciente": municipality_code("paciente_endereco_coIbgeMunicipio"),
        "cod_municipio_estab": municipality_code("estabelecimento_municipio_codigo"),
        "data_aplicacao": applied,
        "data": applied,
    })
    if account:
        read = {c: (c, value) for c, value in {**VACCINATION_READ, "paciente_dataNascimento": "_nascimento"}.items()}
        df = df.withColumn("_nascimento", X.to_date("paciente_dataNascimento"))
        df = df.withColumn("rejeitos", rejected_values(read)).drop("_nascimento")
    return fill_sentinels(df, V.VACCINATION_SENTINELS)


VACCINATION_KEYS = (
    "cod_sistema_origem", "cod_estabelecimento", "cod_grupo", "cod_categoria", "cod_vacina",
    "cod_paciente", "cod_dose", "cod_raca", "cod_sexo", "cod_idade", "cod_municipio_estab",
    "cod_municipio_paciente", "data_aplicacao",
)


def vaccination_fact_spec(scope: Scope = DEFAULT_SCOPE) -> FactSpec:
    """Distinct vaccination documents per 13 keys, restricted to residents of
    the state, defined sex, ages 10-110, known dose, and days from the first
    dose given in the state. (All 13 selected keys are grouped.)"""
    return FactSpec(
        keys=VACCINATION_KEYS,
        measure=Measure("count_distinct", "Qtd_Vacinas_Aplicadas", "document_id"),
        where=((F.col("paciente_endereco_uf") == scope.state_code) & _in("cod_sexo", "F", "M")
               & _between("cod_idade", scope.age_min, scope.age_max) & (F.col("cod_dose") != V.NO_CODE)
               & (F.col("data_aplicacao") >= F.lit(scope.first_day).cast("date"))),
        rename={"data_aplicacao": "data"},
    )


def sex_dim_spec() -> DimSpec:
    return DimSpec(
        columns={"cod_sexo": "cod_sexo",
                 "des_sexo": X.recode("cod_sexo", V.SEX_LABELS, default=V.NO_INFO)},
        having=_in("cod_sexo", "F", "M"),
    )


def vaccination_dim_specs() -> dict[str, DimSpec]:
    """The nine code/description dimensions of the vaccination rows."""
    described = lambda code, **cols: DimSpec(
        columns={code: code, **cols}, defaults={k: V.NO_INFO for k in cols}, not_null=(code,))
    return {
        "dm_sistemas": DimSpec(columns={"cod_sistema_origem": "cod_sistema_origem",
                                        "sistema_origem": F.upper("sistema_origem")},
                               not_null=("sistema_origem",)),
        "dm_doses": DimSpec(columns={"cod_dose": "cod_dose",
                                     "desc_dose": F.upper("vacina_descricao_dose")},
                            not_null=("vacina_descricao_dose",)),
        "dm_sexo": sex_dim_spec(),
        "dm_paciente": DimSpec(columns={"cod_paciente": "cod_paciente",
                                        "data_nascimento": X.to_date("paciente_dataNascimento"),
                                        "cep": F.coalesce(X.clean("paciente_endereco_cep"), F.lit(V.NO_CODE))},
                               not_null=("cod_paciente",)),
        "dm_estabelecimento": described("cod_estabelecimento",
                                        razao_social=F.col("estabelecimento_razaoSocial"),
                                        nome_fantasia=F.col("estalecimento_noFantasia")),
        "dm_vacina": described("cod_vacina", nome_vacina=F.col("vacina_nome"),
                               nome_fabricante=F.col("vacina_fabricante_nome")),
        "dm_grupo": described("cod_grupo", desc_grupo=F.col("vacina_grupoAtendimento_nome")),
        "dm_categoria": described("cod_categoria", desc_categoria=F.col("vacina_categoria_nome")),
        "dm_raca": described("cod_raca", desc_raca=F.col("paciente_racaCor_valor")),
    }


# ---------------------------------------------------------------------------
# Localities lookup and the two geographic dimensions
# ---------------------------------------------------------------------------

LOCALITY_COLUMNS = V.LOCALITY_COLUMNS


def localities_lookup(raw: DataFrame, state_name: str | None = V.STATE_NAME, one_name: bool = False) -> DataFrame:
    """Municipality lookup: 6-digit code, names, coordinates (decimal comma
    repaired, float). Several localities of one municipality collapse to
    the maximum latitude/longitude. ``state_name=None`` keeps every state.
    ``one_name``: a code that localities give several names has one row, with
    the name that most of them give (the least of equals) and the maxima over
    all; by default it has a row a name."""
    df = raw.select(
        X.code_prefix("CD_GEOCODDS").alias("cod_municipio"),
        X.clean("NM_MUNICIPIO").alias("desc_municipio"),
        X.clean("NM_UF").alias("desc_uf"),
        X.decimal_comma("LAT").alias("latitude"),
        X.decimal_comma("LONG").alias("longitude"),
    )
    if state_name is not None:
        df = df.filter(F.col("desc_uf") == state_name)
    if one_name:
        counted = df.groupBy("cod_municipio", "desc_municipio", "desc_uf").agg(F.count(F.lit(1)).alias("_linhas"))
        names = chosen(counted, ["cod_municipio"])
        return collapse_lookup(df, ["cod_municipio"], ["latitude", "longitude"]).join(names, "cod_municipio").select(
            "cod_municipio", "desc_municipio", "desc_uf", "latitude", "longitude")
    return collapse_lookup(df, ["cod_municipio", "desc_municipio", "desc_uf"], ["latitude", "longitude"])


def _estab_columns(key: str) -> dict[str, Column]:
    zero = F.col(key) == 0
    return {
        key: F.col(key),
        "desc_municipio_estab": F.when(zero, F.lit(V.NO_STATE)).otherwise(F.col("desc_municipio")),
        "desc_uf_estab": F.when(zero, F.lit(V.NO_STATE)).otherwise(F.col("desc_uf")),
        "latitude": F.col("latitude"),
        "longitude": F.col("longitude"),
    }


def _patient_columns(key: str) -> dict[str, Column]:
    zero = F.col(key) == 0
    return {
        key: F.col(key),
        "desc_municipio": F.when(zero, F.lit(V.NO_INFO)).otherwise(F.col("desc_municipio")),
        "desc_uf": F.when(zero, F.lit(V.NO_STATE)).otherwise(F.col("desc_uf")),
        "desc_pais": F.when(zero, F.lit(V.NO_STATE)).otherwise(F.lit(V.COUNTRY)),
        "latitude": F.col("latitude"),
        "longitude": F.col("longitude"),
    }


def establishment_region_dim(rows: DataFrame, lookup: DataFrame, uf_column: str = "estabelecimento_uf",
                             key: str = "cod_municipio_estab", scope: Scope = DEFAULT_SCOPE) -> DataFrame:
    return lookup_dim(rows, key, lookup, "cod_municipio", columns=_estab_columns(key),
                      where=F.col(uf_column).isin(scope.state_code, V.NO_STATE))


def patient_region_dim(rows: DataFrame, lookup: DataFrame, uf_column: str = "paciente_endereco_uf",
                       key: str = "cod_municipio_paciente", scope: Scope = DEFAULT_SCOPE) -> DataFrame:
    return lookup_dim(rows, key, lookup, "cod_municipio", columns=_patient_columns(key),
                      where=F.col(uf_column).isin(scope.state_code, V.NO_STATE))


#: Region dimensions: key, state column, described columns.
_REGIONS = {
    "dm_regiao_estab": ("cod_municipio_estab", "estabelecimento_uf", _estab_columns),
    "dm_regiao_paciente": ("cod_municipio_paciente", "paciente_endereco_uf", _patient_columns),
}


def one_name_each(specs: dict[str, DimSpec]) -> dict[str, DimSpec]:
    """The specs with one row for each value of their first column."""
    return {n: replace(s, unique_by=(next(iter(s.columns)),)) for n, s in specs.items()}


def vaccination_star(conformed: DataFrame, lookup: DataFrame, scope: Scope = DEFAULT_SCOPE,
                     one_name: bool = False) -> dict[str, DataFrame]:
    """All twelve vaccination tables from one conformed input (lazy), each
    with a scan of the columns that it uses. ``one_name``: one row a code in
    each dimension, that of most source rows."""
    out = {"fato_vacinas": build_fact(conformed, vaccination_fact_spec(scope))}
    specs = vaccination_dim_specs()
    for name, spec in (one_name_each(specs) if one_name else specs).items():
        out[name] = build_dim(conformed, spec)
    out["dm_regiao_estab"] = establishment_region_dim(conformed, lookup, scope=scope)
    out["dm_regiao_paciente"] = patient_region_dim(conformed, lookup, scope=scope)
    return out


def vaccination_pass(conformed: DataFrame, scope: Scope = DEFAULT_SCOPE) -> OnePass:
    """The distinct rows of all twelve tables from one scan: the fact's keys
    with the document, the dimensions' columns, the region codes."""
    fact = vaccination_fact_spec(scope)
    tables: dict[str, tuple[dict, Column | None]] = {
        "fato_vacinas": ({c: c for c in (*fact.keys, fact.measure.column)}, fact.where)}
    for name, spec in vaccination_dim_specs().items():
        tables[name] = (dim_columns(spec), dim_filter(spec))
    for name, (key, uf, _) in _REGIONS.items():
        code = F.col(key).cast("int")
        tables[name] = ({key: code}, F.col(uf).isin(scope.state_code, V.NO_STATE) & code.isNotNull())
    return OnePass(conformed, tables)


def vaccination_tables(once: OnePass, rows: DataFrame, lookup: DataFrame, scope: Scope = DEFAULT_SCOPE,
                       one_name: bool = False) -> dict[str, DataFrame]:
    """All twelve tables from the distinct rows of :func:`vaccination_pass`
    (``rows``: as written). ``one_name``: one row a code in each dimension,
    that of most source rows."""
    fact = vaccination_fact_spec(scope)
    counted = once.table(rows, "fato_vacinas").groupBy(*fact.keys).agg(F.count(fact.measure.column).alias(fact.measure.alias))
    out = {"fato_vacinas": finish_fact(counted, fact)}
    specs = vaccination_dim_specs()
    for name, spec in (one_name_each(specs) if one_name else specs).items():
        out[name] = finish_dim(once.table(rows, name), spec)
    for name, (key, _, described) in _REGIONS.items():
        out[name] = describe_codes(once.table(rows, name).drop("_linhas"), key, lookup, "cod_municipio", described(key))
    return out


# ---------------------------------------------------------------------------
# SRAG hospital cases: yearly rows -> conformed rows -> deaths fact
# ---------------------------------------------------------------------------

def srag_case_filter(scope: Scope = DEFAULT_SCOPE) -> Column:
    """Rows of the state with a COVID-19 final classification."""
    return ((F.trim(F.col("SG_UF")) == scope.state_code)
            & (F.trim(F.col("CLASSI_FIN")) == V.SRAG_FINAL_CLASS))


def _int_or_zero_text(c: str) -> Column:
    # NULL becomes 0 *before* the cast, so only unreadable text ends NULL.
    return X.to_int(F.coalesce(X.clean(c), F.lit(V.NO_CODE)))


def _srag_columns() -> dict[str, Column]:
    notified = X.to_date("DT_NOTIFIC", "dd/MM/yyyy")
    return {
        "cod_class_final": X.clean("CLASSI_FIN"),
        "cod_evolucao": X.clean("EVOLUCAO"),
        "cod_risco": X.letter_flag("FATOR_RISC"),
        "cod_idade": _int_or_zero_text("NU_IDADE_N"),
        "cod_municipio_estab": _int_or_zero_text("CO_MUN_NOT"),
        "cod_municipio_paciente": _int_or_zero_text("CO_MUN_RES"),
        "cod_uf_paciente": X.clean("SG_UF"),
        "cod_raca": X.swapped_race_code("CS_RACA"),
        "cod_sexo": X.sex_code("CS_SEXO", first_letter=False),
        "cod_internacao": X.to_int("HOSPITAL"),
        "cod_uti": X.to_int("UTI"),
        "cod_vacinado": X.to_int("VACINA_COV"),
        "cod_doses": X.first_present(V.DOSE_PRECEDENCE, V.NO_DOSE),
        "dat_encerramento": X.to_date("DT_DIGITA", "dd/MM/yyyy"),
        "dat_notificacao": notified,
        "data": notified,
    }


#: Raw SRAG columns read as numbers or days, and where the value goes.
SRAG_READ = {
    "NU_IDADE_N": "cod_idade", "CO_MUN_NOT": "cod_municipio_estab", "CO_MUN_RES": "cod_municipio_paciente",
    "HOSPITAL": "cod_internacao", "UTI": "cod_uti", "VACINA_COV": "cod_vacinado",
    "DT_DIGITA": "dat_encerramento", "DT_NOTIFIC": "dat_notificacao",
}


def conform_srag(aligned: DataFrame, account: bool = False) -> DataFrame:
    """Aligned SRAG rows with the sixteen conformed columns beside the raw
    ones, and the outcome as a number (``cod_evolucao_num``, NULL where it is
    none), which the deaths fact filters on. ``account``: and ``rejeitos``,
    the texts that could not be read."""
    rows = aligned.withColumns(_srag_columns())
    if account:
        rows = rows.withColumn("rejeitos", rejected_values({c: (c, value) for c, value in SRAG_READ.items()}))
    out = fill_sentinels(rows, V.SRAG_SENTINELS)
    return out.withColumn("cod_evolucao_num", X.to_int("cod_evolucao"))


def deaths_fact_spec(scope: Scope = DEFAULT_SCOPE) -> FactSpec:
    return FactSpec(
        keys=("cod_idade", "cod_municipio_paciente", "cod_sexo", "data"),
        measure=Measure("count", "qtd_obito", cast="float"),
        where=((F.col("cod_evolucao_num") == V.DEATH_OUTCOME)
               & _between("cod_idade", scope.age_min, scope.age_max) & _in("cod_sexo", "F", "M")
               & (F.col("cod_uf_paciente") == scope.state_code)),
    )


# ---------------------------------------------------------------------------
# Case notifications: raw rows -> conformed rows -> notification fact
# ---------------------------------------------------------------------------

def conform_notification(raw: DataFrame, scope: Scope = DEFAULT_SCOPE) -> DataFrame:
    """Notification rows of all states with their keys. Rows whose patient
    municipality reads as the state letters are dropped (NULL as well:
    ``<>`` rejects NULL)."""
    patient_muni = F.substring(X.clean("municipioIBGE"), 1, 6)
    notified = X.to_date("dataNotificacao")
    df = raw.filter(patient_muni != scope.state_code)
    out = df.select(
        X.hash_key("classificacaoFinal").alias("cod_class_final"),
        F.upper(F.rtrim(F.ltrim("classificacaoFinal"))).alias("des_class_final"),
        X.hash_key("evolucaoCaso").alias("cod_evolucao"),
        F.upper(F.rtrim(F.ltrim("evolucaoCaso"))).alias("des_evolucao"),
        X.hash_key("condicoes").alias("cod_condicoes"),
        F.upper(F.rtrim(F.ltrim("condicoes"))).alias("des_condicoes"),
        X.to_int("idade").alias("cod_idade"),
        F.substring(X.clean("municipioNotificacaoIBGE"), 1, 6).alias("cod_municipio_estab"),
        X.to_int(patient_muni).alias("cod_municipio_paciente"),
        X.clean("estadoIBGE").alias("estado"),
        X.clean_upper("racaCor").alias("des_raca"),
        F.when(F.col("sexo").isNull(), F.lit(V.MISSING_SEX)).otherwise(X.first_char("sexo", upper=True))
        .alias("cod_sexo"),
        X.to_int("codigoRecebeuVacina").alias("cod_vacinado"),
        X.split_max("codigoDosesVacina").alias("cod_doses"),
        X.to_date("dataEncerramento").alias("dat_encerramento"),
        notified.alias("dat_notificacao"),
        notified.alias("data"),
    )
    return fill_sentinels(out, V.NOTIFICATION_SENTINELS)


def notification_fact_spec(scope: Scope = DEFAULT_SCOPE) -> FactSpec:
    return FactSpec(
        keys=("cod_idade", "cod_municipio_paciente", "cod_sexo", "data"),
        measure=Measure("count", "qtd_notificacao", cast="float"),
        where=((F.col("estado") == scope.state_code) & _in("cod_sexo", "M", "F")
               & _between("cod_idade", scope.age_min, scope.age_max)),
    )


# ---------------------------------------------------------------------------
# Census population: positional CSV rows -> conformed rows -> population fact
# ---------------------------------------------------------------------------

def conform_census(raw: DataFrame) -> DataFrame:
    """Census rows with a quantity and an age in years.

    Title, header and note lines of the export carry no age text with
    'ano', so the row predicate drops them with the empty quantities.
    """
    rows = raw.filter(~F.trim(F.col("Qtd")).isin(*V.CENSUS_EMPTY_QTD)).filter(
        F.trim(F.col("Idade")).like(V.AGE_PATTERN))
    age = X.age_from_text("Idade")
    return rows.select(
        X.clean("Situacao_domicilio").alias("situacao_domicilio"),
        X.clean_upper("Sexo").alias("desc_sexo"),
        X.clean("Cor_raca").alias("cor_raca"),
        X.code_prefix("Cod").alias("cod_municipio_paciente"),
        age.alias("cod_idade"),
        X.age_text_label("Idade", age).alias("desc_idade"),
        X.to_int("Qtd").alias("qtd"),
    )


def population_fact_spec(scope: Scope = DEFAULT_SCOPE) -> FactSpec:
    """Population per sex, municipality and age, the age emitted shifted by
    nine years (as the source job publishes it), kept for 10-110 and F/M."""
    return FactSpec(
        keys=("cod_sexo", "cod_municipio_paciente", "cod_idade"),
        measure=Measure("sum", "qtd_populacao", "qtd"),
        shift={"cod_idade": V.POPULATION_AGE_SHIFT},
        having=_between("cod_idade", scope.age_min, scope.age_max) & _in("cod_sexo", "F", "M"),
    )


def population_fact(conformed: DataFrame, scope: Scope = DEFAULT_SCOPE) -> DataFrame:
    with_sex = conformed.withColumn("cod_sexo", X.recode("desc_sexo", V.CENSUS_SEX, default=V.MISSING_SEX))
    return build_fact(with_sex, population_fact_spec(scope))


# ---------------------------------------------------------------------------
# Generated dimensions: ages and calendar
# ---------------------------------------------------------------------------

def age_dim(ages: DataFrame, column: str = "cod_idade") -> DataFrame:
    """Age dimension over the distinct ages of ``ages[column]``: label and band."""
    distinct = ages.select(F.col(column).cast("int").alias("cod_idade")).distinct()
    return distinct.select(
        "cod_idade",
        X.age_label("cod_idade").alias("desc_idade"),
        X.age_band("cod_idade").alias("faixa_etaria"),
    )


def calendar_dim(days: DataFrame, column: str = "data") -> DataFrame:
    """Calendar dimension for a column of distinct days (a spine)."""
    d = F.to_date(F.col(column))
    cols = X.calendar_columns(d)
    return days.select(d.alias("data"), *[c.alias(n) for n, c in cols.items()])

"""Independent DuckDB statements of the operator queries in :mod:`queries`.

Each statement restates the semantics in plain SQL over the registered
views, with the same output names and types, so the Spark result can be
compared value by value.
"""

from __future__ import annotations

_NUM = r"'[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)'"


def INT(x: str, t: str = "INTEGER") -> str:
    """Lenient text -> int: blanks ignored, fraction truncated, else NULL."""
    v = f"trim(CAST({x} AS VARCHAR))"
    return (f"(CASE WHEN regexp_full_match({v}, {_NUM}) "
            f"THEN TRY_CAST(trunc(TRY_CAST({v} AS DECIMAL(38,10))) AS {t}) END)")


def FLOAT(x: str) -> str:
    return f"TRY_CAST(trim({x}) AS REAL)"


def EPI(d: str) -> str:
    return f"(week({d}) + CASE WHEN dayofweek({d}) = 0 THEN 1 ELSE 0 END)"


LOC = f"""
SELECT lpad(CAST(s.s_nationkey AS VARCHAR), 6, '0') || '1' AS CD_GEOCODDS,
       n.n_name AS NM_MUNICIPIO, ' ' || r.r_name AS NM_UF,
       replace(printf('%.2f', s.s_acctbal), '.', ',') AS LAT,
       replace(printf('%.2f', -s.s_acctbal), '.', ',') AS LONG
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""


def LOOKUP(state: str | None) -> str:
    where = f"WHERE desc_uf = '{state}'" if state else ""
    return f"""
SELECT cod_municipio, desc_municipio, desc_uf, MAX(latitude) AS latitude, MAX(longitude) AS longitude
FROM (SELECT {INT("substr(trim(CD_GEOCODDS), 1, 6)")} AS cod_municipio,
             trim(NM_MUNICIPIO) AS desc_municipio, trim(NM_UF) AS desc_uf,
             {FLOAT("replace(trim(LAT), ',', '.')")} AS latitude,
             {FLOAT("replace(trim(LONG), ',', '.')")} AS longitude
      FROM ({LOC})) {where}
GROUP BY cod_municipio, desc_municipio, desc_uf
"""


CUSTOMER_ROWS = """
SELECT c_nationkey AS cod_municipio_estab, c_nationkey AS cod_municipio_paciente,
       CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 'SE'
            WHEN c_mktsegment = 'MACHINERY' THEN '-' ELSE c_mktsegment END AS estabelecimento_uf,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '-' ELSE 'SE' END AS paciente_endereco_uf
FROM customer
"""

FACT_COUNT = """
SELECT CAST(user_id AS INTEGER) AS cod_idade, event_type, CAST(ts AS DATE) AS data,
       CAST(COUNT(*) AS REAL) AS qtd_eventos
FROM events
WHERE event_type IN ('click', 'view') AND user_id BETWEEN 10 AND 110
GROUP BY 1, 2, 3
"""

STRIP = "replace(replace(Idade, ' anos', ''), ' ano', '')"

ORACLE: dict[str, str] = {
    "fact_count_distinct": """
SELECT o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS data,
       COUNT(DISTINCT o_custkey) AS qtd_clientes
FROM orders
WHERE o_orderstatus IN ('F', 'O') AND o_totalprice BETWEEN 1000 AND 110000
  AND o_orderpriority <> '5-LOW' AND o_orderdate >= TIMESTAMP '1996-01-19 00:00:00'
GROUP BY 1, 2, 3
""",
    "fact_count": FACT_COUNT,
    "fact_sum_shifted": """
SELECT * FROM (
  SELECT cod_sexo, cod_municipio, q + 9 AS cod_idade, CAST(SUM(l_linenumber) AS BIGINT) AS qtd_populacao
  FROM (SELECT CASE WHEN l_returnflag = 'A' THEN 'F' WHEN l_returnflag = 'R' THEN 'M' ELSE 'N' END AS cod_sexo,
               l_suppkey AS cod_municipio, CAST(trunc(l_quantity) AS INTEGER) AS q, l_linenumber
        FROM lineitem)
  GROUP BY cod_sexo, cod_municipio, q)
WHERE cod_idade BETWEEN 10 AND 50 AND cod_sexo IN ('F', 'M')
""",
    "lookup_max_coords": LOOKUP(None),
    "dim_distinct": """
SELECT DISTINCT p_brand AS cod_marca,
       COALESCE(upper(CASE WHEN p_size <= 45 THEN p_type END), 'SEM INFORMACAO') AS desc_tipo
FROM part WHERE p_brand IS NOT NULL
""",
    "dim_label_case": """
SELECT * FROM (
  SELECT DISTINCT cod_sexo,
         CASE WHEN cod_sexo = 'F' THEN 'FEMININO' WHEN cod_sexo = 'M' THEN 'MASCULINO'
              ELSE 'SEM INFORMACAO' END AS des_sexo
  FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN 'F' WHEN o_orderstatus = 'O' THEN 'M' ELSE 'I' END AS cod_sexo
        FROM orders))
WHERE cod_sexo IN ('F', 'M')
""",
    "dim_geo_join": f"""
SELECT DISTINCT a.cod_municipio_estab,
       CASE WHEN a.cod_municipio_estab = 0 THEN '-' ELSE c.desc_municipio END AS desc_municipio_estab,
       CASE WHEN a.cod_municipio_estab = 0 THEN '-' ELSE c.desc_uf END AS desc_uf_estab,
       c.latitude, c.longitude
FROM ({CUSTOMER_ROWS}) a JOIN ({LOOKUP('AFRICA')}) c ON a.cod_municipio_estab = c.cod_municipio
WHERE a.cod_municipio_estab IS NOT NULL AND a.estabelecimento_uf IN ('SE', '-')
""",
    "dim_geo_join_country": f"""
SELECT DISTINCT a.cod_municipio_paciente,
       CASE WHEN a.cod_municipio_paciente = 0 THEN 'SEM INFORMACAO' ELSE c.desc_municipio END AS desc_municipio,
       CASE WHEN a.cod_municipio_paciente = 0 THEN '-' ELSE c.desc_uf END AS desc_uf,
       CASE WHEN a.cod_municipio_paciente = 0 THEN '-' ELSE 'Brasil' END AS desc_pais,
       c.latitude, c.longitude
FROM ({CUSTOMER_ROWS}) a JOIN ({LOOKUP('AFRICA')}) c ON a.cod_municipio_paciente = c.cod_municipio
WHERE a.cod_municipio_paciente IS NOT NULL AND a.paciente_endereco_uf IN ('SE', '-')
""",
    "dim_calendar": f"""
SELECT data, strftime(data, '%d') AS dia, strftime(data, '%m') AS mes, strftime(data, '%Y') AS ano,
       CAST(date_trunc('month', data) AS DATE) AS anomes,
       lpad(CAST(week(data) AS VARCHAR), 2, '0') AS semana,
       lpad(CAST({EPI('data')} AS VARCHAR), 2, '0') AS semana_epi,
       strftime(data, '%Y') || lpad(CAST({EPI('data')} AS VARCHAR), 2, '0') AS anosemana_epi
FROM (SELECT CAST(d AS DATE) AS data
      FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d
            FROM (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders)))
""",
    "epi_week": f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS data,
       CAST({EPI('o_orderdate')} AS INTEGER) AS semana_epi,
       strftime(o_orderdate, '%Y') || lpad(CAST({EPI('o_orderdate')} AS VARCHAR), 2, '0') AS anosemana_epi
FROM orders
""",
    "dim_age_band": """
SELECT cod_idade,
       CAST(cod_idade AS VARCHAR) || ' ' || CASE WHEN cod_idade <= 1 THEN 'Ano' ELSE 'Anos' END AS desc_idade,
       CASE WHEN cod_idade IS NULL THEN NULL
            WHEN cod_idade <= 9 THEN 'Menos de 10 anos'
            WHEN cod_idade BETWEEN 10 AND 19 THEN 'De 10 a 19 anos'
            WHEN cod_idade BETWEEN 20 AND 39 THEN 'De 20 a 39 anos'
            WHEN cod_idade BETWEEN 40 AND 59 THEN 'De 40 a 59 anos'
            WHEN cod_idade BETWEEN 60 AND 89 THEN 'De 60 a 89 anos'
            ELSE 'Mais de 90 anos' END AS faixa_etaria
FROM (SELECT DISTINCT CAST(user_id AS INTEGER) AS cod_idade FROM events)
""",
    "null_sentinel": """
SELECT o_orderkey,
       COALESCE(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderstatus END, '0') AS cod_status,
       COALESCE(CASE WHEN o_orderstatus <> 'P' THEN o_custkey END, 0) AS cod_cliente,
       COALESCE(CASE WHEN o_totalprice < 300000 THEN CAST(dayofmonth(o_orderdate) AS INTEGER) END, 999) AS cod_idade
FROM orders
""",
    "recode_map": f"""
WITH t AS (
  SELECT o_orderkey,
         CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN NULL
              ELSE substr(o_orderpriority, 1, 1) || CASE WHEN o_orderstatus = 'P' THEN '4' ELSE '' END END AS race_text,
         CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderstatus = 'F' THEN ' S '
              WHEN o_orderstatus = 'O' THEN 'N' ELSE o_orderstatus END AS risk_text,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL WHEN o_orderstatus = 'F' THEN ' Feminino'
              WHEN o_orderstatus = 'O' THEN 'Masculino ' ELSE 'Ignorado' END AS sex_text,
         CASE WHEN o_orderstatus = 'F' THEN 'MULHERES' WHEN o_orderstatus = 'O' THEN 'HOMENS'
              ELSE 'TOTAL' END AS census_text
  FROM orders),
r AS (SELECT *, {INT("replace(trim(race_text), '4', '6')")} AS rc, substr(trim(sex_text), 1, 1) AS sx FROM t)
SELECT o_orderkey,
       CASE WHEN rc IS NULL THEN 99 WHEN rc = 6 THEN 3 WHEN rc = 3 THEN 4 WHEN rc = 9 THEN 99 ELSE rc END AS cod_raca,
       CASE WHEN trim(risk_text) IS NULL THEN '9' WHEN trim(risk_text) = 'S' THEN '1'
            WHEN trim(risk_text) = 'N' THEN '2' ELSE trim(risk_text) END AS cod_risco,
       CASE WHEN sx IS NULL OR sx = 'I' THEN 'N' ELSE sx END AS cod_sexo,
       CASE WHEN census_text = 'HOMENS' THEN 'M' WHEN census_text = 'MULHERES' THEN 'F' ELSE 'N' END AS cod_sexo_censo
FROM r
""",
    "first_present_case": """
SELECT o_orderkey,
       CASE WHEN trim(CASE WHEN o_orderstatus = 'F' THEN '1' END) IS NOT NULL THEN 1
            WHEN trim(CASE WHEN o_orderpriority = '1-URGENT' THEN 'x' END) IS NOT NULL THEN 2
            WHEN trim(CASE WHEN o_totalprice > 200000 THEN ' d ' END) IS NOT NULL THEN 1
            WHEN trim(CASE WHEN o_orderpriority = '2-HIGH' THEN '01/02/2021' END) IS NOT NULL THEN 1
            WHEN trim(CASE WHEN o_orderstatus = 'P' THEN 'y' END) IS NOT NULL THEN 2
            ELSE 0 END AS cod_doses
FROM orders
""",
    "code_prefix": f"""
SELECT c_custkey,
       {INT("substr(trim(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'SE' ELSE '  ' || CAST(c_custkey + 2800000 AS VARCHAR) || '7 ' END), 1, 6)")} AS cod_municipio
FROM customer
""",
    "parse_age_text": f"""
WITH t AS (
  SELECT p_partkey,
         CASE WHEN p_size = 1 THEN '1 ano'
              WHEN p_type = 'MEDIUM' THEN CAST(p_size AS VARCHAR) || ' meses'
              WHEN p_type = 'PROMO' THEN CAST(p_size AS VARCHAR) || ' anos ou mais'
              WHEN p_type = 'STANDARD' THEN '1 ano e ' || CAST(p_size AS VARCHAR) || ' meses'
              WHEN p_type = 'LARGE' THEN CAST(p_size AS VARCHAR) || ' a ' || CAST(p_size + 4 AS VARCHAR) || ' anos'
              ELSE CAST(p_size AS VARCHAR) || ' anos' END AS Idade
  FROM part),
a AS (SELECT p_partkey, {STRIP} AS stripped,
             CASE WHEN trim({STRIP}) LIKE '% m%' THEN 0 ELSE {INT(f"trim({STRIP})")} END AS cod_idade
      FROM t WHERE trim(Idade) LIKE '%ano%')
SELECT p_partkey, cod_idade, CASE WHEN cod_idade = 0 THEN 'Meses Idade' ELSE trim(stripped) END AS desc_idade
FROM a
""",
    "decimal_comma": f"""
SELECT p_partkey,
       {FLOAT("replace(trim(CASE WHEN p_type = 'SMALL' THEN CAST(p_size AS VARCHAR) || '.' || CAST(p_size AS VARCHAR) WHEN p_type = 'LARGE' THEN CAST(p_size AS VARCHAR) || ',5,1' ELSE ' -' || CAST(p_size AS VARCHAR) || ',5' END), ',', '.')")} AS valor
FROM part
""",
    "hash_key": """
SELECT DISTINCT COALESCE(sha256(trim(descricao)), '0') AS cod_dose, upper(descricao) AS desc_dose
FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL
                  WHEN o_orderstatus = 'O' THEN ' ' || o_orderpriority || ' '
                  ELSE lower(o_orderpriority) END AS descricao
      FROM orders)
WHERE descricao IS NOT NULL
""",
    "array_split_max": """
SELECT event_id,
       COALESCE(list_max(string_split(trim(
         CASE WHEN event_type = 'error' THEN NULL
              WHEN event_type = 'view' THEN ' ' || CAST(user_id AS VARCHAR) || ', ' || CAST(hour(ts) AS VARCHAR) || ' '
              ELSE CAST(user_id AS VARCHAR) || ',' || CAST(hour(ts) AS VARCHAR) END), ',')), '0') AS cod_doses
FROM events
""",
    "scalar_string": """
SELECT o_orderkey, trim(padded) AS aparado, rtrim(ltrim(padded)) AS aparado_lr,
       upper(trim(padded)) AS maiusculo, substr(upper(trim(padded)), 1, 3) AS prefixo,
       substr(upper(trim(padded)), 1, 1) AS inicial
FROM (SELECT o_orderkey, '  ' || lower(o_orderpriority) || ' ' AS padded FROM orders)
""",
    "scalar_regexp": f"""
SELECT p_partkey, regexp_replace(p_name, '[aeiou]', '', 'g') AS sem_vogais,
       {INT("COALESCE(replace(trim(code_text), 'None', '0'), '0')")} AS cod_municipio
FROM (SELECT p_partkey, p_name,
             CASE WHEN p_type = 'PROMO' THEN 'None' WHEN p_type = 'SMALL' THEN NULL
                  ELSE ' ' || CAST(p_size AS VARCHAR) END AS code_text
      FROM part)
""",
    "scalar_date_parse": """
SELECT event_id,
       CAST(try_strptime(dd || '/' || mm || '/' || y, '%d/%m/%Y') AS DATE) AS dat_notificacao,
       CAST(try_strptime(y || '-' || mm || '-' || dd, '%Y-%m-%d') AS DATE) AS dat_encerramento
FROM (SELECT event_id,
             lpad(CAST(dayofmonth(ts) + CASE WHEN event_type = 'error' THEN 10 ELSE 0 END AS VARCHAR), 2, '0') AS dd,
             lpad(CAST(CASE WHEN event_type = 'signup' THEN 2 ELSE month(ts) END AS VARCHAR), 2, '0') AS mm,
             CAST(year(ts) AS VARCHAR) AS y
      FROM events)
""",
    "scalar_cast": f"""
SELECT o_orderkey, {INT("txt")} AS cod_cliente, {INT("substr(o_orderpriority, 1, 1)")} AS cod_prioridade,
       {INT("o_orderstatus")} AS cod_status
FROM (SELECT o_orderkey, o_orderstatus, o_orderpriority,
             CASE WHEN o_orderpriority = '5-LOW' THEN CAST(o_custkey AS VARCHAR) || '0000000'
                  WHEN o_orderstatus = 'O' THEN ' ' || CAST(o_custkey AS VARCHAR) || ' '
                  WHEN o_orderstatus = 'P' THEN 'n' || CAST(o_custkey AS VARCHAR)
                  ELSE CAST(o_custkey AS VARCHAR) || '.' || CAST(dayofmonth(o_orderdate) AS VARCHAR) END AS txt
      FROM orders)
""",
    "filter_predicates": """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS data FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice BETWEEN 1000 AND 200000
  AND CAST(o_orderdate AS DATE) >= DATE '1996-01-19'
""",
    "filter_trim_eq": """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE trim(' ' || o_orderstatus || '  ') = 'F' AND trim(substr(o_orderpriority, 1, 1) || ' ') = '1'
""",
    "filter_notin_like": """
SELECT p_partkey, p_name, p_type FROM part
WHERE NOT (trim(p_type) IN ('SMALL', '', ' ')) AND p_name LIKE '%ring%'
""",
    "filter_null_rejecting": """
SELECT o_orderkey, status
FROM (SELECT o_orderkey, o_orderpriority,
             CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderstatus END AS status FROM orders)
WHERE status <> 'F' AND NOT (o_orderpriority IN ('1-URGENT'))
""",
    "filter_code_eq": f"""
SELECT o_orderkey, cod_evolucao
FROM (SELECT o_orderkey, trim(substr(o_orderpriority, 1, 1)) AS cod_evolucao FROM orders)
WHERE {INT("cod_evolucao")} = 2
""",
    "project_select": """
SELECT c_custkey AS cod_cliente, trim(c_name) AS desc_cliente, c_nationkey, c_mktsegment AS segmento FROM customer
""",
    "yearly_align": """
SELECT o_orderkey, o_orderstatus,
       CASE WHEN o_orderdate < TIMESTAMP '1997-01-01 00:00:00' THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       CAST(year(o_orderdate) AS VARCHAR) AS ano
FROM orders
""",
    "csv_scan": """
SELECT s_suppkey, trim(s_name) AS s_name, s_nationkey, s_acctbal FROM supplier
""",
    "csv_glob_scan": """
SELECT c_custkey, trim(c_name) AS c_name, c_nationkey, c_acctbal, trim(c_mktsegment) AS c_mktsegment FROM customer
""",
    "csv_preamble_scan": f"""
WITH c AS (
  SELECT CASE WHEN l_returnflag = 'A' THEN 'Homens' WHEN l_returnflag = 'R' THEN 'Mulheres' ELSE 'Total' END AS Sexo,
         CAST(l_suppkey + 280000 AS VARCHAR) || '1' AS Cod,
         CASE WHEN q = 1 THEN '1 ano'
              WHEN l_linenumber = 7 THEN CAST(q AS VARCHAR) || ' a ' || CAST(q + 4 AS VARCHAR) || ' anos'
              WHEN q = 50 THEN '100 anos ou mais'
              ELSE CAST(q AS VARCHAR) || ' anos' END AS Idade,
         CASE WHEN l_linenumber = 6 THEN '-' ELSE CAST(l_linenumber AS VARCHAR) END AS Qtd
  FROM (SELECT *, CAST(trunc(l_quantity) AS INTEGER) AS q FROM lineitem)),
g AS (
  SELECT CASE WHEN upper(trim(Sexo)) = 'HOMENS' THEN 'M' WHEN upper(trim(Sexo)) = 'MULHERES' THEN 'F' ELSE 'N' END AS cod_sexo,
         {INT("substr(trim(Cod), 1, 6)")} AS cod_municipio_paciente,
         CASE WHEN trim({STRIP}) LIKE '% m%' THEN 0 ELSE {INT(f"trim({STRIP})")} END AS a,
         {INT("Qtd")} AS qtd
  FROM c WHERE NOT (trim(Qtd) IN ('-', '', ' ')) AND trim(Idade) LIKE '%ano%')
SELECT * FROM (
  SELECT cod_sexo, cod_municipio_paciente, a + 9 AS cod_idade, CAST(SUM(qtd) AS BIGINT) AS qtd_populacao
  FROM g GROUP BY cod_sexo, cod_municipio_paciente, a)
WHERE cod_idade BETWEEN 10 AND 110 AND cod_sexo IN ('F', 'M')
""",
    "csv_part_token": """
SELECT o_orderkey, o_orderstatus, o_orderstatus AS parte FROM orders
""",
    "parquet_roundtrip": FACT_COUNT,
    "partitioned_roundtrip": """
SELECT o_orderkey, o_orderstatus, lpad(CAST(month(o_orderdate) AS VARCHAR), 5, '0') AS parte FROM orders
""",
    "row_count": """
SELECT COUNT(*) AS registros FROM lineitem
""",
    "write_counted": """
SELECT COUNT(*) AS gravados, COUNT(*) AS contados FROM events WHERE event_type IN ('click', 'view')
""",
    "yearly_fill": """
SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1997-01-01 00:00:00' THEN o_orderstatus ELSE '0' END AS o_orderstatus,
       CASE WHEN o_orderdate < TIMESTAMP '1997-01-01 00:00:00' THEN '0' ELSE o_orderpriority END AS o_orderpriority,
       CAST(year(o_orderdate) AS VARCHAR) AS ano
FROM orders
""",
}


# ------------------------------------- star schema on raw-layout text ------

VACC_TEXT = """
SELECT CAST(l_orderkey AS VARCHAR) AS document_id,
       CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linestatus = 'O' THEN ' novo pni ' ELSE 'esus ab' END AS sistema_origem,
       CASE WHEN l_linenumber <= 2 THEN '1a Dose' WHEN l_linenumber <= 4 THEN ' 2a Dose '
            WHEN l_linenumber <= 6 THEN 'Reforco' END AS vacina_descricao_dose,
       CAST(l_suppkey AS VARCHAR) AS estabelecimento_valor,
       CAST(l_linenumber AS VARCHAR) AS vacina_grupoAtendimento_codigo,
       CASE WHEN l_linestatus = 'O' THEN '2' ELSE 'x' END AS vacina_categoria_codigo,
       CAST(l_partkey AS VARCHAR) AS vacina_codigo,
       CAST(l_orderkey AS VARCHAR) AS paciente_id,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE '0' || CAST(l_linenumber AS VARCHAR) END AS paciente_racaCor_codigo,
       CAST(CAST(trunc(l_quantity) AS INTEGER) * 3 AS VARCHAR) AS paciente_idade,
       CASE WHEN l_returnflag = 'A' THEN 'F' WHEN l_returnflag = 'R' THEN 'M'
            WHEN l_linestatus = 'O' THEN 'F' ELSE 'I' END AS paciente_enumSexoBiologico,
       CASE WHEN l_linenumber = 1 THEN 'None' ELSE CAST(l_suppkey + 280000 AS VARCHAR) END AS paciente_endereco_coIbgeMunicipio,
       CASE WHEN l_linenumber = 2 THEN NULL ELSE CAST(l_suppkey + 280000 AS VARCHAR) END AS estabelecimento_municipio_codigo,
       CASE WHEN l_linenumber = 3 AND l_linestatus = 'F' THEN 'xx'
            ELSE strftime(CAST(l_shipdate AS DATE) + INTERVAL 300 MONTH, '%Y-%m-%d') END AS vacina_dataAplicacao,
       CASE WHEN l_discount > 0.08 THEN 'BA' ELSE 'SE' END AS paciente_endereco_uf,
       CASE WHEN l_tax > 0.07 THEN 'BA' WHEN l_tax = 0 THEN '-' ELSE 'SE' END AS estabelecimento_uf,
       CASE WHEN l_linenumber = 5 THEN '1950-02-30'
            ELSE CAST(CAST(trunc(l_quantity) AS INTEGER) + 1900 AS VARCHAR) || '-01-15' END AS paciente_dataNascimento,
       CASE WHEN l_linenumber = 4 THEN NULL ELSE ' 49' || lpad(CAST(l_suppkey AS VARCHAR), 3, '0') END AS paciente_endereco_cep,
       'Estab ' || CAST(l_suppkey AS VARCHAR) AS estabelecimento_razaoSocial,
       CASE WHEN l_linestatus = 'O' THEN NULL ELSE 'Fantasia ' || CAST(l_suppkey AS VARCHAR) END AS estalecimento_noFantasia,
       CASE WHEN l_linenumber = 6 THEN NULL ELSE 'Vacina ' || CAST(l_partkey AS VARCHAR) END AS vacina_nome,
       'Fab' AS vacina_fabricante_nome,
       'Grupo ' || CAST(l_linenumber AS VARCHAR) AS vacina_grupoAtendimento_nome,
       CASE WHEN l_linestatus = 'O' THEN 'Cat 2' END AS vacina_categoria_nome,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE 'Raca ' || CAST(l_linenumber AS VARCHAR) END AS paciente_racaCor_valor
FROM lineitem
"""

_SEX1 = "substr(trim(paciente_enumSexoBiologico), 1, 1)"

VACC_CONF = f"""
SELECT *,
       COALESCE(substr(upper(trim(sistema_origem)), 1, 3), '0') AS cod_sistema_origem,
       COALESCE(sha256(trim(vacina_descricao_dose)), '0') AS cod_dose,
       COALESCE({INT("estabelecimento_valor")}, 0) AS cod_estabelecimento,
       COALESCE({INT("vacina_grupoAtendimento_codigo")}, 0) AS cod_grupo,
       COALESCE({INT("vacina_categoria_codigo")}, 0) AS cod_categoria,
       COALESCE({INT("vacina_codigo")}, 0) AS cod_vacina,
       COALESCE(trim(paciente_id), '0') AS cod_paciente,
       COALESCE({INT("paciente_racaCor_codigo")}, 99) AS cod_raca,
       COALESCE({INT("paciente_idade")}, 999) AS cod_idade,
       CASE WHEN {_SEX1} IS NULL OR {_SEX1} = 'I' THEN 'N' ELSE {_SEX1} END AS cod_sexo,
       COALESCE({INT("COALESCE(replace(trim(paciente_endereco_coIbgeMunicipio), 'None', '0'), '0')")}, 0) AS cod_municipio_paciente,
       COALESCE({INT("COALESCE(replace(trim(estabelecimento_municipio_codigo), 'None', '0'), '0')")}, 0) AS cod_municipio_estab,
       CAST(try_strptime(trim(vacina_dataAplicacao), '%Y-%m-%d') AS DATE) AS data_aplicacao
FROM ({VACC_TEXT})
"""

SUP_LOC = """
SELECT CAST(s.s_suppkey + 280000 AS VARCHAR) || '1' AS CD_GEOCODDS, s.s_name AS NM_MUNICIPIO, ' ' || r.r_name AS NM_UF,
       replace(printf('%.2f', s.s_acctbal), '.', ',') AS LAT,
       replace(printf('%.2f', -s.s_acctbal), '.', ',') AS LONG
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""

SUP_LOOKUP = f"""
SELECT cod_municipio, desc_municipio, desc_uf, MAX(latitude) AS latitude, MAX(longitude) AS longitude
FROM (SELECT {INT("substr(trim(CD_GEOCODDS), 1, 6)")} AS cod_municipio,
             trim(NM_MUNICIPIO) AS desc_municipio, trim(NM_UF) AS desc_uf,
             {FLOAT("replace(trim(LAT), ',', '.')")} AS latitude,
             {FLOAT("replace(trim(LONG), ',', '.')")} AS longitude
      FROM ({SUP_LOC})) WHERE desc_uf = 'AMERICA'
GROUP BY cod_municipio, desc_municipio, desc_uf
"""


def _srag_text(with_vaccine: bool, where: str) -> str:
    day = "strftime(l_shipdate, '%d/%m/%Y')"
    vac = (", CASE WHEN l_tax = 0 THEN '1' ELSE '2' END AS VACINA_COV,"
           " CASE WHEN l_linenumber = 1 THEN 'x' END AS DOSE_1_COV,"
           " CASE WHEN l_returnflag = 'R' THEN ' ' END AS DOSE_2_COV" if with_vaccine else
           ", NULL AS VACINA_COV, NULL AS DOSE_1_COV, NULL AS DOSE_2_COV")
    return f"""
SELECT CASE WHEN l_linenumber = 7 THEN '4' WHEN l_linestatus = 'O' THEN '5' ELSE ' 5 ' END AS CLASSI_FIN,
       CASE WHEN l_linenumber = 6 THEN NULL WHEN l_returnflag = 'A' THEN '1' ELSE '2' END AS EVOLUCAO,
       CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_linestatus = 'O' THEN 'S' ELSE 'N' END AS FATOR_RISC,
       CAST(CAST(trunc(l_quantity) AS INTEGER) * 3 AS VARCHAR) AS NU_IDADE_N,
       CAST(l_suppkey + 280000 AS VARCHAR) AS CO_MUN_NOT,
       CASE WHEN l_discount > 0.08 THEN 'BA' ELSE ' SE ' END AS SG_UF,
       CASE WHEN l_linenumber = 5 THEN NULL ELSE CAST(l_suppkey + 280000 AS VARCHAR) END AS CO_MUN_RES,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_linenumber AS VARCHAR) END AS CS_RACA,
       CASE WHEN l_linenumber IN (1, 3, 5) THEN 'F' WHEN l_linenumber IN (2, 4, 6) THEN 'M' ELSE 'I' END AS CS_SEXO,
       CASE WHEN l_linestatus = 'O' THEN '1' ELSE '2' END AS HOSPITAL,
       CASE WHEN l_returnflag = 'R' THEN '1' END AS UTI,
       CASE WHEN l_linenumber = 4 THEN {day} END AS DT_DOSEUNI,
       CASE WHEN l_linenumber = 3 THEN {day} END AS DT_1_DOSE,
       CASE WHEN l_linenumber = 2 THEN {day} END AS DT_2_DOSE,
       {day} AS DT_DIGITA, {day} AS DT_NOTIFIC {vac}
FROM lineitem WHERE {where}
"""


CENSUS = """
SELECT CASE WHEN l_returnflag = 'A' THEN 'Homens' WHEN l_returnflag = 'R' THEN 'Mulheres' ELSE 'Total' END AS Sexo, l_linestatus,
       CAST(l_suppkey + 280000 AS VARCHAR) || '1' AS Cod,
       CASE WHEN q = 1 THEN '1 ano'
            WHEN l_linenumber = 7 THEN CAST(q AS VARCHAR) || ' a ' || CAST(q + 4 AS VARCHAR) || ' anos'
            WHEN q = 50 THEN '100 anos ou mais'
            ELSE CAST(q AS VARCHAR) || ' anos' END AS Idade,
       CASE WHEN l_linenumber = 6 THEN '-' ELSE CAST(l_linenumber AS VARCHAR) END AS Qtd
FROM (SELECT *, CAST(trunc(l_quantity) AS INTEGER) AS q FROM lineitem)
"""

SRAG_CASES = f"""
SELECT * FROM (
  {_srag_text(False, "l_shipdate < TIMESTAMP '1998-01-01 00:00:00'")}
  UNION ALL BY NAME
  {_srag_text(True, "l_shipdate >= TIMESTAMP '1998-01-01 00:00:00'")})
WHERE trim(SG_UF) = 'SE' AND trim(CLASSI_FIN) = '5'
"""


def _present(c: str) -> str:
    return f"trim({c}) IS NOT NULL"


SRAG_CONF = f"""
SELECT COALESCE(trim(CLASSI_FIN), '0') AS cod_class_final,
       COALESCE(trim(EVOLUCAO), '9') AS cod_evolucao,
       CASE WHEN trim(FATOR_RISC) IS NULL THEN '9' WHEN trim(FATOR_RISC) = 'S' THEN '1'
            WHEN trim(FATOR_RISC) = 'N' THEN '2' ELSE trim(FATOR_RISC) END AS cod_risco,
       {INT("COALESCE(trim(NU_IDADE_N), '0')")} AS cod_idade,
       {INT("COALESCE(trim(CO_MUN_NOT), '0')")} AS cod_municipio_estab,
       {INT("COALESCE(trim(CO_MUN_RES), '0')")} AS cod_municipio_paciente,
       trim(SG_UF) AS cod_uf_paciente,
       CASE WHEN rc IS NULL THEN 99 WHEN rc = 6 THEN 3 WHEN rc = 3 THEN 4 WHEN rc = 9 THEN 99 ELSE rc END AS cod_raca,
       CASE WHEN trim(CS_SEXO) IS NULL OR trim(CS_SEXO) = 'I' THEN 'N' ELSE trim(CS_SEXO) END AS cod_sexo,
       COALESCE({INT("HOSPITAL")}, 9) AS cod_internacao,
       COALESCE({INT("UTI")}, 9) AS cod_uti,
       COALESCE({INT("VACINA_COV")}, 9) AS cod_vacinado,
       CASE WHEN {_present("DOSE_1_COV")} THEN 1 WHEN {_present("DOSE_2_COV")} THEN 2
            WHEN {_present("DT_DOSEUNI")} THEN 1 WHEN {_present("DT_1_DOSE")} THEN 1
            WHEN {_present("DT_2_DOSE")} THEN 2 ELSE 0 END AS cod_doses,
       CAST(try_strptime(DT_DIGITA, '%d/%m/%Y') AS DATE) AS dat_encerramento,
       CAST(try_strptime(DT_NOTIFIC, '%d/%m/%Y') AS DATE) AS dat_notificacao,
       CAST(try_strptime(DT_NOTIFIC, '%d/%m/%Y') AS DATE) AS data
FROM (SELECT *, {INT("replace(trim(CS_RACA), '4', '6')")} AS rc FROM ({SRAG_CASES}))
"""

SRAG_YEARS = SRAG_CONF.replace(SRAG_CASES, f"""
SELECT * FROM (
  {_srag_text(False, "year(l_shipdate) = 1995")}
  UNION ALL BY NAME
  {_srag_text(True, "year(l_shipdate) = 1997")})
WHERE trim(SG_UF) = 'SE' AND trim(CLASSI_FIN) = '5'
""")

NOTIF_TEXT = """
SELECT CASE WHEN o_orderstatus = 'F' THEN ' Confirmado ' WHEN o_orderstatus = 'O' THEN 'Descartado' END AS classificacaoFinal,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'Obito' ELSE 'Cura' END AS evolucaoCaso,
       CASE WHEN o_totalprice >= 100000 THEN 'Diabetes' END AS condicoes,
       CAST(dayofmonth(o_orderdate) * 4 AS VARCHAR) AS idade,
       CAST(o_custkey + 2800000 AS VARCHAR) AS municipioNotificacaoIBGE, 'parda' AS racaCor,
       CASE WHEN o_orderstatus = 'F' THEN '1' ELSE 'x' END AS codigoRecebeuVacina,
       CASE WHEN o_orderstatus = 'F' THEN '1, 2' WHEN o_orderstatus = 'O' THEN '9,10' END AS codigoDosesVacina,
       strftime(CAST(o_orderdate AS DATE) + 10, '%Y-%m-%d') AS dataEncerramento,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'SE'
            WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN NULL
            ELSE CAST(o_custkey + 2800000 AS VARCHAR) END AS municipioIBGE,
       CASE WHEN o_orderstatus = 'P' THEN 'BA' ELSE ' SE ' END AS estadoIBGE,
       CASE WHEN o_orderpriority IN ('1-URGENT', '3-MEDIUM') THEN 'Feminino'
            WHEN o_orderpriority = '2-HIGH' THEN ' masculino' END AS sexo,
       strftime(o_orderdate, '%Y-%m-%d') AS dataNotificacao
FROM orders
"""

NOTIF_CONF = f"""
SELECT COALESCE(sha256(classificacaoFinal), '0') AS cod_class_final, upper(trim(classificacaoFinal)) AS des_class_final,
       COALESCE(sha256(evolucaoCaso), '0') AS cod_evolucao, upper(trim(evolucaoCaso)) AS des_evolucao,
       COALESCE(sha256(condicoes), '0') AS cod_condicoes, upper(trim(condicoes)) AS des_condicoes,
       COALESCE({INT("idade")}, 0) AS cod_idade,
       COALESCE(substr(trim(municipioNotificacaoIBGE), 1, 6), '0') AS cod_municipio_estab,
       COALESCE({INT("substr(trim(municipioIBGE), 1, 6)")}, 0) AS cod_municipio_paciente,
       trim(estadoIBGE) AS estado, upper(trim(racaCor)) AS des_raca,
       COALESCE(CASE WHEN sexo IS NULL THEN 'N' ELSE substr(upper(trim(sexo)), 1, 1) END, 'N') AS cod_sexo,
       COALESCE({INT("codigoRecebeuVacina")}, 0) AS cod_vacinado,
       COALESCE(list_max(string_split(trim(codigoDosesVacina), ',')), '0') AS cod_doses,
       CAST(try_strptime(dataEncerramento, '%Y-%m-%d') AS DATE) AS dat_encerramento,
       CAST(try_strptime(dataNotificacao, '%Y-%m-%d') AS DATE) AS dat_notificacao,
       CAST(try_strptime(dataNotificacao, '%Y-%m-%d') AS DATE) AS data
FROM ({NOTIF_TEXT}) WHERE substr(trim(municipioIBGE), 1, 6) <> 'SE'
"""

NOTIF_FACT = f"""
SELECT cod_idade, cod_municipio_paciente, cod_sexo, data, CAST(COUNT(*) AS REAL) AS qtd_notificacao
FROM (SELECT COALESCE({INT("idade")}, 0) AS cod_idade,
             COALESCE({INT("substr(trim(municipioIBGE), 1, 6)")}, 0) AS cod_municipio_paciente,
             trim(estadoIBGE) AS estado,
             COALESCE(CASE WHEN sexo IS NULL THEN 'N' ELSE substr(upper(trim(sexo)), 1, 1) END, 'N') AS cod_sexo,
             CAST(try_strptime(dataNotificacao, '%Y-%m-%d') AS DATE) AS data
      FROM ({NOTIF_TEXT}) WHERE substr(trim(municipioIBGE), 1, 6) <> 'SE')
WHERE estado = 'SE' AND cod_sexo IN ('M', 'F') AND cod_idade BETWEEN 10 AND 110
GROUP BY 1, 2, 3, 4
"""


def _dim(cols: str, where: str) -> str:
    return f"SELECT DISTINCT {cols} FROM ({VACC_CONF}) WHERE {where}"


ORACLE.update({
    "star_vaccination_fact": f"""
SELECT cod_sistema_origem, cod_estabelecimento, cod_grupo, cod_categoria, cod_vacina, cod_paciente, cod_dose,
       cod_raca, cod_sexo, cod_idade, cod_municipio_estab, cod_municipio_paciente, data_aplicacao AS data,
       COUNT(DISTINCT document_id) AS Qtd_Vacinas_Aplicadas
FROM ({VACC_CONF})
WHERE paciente_endereco_uf = 'SE' AND cod_sexo IN ('F', 'M') AND cod_idade BETWEEN 10 AND 110
  AND cod_dose <> '0' AND data_aplicacao >= DATE '2021-01-19'
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13
""",
    "star_dm_sistemas": _dim("cod_sistema_origem, upper(sistema_origem) AS sistema_origem", "sistema_origem IS NOT NULL"),
    "star_dm_doses": _dim("cod_dose, upper(vacina_descricao_dose) AS desc_dose", "vacina_descricao_dose IS NOT NULL"),
    "star_dm_sexo": f"""
SELECT * FROM ({_dim("cod_sexo, CASE WHEN cod_sexo = 'F' THEN 'FEMININO' WHEN cod_sexo = 'M' THEN 'MASCULINO' "
                     "ELSE 'SEM INFORMACAO' END AS des_sexo", "TRUE")}) WHERE cod_sexo IN ('F', 'M')
""",
    "star_dm_paciente": _dim("cod_paciente, CAST(try_strptime(paciente_dataNascimento, '%Y-%m-%d') AS DATE) AS data_nascimento, "
                             "COALESCE(trim(paciente_endereco_cep), '0') AS cep", "cod_paciente IS NOT NULL"),
    "star_dm_estabelecimento": _dim("cod_estabelecimento, COALESCE(estabelecimento_razaoSocial, 'SEM INFORMACAO') AS razao_social, "
                                    "COALESCE(estalecimento_noFantasia, 'SEM INFORMACAO') AS nome_fantasia",
                                    "cod_estabelecimento IS NOT NULL"),
    "star_dm_vacina": _dim("cod_vacina, COALESCE(vacina_nome, 'SEM INFORMACAO') AS nome_vacina, "
                           "COALESCE(vacina_fabricante_nome, 'SEM INFORMACAO') AS nome_fabricante", "cod_vacina IS NOT NULL"),
    "star_dm_grupo": _dim("cod_grupo, COALESCE(vacina_grupoAtendimento_nome, 'SEM INFORMACAO') AS desc_grupo",
                          "cod_grupo IS NOT NULL"),
    "star_dm_categoria": _dim("cod_categoria, COALESCE(vacina_categoria_nome, 'SEM INFORMACAO') AS desc_categoria",
                              "cod_categoria IS NOT NULL"),
    "star_dm_raca": _dim("cod_raca, COALESCE(paciente_racaCor_valor, 'SEM INFORMACAO') AS desc_raca", "cod_raca IS NOT NULL"),
    "star_dm_regiao_estab": f"""
SELECT DISTINCT a.cod_municipio_estab,
       CASE WHEN a.cod_municipio_estab = 0 THEN '-' ELSE c.desc_municipio END AS desc_municipio_estab,
       CASE WHEN a.cod_municipio_estab = 0 THEN '-' ELSE c.desc_uf END AS desc_uf_estab,
       c.latitude, c.longitude
FROM ({VACC_CONF}) a JOIN ({SUP_LOOKUP}) c ON a.cod_municipio_estab = c.cod_municipio
WHERE a.cod_municipio_estab IS NOT NULL AND a.estabelecimento_uf IN ('SE', '-')
""",
    "star_dm_regiao_paciente": f"""
SELECT DISTINCT a.cod_municipio_paciente,
       CASE WHEN a.cod_municipio_paciente = 0 THEN 'SEM INFORMACAO' ELSE c.desc_municipio END AS desc_municipio,
       CASE WHEN a.cod_municipio_paciente = 0 THEN '-' ELSE c.desc_uf END AS desc_uf,
       CASE WHEN a.cod_municipio_paciente = 0 THEN '-' ELSE 'Brasil' END AS desc_pais,
       c.latitude, c.longitude
FROM ({VACC_CONF}) a JOIN ({SUP_LOOKUP}) c ON a.cod_municipio_paciente = c.cod_municipio
WHERE a.cod_municipio_paciente IS NOT NULL AND a.paciente_endereco_uf IN ('SE', '-')
""",
    "star_srag_conformed": SRAG_CONF,
    "star_deaths_fact": f"""
SELECT cod_idade, cod_municipio_paciente, cod_sexo, data, CAST(COUNT(*) AS REAL) AS qtd_obito
FROM ({SRAG_CONF})
WHERE {INT("cod_evolucao")} = 2 AND cod_idade BETWEEN 10 AND 110 AND cod_sexo IN ('F', 'M') AND cod_uf_paciente = 'SE'
GROUP BY 1, 2, 3, 4
""",
    "star_notification_fact": NOTIF_FACT,
    "star_notification_conformed": NOTIF_CONF,
    "srag_year_selection": f"""
SELECT CAST(year(data) AS VARCHAR) AS ano, cod_idade, cod_doses, cod_vacinado, data FROM ({SRAG_YEARS})
""",
    "star_census_conformed": f"""
SELECT 'Urbana' AS situacao_domicilio, upper(trim(Sexo)) AS desc_sexo, l_linestatus AS cor_raca,
       {INT("substr(trim(Cod), 1, 6)")} AS cod_municipio_paciente, a AS cod_idade,
       CASE WHEN a = 0 THEN 'Meses Idade' ELSE trim({STRIP}) END AS desc_idade, {INT("Qtd")} AS qtd
FROM (SELECT *, CASE WHEN trim({STRIP}) LIKE '% m%' THEN 0 ELSE {INT(f"trim({STRIP})")} END AS a FROM ({CENSUS}))
WHERE NOT (trim(Qtd) IN ('-', '', ' ')) AND trim(Idade) LIKE '%ano%'
""",
    "stream_ingest": f"""
SELECT document_id, cod_sistema_origem, cod_estabelecimento, cod_grupo, cod_categoria, cod_vacina, cod_paciente,
       cod_dose, cod_raca, cod_sexo, cod_idade, cod_municipio_estab, cod_municipio_paciente, data_aplicacao
FROM ({VACC_CONF})
""",
})

ORACLE["ingest_incremental"] = ORACLE["stream_ingest"]
ORACLE["star_vaccination_jobs"] = ORACLE["star_vaccination_fact"]
ORACLE["star_deaths_jobs"] = ORACLE["star_deaths_fact"]
ORACLE["star_notification_jobs"] = ORACLE["star_notification_fact"]

_TABLES = {
    "fato_vacinas": "star_vaccination_fact", "dm_sistemas": "star_dm_sistemas", "dm_doses": "star_dm_doses",
    "dm_sexo": "star_dm_sexo", "dm_paciente": "star_dm_paciente", "dm_estabelecimento": "star_dm_estabelecimento",
    "dm_vacina": "star_dm_vacina", "dm_grupo": "star_dm_grupo", "dm_categoria": "star_dm_categoria",
    "dm_raca": "star_dm_raca", "dm_regiao_estab": "star_dm_regiao_estab", "dm_regiao_paciente": "star_dm_regiao_paciente",
}


#: The columns of each table, sorted by name; numbers with a fraction as two digits.
_TABLE_COLUMNS = {
    "fato_vacinas": "Qtd_Vacinas_Aplicadas cod_categoria cod_dose cod_estabelecimento cod_grupo cod_idade cod_municipio_estab "
                    "cod_municipio_paciente cod_paciente cod_raca cod_sexo cod_sistema_origem cod_vacina data",
    "dm_sistemas": "cod_sistema_origem sistema_origem", "dm_doses": "cod_dose desc_dose", "dm_sexo": "cod_sexo des_sexo",
    "dm_paciente": "cep cod_paciente data_nascimento", "dm_estabelecimento": "cod_estabelecimento nome_fantasia razao_social",
    "dm_vacina": "cod_vacina nome_fabricante nome_vacina", "dm_grupo": "cod_grupo desc_grupo",
    "dm_categoria": "cod_categoria desc_categoria", "dm_raca": "cod_raca desc_raca",
    "dm_regiao_estab": "cod_municipio_estab desc_municipio_estab desc_uf_estab latitude longitude",
    "dm_regiao_paciente": "cod_municipio_paciente desc_municipio desc_pais desc_uf latitude longitude",
}


def _digest(t: str, sql: str) -> str:
    text = [f"CAST({c} AS DECIMAL(12,2))" if c in ("latitude", "longitude") else c for c in _TABLE_COLUMNS[t].split()]
    row = "concat_ws('|', " + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '~')" for c in text) + ")"
    return (f"SELECT '{t}' AS tabela, COUNT(*) AS linhas, "
            f"CAST(SUM(CAST('0x' || substr(md5({row}), 1, 8) AS BIGINT)) AS BIGINT) AS conteudo FROM ({sql})")


ORACLE["star_vaccination_tables"] = "\nUNION ALL\n".join(_digest(t, ORACLE[k]) for t, k in _TABLES.items())

ORACLE["sql_projection"] = f"""
SELECT *, CASE WHEN cod_idade < 60 THEN 'adulto' ELSE 'idoso' END AS faixa FROM ({FACT_COUNT})
"""

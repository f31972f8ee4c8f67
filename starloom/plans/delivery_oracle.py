"""DuckDB statements for :mod:`starloom.plans.delivery_queries`."""

from __future__ import annotations

from .oracle import FLOAT, INT, ORACLE, SUP_LOC, VACC_CONF

_PLACED = f"""
SELECT *, CASE WHEN n <= 3 THEN 'jan' WHEN n <= 5 THEN 'feb' ELSE 'mar' END AS pasta
FROM (SELECT *, CAST(vacina_grupoAtendimento_codigo AS INTEGER) AS n FROM ({VACC_CONF}))
"""


def _unread(column: str, value: str) -> str:
    return (f"SELECT pasta, '{column}' AS coluna, {column} AS texto FROM ({_PLACED}) "
            f"WHERE {column} IS NOT NULL AND trim({column}) <> '' AND ({value}) IS NULL")


def _municipality(c: str) -> str:
    return INT(f"COALESCE(replace(trim({c}), 'None', '0'), '0')")


def _day(c: str) -> str:
    return f"try_strptime(trim({c}), '%Y-%m-%d')"


_READ = {
    **{c: INT(c) for c in ("estabelecimento_valor", "vacina_grupoAtendimento_codigo", "vacina_categoria_codigo", "vacina_codigo",
                           "paciente_racaCor_codigo", "paciente_idade")},
    **{c: _municipality(c) for c in ("paciente_endereco_coIbgeMunicipio", "estabelecimento_municipio_codigo")},
    **{c: _day(c) for c in ("vacina_dataAplicacao", "paciente_dataNascimento")},
}

_NAMES = f"""
SELECT cod_estabelecimento, COALESCE(estabelecimento_razaoSocial, 'SEM INFORMACAO') AS razao_social,
       COALESCE(estalecimento_noFantasia, 'SEM INFORMACAO') AS nome_fantasia, COUNT(*) AS n
FROM ({VACC_CONF}) GROUP BY 1, 2, 3
"""

_EVERY_LOCALITY = f"""
SELECT * FROM ({SUP_LOC})
UNION ALL SELECT * FROM ({SUP_LOC}) WHERE CAST(substr(CD_GEOCODDS, 6, 1) AS INTEGER) % 2 = 0
UNION ALL SELECT CD_GEOCODDS, 'Antigo ' || NM_MUNICIPIO, NM_UF, '99,5', LONG FROM ({SUP_LOC})
"""

_LOCATED = f"""
SELECT {INT("substr(trim(CD_GEOCODDS), 1, 6)")} AS cod_municipio, trim(NM_MUNICIPIO) AS desc_municipio, trim(NM_UF) AS desc_uf,
       {FLOAT("replace(trim(LAT), ',', '.')")} AS latitude, {FLOAT("replace(trim(LONG), ',', '.')")} AS longitude
FROM ({_EVERY_LOCALITY}) WHERE trim(NM_UF) = 'AMERICA'
"""

DELIVERY_ORACLE: dict[str, str] = {
    "ingest_delivery": ORACLE["stream_ingest"],
    "delivery_ledger": f"SELECT pasta, '01' AS parte, COUNT(*) AS linhas FROM ({_PLACED}) GROUP BY pasta",
    "rejects_account": f"""
SELECT pasta, coluna, COUNT(*) AS valores, MIN(texto) AS exemplo
FROM ({' UNION ALL '.join(_unread(c, v) for c, v in _READ.items())}) GROUP BY pasta, coluna
""",
    "fact_count_continued": f"""
SELECT cod_idade, cod_municipio_paciente, cod_sexo, data_aplicacao AS data, CAST(COUNT(*) AS FLOAT) AS qtd_linhas
FROM ({VACC_CONF}) WHERE cod_sexo IN ('F', 'M') GROUP BY 1, 2, 3, 4
""",
    "fact_sum_continued": f"""
SELECT cod_sexo, cod_municipio_estab, raca + 9 AS cod_raca, CAST(SUM(cod_idade) AS BIGINT) AS soma_idade
FROM (SELECT *, cod_raca AS raca FROM ({VACC_CONF})) GROUP BY cod_sexo, cod_municipio_estab, raca HAVING raca + 9 BETWEEN 10 AND 110
""",
    "fact_distinct_continued": f"""
SELECT cod_municipio_estab, cod_sexo, COUNT(DISTINCT document_id) AS qtd_documentos
FROM ({VACC_CONF}) WHERE paciente_endereco_uf = 'SE' GROUP BY 1, 2
""",
    "star_vaccination_continued": ORACLE["star_vaccination_fact"],
    "dim_one_name": f"""
SELECT cod_estabelecimento, razao_social, nome_fantasia
FROM (SELECT *, row_number() OVER (PARTITION BY cod_estabelecimento ORDER BY n DESC, razao_social, nome_fantasia) AS nth FROM ({_NAMES}))
WHERE nth = 1
""",
    "dim_name_conflicts": f"""
SELECT cod_estabelecimento, COUNT(*) AS variantes, CAST(SUM(n) AS BIGINT) AS linhas, CAST(SUM(n) - MAX(n) AS BIGINT) AS linhas_outras
FROM ({_NAMES}) GROUP BY cod_estabelecimento HAVING COUNT(*) > 1
""",
    "dim_geo_one_name": f"""
WITH l AS ({_LOCATED}), c AS (SELECT cod_municipio, desc_municipio, desc_uf, COUNT(*) AS n FROM l GROUP BY 1, 2, 3),
m AS (SELECT cod_municipio, MAX(latitude) AS latitude, MAX(longitude) AS longitude FROM l GROUP BY 1)
SELECT cod_municipio, desc_municipio, desc_uf, latitude, longitude
FROM (SELECT *, row_number() OVER (PARTITION BY cod_municipio ORDER BY n DESC, desc_municipio, desc_uf) AS nth FROM c) JOIN m USING (cod_municipio)
WHERE nth = 1
""",
    "replaced_roundtrip": "SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS VARCHAR) AS ano FROM orders",
}

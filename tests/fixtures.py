"""Small raw extracts in the source layouts (FIXTURES.md part A), written by
the tests into a fresh folder. Empty fields are read by Spark as NULL."""

from __future__ import annotations

import os

VACC_COLUMNS = [
    "document_id", "sistema_origem", "vacina_descricao_dose", "estabelecimento_valor",
    "vacina_grupoAtendimento_codigo", "vacina_categoria_codigo", "vacina_codigo", "paciente_id",
    "paciente_racaCor_codigo", "paciente_idade", "paciente_enumSexoBiologico",
    "paciente_endereco_coIbgeMunicipio", "estabelecimento_municipio_codigo", "vacina_dataAplicacao",
    "paciente_endereco_uf", "estabelecimento_uf", "paciente_dataNascimento", "paciente_endereco_cep",
    "estabelecimento_razaoSocial", "estalecimento_noFantasia", "vacina_nome", "vacina_fabricante_nome",
    "vacina_grupoAtendimento_nome", "vacina_categoria_nome", "paciente_racaCor_valor",
]

_BASE = dict(
    document_id="d1", sistema_origem=" novo pni ", vacina_descricao_dose="1a Dose", estabelecimento_valor="123",
    vacina_grupoAtendimento_codigo="201", vacina_categoria_codigo="2", vacina_codigo="86", paciente_id="p1",
    paciente_racaCor_codigo="01", paciente_idade="45", paciente_enumSexoBiologico="F",
    paciente_endereco_coIbgeMunicipio="280030", estabelecimento_municipio_codigo="280030",
    vacina_dataAplicacao="2021-01-20", paciente_endereco_uf="SE", estabelecimento_uf="SE",
    paciente_dataNascimento="1976-01-01", paciente_endereco_cep="49000", estabelecimento_razaoSocial="Hosp A",
    estalecimento_noFantasia="", vacina_nome="Coronavac", vacina_fabricante_nome="Sinovac",
    vacina_grupoAtendimento_nome="Idosos", vacina_categoria_nome="Faixa Etaria", paciente_racaCor_valor="BRANCA",
)


def vaccination_rows():
    """(file part, row) pairs. Comments give the row's fate in the fact."""
    v = lambda **kw: {**_BASE, **kw}
    part1 = [
        v(),                                                     # group A
        v(),                                                     # same document again
        v(document_id="d2"),                                     # group A, 2nd document
        v(document_id="d3", paciente_enumSexoBiologico="I"),     # sex N -> out
        v(document_id="d4", paciente_idade=""),                  # age 999 -> out
        v(document_id="d5", paciente_idade="9"),                 # age 9 -> out
        v(document_id="d6", paciente_idade="110", vacina_descricao_dose=""),   # dose '0' -> out
        v(document_id="d7", vacina_dataAplicacao="2021-13-45"),  # bad date -> out
        v(document_id="d8", vacina_dataAplicacao="2021-01-18"),  # before first dose -> out
        v(document_id="d9", vacina_dataAplicacao="2021-01-19", paciente_idade=" 10 ",
          paciente_enumSexoBiologico="M", paciente_endereco_coIbgeMunicipio="None",
          estabelecimento_municipio_codigo="", estabelecimento_valor="abc", vacina_codigo="",
          vacina_grupoAtendimento_codigo="", vacina_categoria_codigo="", estabelecimento_uf="-"),  # group B
        v(document_id="d10", paciente_endereco_uf="BA"),         # other state -> out
    ]
    part2 = [
        v(document_id="d11", paciente_idade="111"),              # age 111 -> out
        v(document_id="d12", vacina_dataAplicacao="2021-01-21"),  # group C
        v(document_id="d13", paciente_racaCor_codigo="", sistema_origem="", paciente_idade="10.5",
          paciente_racaCor_valor="", vacina_nome="", paciente_dataNascimento="bad"),  # group D
    ]
    return [("01", r) for r in part1] + [("02", r) for r in part2]


def write_csv(path: str, columns, rows, sep=";", preamble=(), footer=(), header=True):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        for line in preamble:
            f.write(line + "\n")
        if header:
            f.write(sep.join(columns) + "\n")
        for r in rows:
            f.write(sep.join("" if r.get(c) is None else str(r[c]) for c in columns) + "\n")
        for line in footer:
            f.write(line + "\n")


def write_vaccination(base: str) -> str:
    rows = vaccination_rows()
    for part in ("01", "02"):
        write_csv(f"{base}/vacinacao/vacinacao-{part}-2021.csv", VACC_COLUMNS, [r for p, r in rows if p == part])
    return f"{base}/vacinacao/*.csv"


def write_localities(base: str) -> str:
    rows = [
        dict(CD_GEOCODDS="2800308", NM_MUNICIPIO="Aracaju", NM_UF="SERGIPE", LAT="-10,9", LONG="-37,07"),
        dict(CD_GEOCODDS="2800308", NM_MUNICIPIO="Aracaju", NM_UF="SERGIPE", LAT="-10,8", LONG="-37,1"),
        dict(CD_GEOCODDS="2927408", NM_MUNICIPIO="Salvador", NM_UF="BAHIA", LAT="-12,9", LONG="-38,5"),
    ]
    path = f"{base}/aux/localidades.csv"
    write_csv(path, ["CD_GEOCODDS", "NM_MUNICIPIO", "NM_UF", "LAT", "LONG"], rows)
    return path


SRAG_2020 = ["CLASSI_FIN", "EVOLUCAO", "FATOR_RISC", "NU_IDADE_N", "SG_UF_NOT", "CO_MUN_NOT", "SG_UF",
             "CO_MUN_RES", "CS_RACA", "CS_SEXO", "HOSPITAL", "UTI", "DT_DOSEUNI", "DT_1_DOSE", "DT_2_DOSE",
             "DT_DIGITA", "DT_NOTIFIC", "OTHER"]
SRAG_2021 = SRAG_2020[:12] + ["VACINA_COV", "DOSE_1_COV", "DOSE_2_COV"] + SRAG_2020[12:]


def write_srag(base: str) -> dict[int, str]:
    s = dict(CLASSI_FIN="5", EVOLUCAO="2", FATOR_RISC="S", NU_IDADE_N="45", SG_UF_NOT="SE", CO_MUN_NOT="280030",
             SG_UF=" SE ", CO_MUN_RES="280030", CS_RACA="4", CS_SEXO="F", HOSPITAL="1", UTI="2",
             DT_DIGITA="20/03/2020", DT_NOTIFIC="15/03/2020")
    y2020 = [
        s,                                     # death A
        {**s, "CS_SEXO": "I"},                 # sex N -> out of fact
        {**s, "CLASSI_FIN": "4"},              # not COVID -> not ingested
        {**s, "SG_UF": "BA"},                  # other state -> not ingested
        {**s, "EVOLUCAO": "1"},                # recovered -> out of fact
        {**s, "DT_1_DOSE": "01/02/2021"},      # death A again
    ]
    y2021 = [
        {**s, "DT_NOTIFIC": "31/02/2021", "VACINA_COV": "1", "DOSE_2_COV": "x"},   # bad date: NULL day group
        {**s, "DT_NOTIFIC": "10/05/2021", "NU_IDADE_N": "", "FATOR_RISC": ""},      # age 0 -> out
        {**s, "DT_NOTIFIC": "10/05/2021", "CS_RACA": "", "CO_MUN_RES": ""},        # death B (muni 0)
    ]
    p20, p21 = f"{base}/srag/INFLUD20.csv", f"{base}/srag/INFLUD21.csv"
    write_csv(p20, SRAG_2020, y2020)
    write_csv(p21, SRAG_2021, y2021)
    return {2020: p20, 2021: p21}


NOTIF_COLUMNS = ["classificacaoFinal", "evolucaoCaso", "condicoes", "idade", "municipioNotificacaoIBGE",
                 "municipioIBGE", "estadoIBGE", "racaCor", "sexo", "codigoRecebeuVacina", "codigoDosesVacina",
                 "dataEncerramento", "dataNotificacao"]


def write_notifications(base: str) -> str:
    n = dict(classificacaoFinal=" Confirmado ", evolucaoCaso="Cura", condicoes="", idade="30",
             municipioNotificacaoIBGE="2800308", municipioIBGE="2800308", estadoIBGE="SE", racaCor="parda",
             sexo="feminino", codigoRecebeuVacina="1", codigoDosesVacina="1, 2", dataEncerramento="2021-06-01",
             dataNotificacao="2021-05-20")
    rows = [
        n, n,                                                  # group A x2
        {**n, "municipioIBGE": "SE"},                          # dropped (municipality is the state)
        {**n, "municipioIBGE": ""},                            # dropped (NULL rejected by <>)
        {**n, "municipioIBGE": "abc"},                         # municipality 0 -> group B
        {**n, "sexo": ""},                                     # sex N -> out
        {**n, "estadoIBGE": "BA"},                             # other state -> out
        {**n, "idade": "9"},                                   # out
        {**n, "codigoDosesVacina": "9,10", "sexo": " masculino"},  # group C
    ]
    write_csv(f"{base}/not/a.csv", NOTIF_COLUMNS, rows)
    return f"{base}/not/*.csv"


def write_census(base: str) -> str:
    cols = ["Situacao_domicilio", "Sexo", "Cor_raca", "Cod", "Municipio", "Idade", "Qtd"]
    r = lambda sexo, idade, qtd, cod="2800308": dict(
        Situacao_domicilio="Urbana", Sexo=sexo, Cor_raca="Parda", Cod=cod, Municipio="Aracaju", Idade=idade, Qtd=qtd)
    rows = [
        r("Homens", "1 ano", "5"),            # age 1 -> 10
        r("Homens", "1 ano", "7"),            # same group -> 12
        r("Mulheres", "10 anos", "3"),        # age 19
        r("Mulheres", "10 anos", "-"),        # no quantity -> dropped
        r("Mulheres", "10 anos", ""),         # empty quantity -> dropped
        r("Homens", "5 a 9 anos", "100"),     # range -> NULL age -> out
        r("Homens", "100 anos ou mais", "4"),  # months rule -> age 0 -> 9 -> out
        r("Total", "20 anos", "50"),          # sex N -> out
        r("Homens", "3 meses", "8"),          # no 'ano' -> dropped
        r("Mulheres", "1 ano e 3 meses", "2"),  # age 0 -> 9 -> out of 10..110
        r("Mulheres", "101 anos", "1"),       # 110 -> kept
        r("Mulheres", "102 anos", "1"),       # 111 -> out
    ]
    path = f"{base}/censo/tabela3175.csv"
    write_csv(path, cols, rows, preamble=["Tabela 3175 - Populacao residente", "Variavel - Pessoas", "Brasil"],
              footer=["Fonte: IBGE - Censo Demografico 2010", "Notas: totais"], header=True)
    return path

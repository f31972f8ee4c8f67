"""Fixed values.

These literals must equal the ones of the source system for the output
tables to match it: labels, sentinel codes, recode tables and filters of the
public-health layouts. They are listed here, together and in natural order,
so that no other module carries a copy.
"""

# --- fixed values: labels -------------------------------------------------
NO_INFO = "SEM INFORMACAO"
MONTHS_LABEL = "Meses Idade"
YEAR_SINGULAR = "Ano"
YEAR_PLURAL = "Anos"
COUNTRY = "Brasil"
YEAR_WORDS = (" anos", " ano")          # removed from age texts, in this order
MONTHS_PATTERN = "% m%"                 # an age text in months, once these are gone
AGE_PATTERN = "%ano%"                   # rows of the census export that carry an age
SEX_LABELS = {"F": "FEMININO", "M": "MASCULINO"}

# --- fixed values: age bands (inclusive bounds, None = open) --------------
AGE_BANDS = [
    (None, 9, "Menos de 10 anos"),
    (10, 19, "De 10 a 19 anos"),
    (20, 39, "De 20 a 39 anos"),
    (40, 59, "De 40 a 59 anos"),
    (60, 89, "De 60 a 89 anos"),
    (90, None, "Mais de 90 anos"),
]

# --- fixed values: census sex words -> code ------------------------------
CENSUS_SEX = {"HOMENS": "M", "MULHERES": "F"}

# --- fixed values: study scope -------------------------------------------
STATE_CODE = "SE"
STATE_NAME = "SERGIPE"
NO_STATE = "-"
FIRST_DOSE_DAY = "2021-01-19"
AGE_MIN, AGE_MAX = 10, 110
CALENDAR_START, CALENDAR_END = "2021-01-01", "2023-02-01"
SRAG_FINAL_CLASS = "5"   # COVID-19 confirmed
DEATH_OUTCOME = 2

# --- fixed values: canonical SRAG column list (all years aligned to it) ---
SRAG_COLUMNS = [
    "CLASSI_FIN", "EVOLUCAO", "FATOR_RISC", "NU_IDADE_N", "SG_UF_NOT", "CO_MUN_NOT",
    "SG_UF", "CO_MUN_RES", "CS_RACA", "CS_SEXO", "HOSPITAL", "UTI", "VACINA_COV",
    "DOSE_1_COV", "DOSE_2_COV", "DT_DOSEUNI", "DT_1_DOSE", "DT_2_DOSE", "DT_DIGITA",
    "DT_NOTIFIC",
]

# --- fixed values: census CSV columns, by position -----------------------
CENSUS_COLUMNS = ["Situacao_domicilio", "Sexo", "Cor_raca", "Cod", "Municipio", "Idade", "Qtd"]
CENSUS_EMPTY_QTD = ["-", "", " "]

# --- fixed values: NULL -> sentinel code, per source ----------------------
# (applied after the codes are derived; a text column gets the text form)
NO_CODE = "0"
NONE_TEXT = "None"
MISSING_SEX = "N"
UNKNOWN_SEX = ["I"]
VACCINATION_SENTINELS = {
    "cod_sistema_origem": "0", "cod_dose": "0", "cod_estabelecimento": 0, "cod_grupo": 0,
    "cod_categoria": 0, "cod_vacina": 0, "cod_paciente": "0", "cod_raca": 99, "cod_idade": 999,
    "cod_municipio_estab": 0, "cod_municipio_paciente": 0, "cod_sexo": "N",
}
SRAG_SENTINELS = {
    "cod_class_final": "0", "cod_evolucao": "9", "cod_internacao": 9, "cod_uti": 9, "cod_vacinado": 9,
}
NOTIFICATION_SENTINELS = {
    "cod_class_final": "0", "cod_evolucao": "0", "cod_condicoes": "0", "cod_idade": 0,
    "cod_municipio_estab": "0", "cod_municipio_paciente": 0, "cod_sexo": "N", "cod_vacinado": 0,
    "cod_doses": "0",
}

# --- fixed values: recodes ------------------------------------------------
RACE_DIGIT_SWAP = ("4", "6")            # text replace before the int cast
RACE_RECODE = {6: 3, 3: 4, 9: 99}
RACE_MISSING = 99
FLAG_RECODE = {"S": "1", "N": "2"}
FLAG_MISSING = "9"

# --- fixed values: SRAG dose precedence (first present column wins) -------
DOSE_PRECEDENCE = [("DOSE_1_COV", 1), ("DOSE_2_COV", 2), ("DT_DOSEUNI", 1), ("DT_1_DOSE", 1), ("DT_2_DOSE", 2)]
NO_DOSE = 0

# --- fixed values: population age key is published shifted ---------------
POPULATION_AGE_SHIFT = 9

# --- fixed values: localities CSV columns and raw file part token ---------
LOCALITY_COLUMNS = ["CD_GEOCODDS", "NM_MUNICIPIO", "NM_UF", "LAT", "LONG"]
PART_TOKEN = r"^[^-]*-([^-]+)"          # 'vacinacao-07-2021.csv' -> '07'

# --- fixed values: output file caps of the source jobs --------------------
MAX_FILES_FACT = 100
MAX_FILES_POPULATION = 60

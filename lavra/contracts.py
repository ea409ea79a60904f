"""Column names, field lists and expected figures of the three public data sets."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- Fixed values: hospital admissions -------------------------------------
ADMISSION_DATE_COLUMNS = ["DT_INTER", "DT_SAIDA", "NASC"]
ADMISSION_KEY = "MUNIC_RES"
ADMISSION_COLUMN_COUNT = 116
ADMISSION_PERIOD_COUNT = 36
ADMISSION_FIRST_YEAR = 2008
ADMISSION_FILE_PREFIX = "RDSP"
DBF_BATCH_RECORDS = 20_000

# ---- Fixed values: municipalities ------------------------------------------
MUNICIPALITY_FIELDS = ["CD_MUN", "NM_MUN", "SIGLA_UF", "AREA_KM2"]
MUNICIPALITY_COUNT = 645
MUNICIPALITY_STATE = "SP"
MUNICIPALITY_PREFIX = "35"
MUNICIPALITY_SILVER_COLUMNS = [
    "CD_MUN",
    "CD_MUN_6",
    "NM_MUN",
    "SIGLA_UF",
    "AREA_KM2",
    "latitude",
    "longitude",
]

# ---- Fixed values: weather stations ----------------------------------------
WEATHER_FIRST_YEAR = 2000
WEATHER_STATION_COUNT = 40
WEATHER_STATE = "SP"
WEATHER_PREAMBLE_LINES = 8
WEATHER_MEMBER_PATTERN = r"(^|/)INMET_SE_SP_.*\.CSV$"
WEATHER_ENCODING = "ISO-8859-1"
WEATHER_DATE_PATTERN = r"^\d{4}/\d{2}/\d{2}$"
WEATHER_PREAMBLE_TEXTS = {
    "codigo_estacao": "CODIGO (WMO):",
    "estacao": "ESTACAO:",
    "uf": "UF:",
    "regiao": "REGIAO:",
}
WEATHER_PREAMBLE_NUMBERS = {
    "latitude": "LATITUDE:",
    "longitude": "LONGITUDE:",
    "altitude": "ALTITUDE:",
}
WEATHER_MEASURES = [
    "precipitacao_mm",
    "pressao_estacao_mb",
    "pressao_max_mb",
    "pressao_min_mb",
    "radiacao_global_kj_m2",
    "temperatura_c",
    "temperatura_orvalho_c",
    "temperatura_max_c",
    "temperatura_min_c",
    "orvalho_max_c",
    "orvalho_min_c",
    "umidade_max_pct",
    "umidade_min_pct",
    "umidade_pct",
    "vento_direcao_graus",
    "vento_rajada_max_ms",
    "vento_velocidade_ms",
]
WEATHER_KEYS = [
    "ano",
    "data_hora_utc",
    "data",
    "hora_utc",
    "codigo_estacao",
    "estacao",
    "uf",
    "regiao",
    "latitude",
    "longitude",
    "altitude",
]
# ---- End of fixed values ----------------------------------------------------

WEATHER_SILVER_COLUMNS = WEATHER_KEYS + WEATHER_MEASURES

WEATHER_RAW_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ["data", "hora_utc", *WEATHER_MEASURES]]
)

_WEATHER_KEY_TYPES = {
    "ano": T.IntegerType(),
    "data_hora_utc": T.TimestampNTZType(),
    "latitude": T.DoubleType(),
    "longitude": T.DoubleType(),
    "altitude": T.DoubleType(),
}

# Declared so that an all-digit station code read back from a directory name
# stays text.
WEATHER_SILVER_SCHEMA = T.StructType(
    [T.StructField(name, _WEATHER_KEY_TYPES.get(name, T.StringType())) for name in WEATHER_KEYS]
    + [T.StructField(name, T.DoubleType()) for name in WEATHER_MEASURES]
)

MUNICIPALITY_SCHEMA = T.StructType(
    [
        T.StructField("CD_MUN", T.StringType()),
        T.StructField("NM_MUN", T.StringType()),
        T.StructField("SIGLA_UF", T.StringType()),
        T.StructField("AREA_KM2", T.DoubleType()),
    ]
)

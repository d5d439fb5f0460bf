"""The 19 columns of an hourly station record and the names each layer gives them."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T


class StationColumn(NamedTuple):
    header: str  # name in the file
    friendly: str  # name in the renamed raw model
    loaded: str  # name given by the positional load
    ddl: str  # name in the declared table
    staging: str | None  # name in the staging view, None where the view leaves it out
    kind: str  # date, time, float or int


# File headers and the names used by each layer, in file order.
STATION_COLUMNS: tuple[StationColumn, ...] = (
    StationColumn("Data", "data", "Data", "DATA", "DATA_OBSERVACAO", "date"),
    StationColumn("Hora UTC", "hora_utc", "hora_utc", "HORA_UTC", "HORA_OBSERVACAO", "time"),
    StationColumn("PRECIPITAÇÃO TOTAL, HORÁRIO (mm)", "precipitacao_mm", "precipitação_total_horário_(mm)", "PRECIPITACAO_TOTAL_HORARIA_MMB", "PRECIPITACAO_MM", "float"),
    StationColumn("PRESSAO ATMOSFERICA AO NIVEL DA ESTACAO, HORARIA (mB)", "pressao_atm_estacao_mb", "pressao_atmosferica_ao_nivel_da_estacao_horaria_(m-b)", "PRESSAO_ATMOSFERICA_NIVEL_ESTACAO_HORARIA_MBAR", "PRESSAO_ATM_ESTACAO_MB", "float"),
    StationColumn("PRESSÃO ATMOSFERICA MAX.NA HORA ANT. (AUT) (mB)", "pressao_atm_max_mb", "pressão_atmosferica_maxna_hora_ant_(aut)_(m-b)", "PRESSAO_ATMOSFERICA_MAX_HORA_ANT_AUT_MBAR", "PRESSAO_ATM_MAX_MB", "float"),
    StationColumn("PRESSÃO ATMOSFERICA MIN. NA HORA ANT. (AUT) (mB)", "pressao_atm_min_mb", "pressão_atmosferica_min_na_hora_ant_(aut)_(m-b)", "PRESSAO_ATMOSFERICA_MIN_HORA_ANT_AUT_MBAR", "PRESSAO_ATM_MIN_MB", "float"),
    StationColumn("RADIACAO GLOBAL (Kj/m²)", "radiacao_global_kj_m2", "radiacao_global_(kj/m²)", "RADIACAO_GLOBAL_KJ_MF", "RADIACAO_GLOBAL_KJ_M2", "float"),
    StationColumn("TEMPERATURA DO AR - BULBO SECO, HORARIA (°C)", "temperatura_ar_c", "temperatura_do_ar_bulbo_seco_horaria_(°c)", "TEMPERATURA_AR_BULBO_SECO_HORARIA_C", "TEMP_AR_BULBO_SECO_C", "float"),
    StationColumn("TEMPERATURA DO PONTO DE ORVALHO (°C)", "temperatura_orvalho_c", "temperatura_do_ponto_de_orvalho_(°c)", "TEMPERATURA_DO_PONTO_DE_ORVALHO_HORARIA_C", "TEMP_PONTO_ORVALHO_C", "float"),
    StationColumn("TEMPERATURA MÁXIMA NA HORA ANT. (AUT) (°C)", "temperatura_max_c", "temperatura_máxima_na_hora_ant_(aut)_(°c)", "TEMPERATURA_MAXIMA_NA_HORA_ANT_AUT_C", "TEMP_MAX_C", "float"),
    StationColumn("TEMPERATURA MÍNIMA NA HORA ANT. (AUT) (°C)", "temperatura_min_c", "temperatura_mínima_na_hora_ant_(aut)_(°c)", "TEMPERATURA_MINIMA_NA_HORA_ANT_AUT_C", "TEMP_MIN_C", "float"),
    StationColumn("TEMPERATURA ORVALHO MAX. NA HORA ANT. (AUT) (°C)", "temperatura_orvalho_max_c", "temperatura_orvalho_max_na_hora_ant_(aut)_(°c)", "TEMPERATURA_ORVALHO_MAX_HORA_ANT_AUT_C", None, "float"),
    StationColumn("TEMPERATURA ORVALHO MIN. NA HORA ANT. (AUT) (°C)", "temperatura_orvalho_min_c", "temperatura_orvalho_min_na_hora_ant_(aut)_(°c)", "TEMPERATURA_ORVALHO_MIN_HORA_ANT_AUT_C", None, "float"),
    StationColumn("UMIDADE REL. MAX. NA HORA ANT. (AUT) (%)", "umidade_rel_max_pct", "umidade_rel_max_na_hora_ant_(aut)_(%)", "UMIDADE_RELATIVA_MAX_NA_HORA_ANT_AUT_PORCENTAGEM", None, "float"),
    StationColumn("UMIDADE REL. MIN. NA HORA ANT. (AUT) (%)", "umidade_rel_min_pct", "umidade_rel_min_na_hora_ant_(aut)_(%)", "UMIDADE_RELATIVA_MIN_NA_HORA_ANT_AUT_PORCENTAGEM", None, "float"),
    StationColumn("UMIDADE RELATIVA DO AR, HORARIA (%)", "umidade_rel_ar_pct", "umidade_relativa_do_ar_horaria_(%)", "UMIDADE_RELATIVA_DO_AR_HORARIA_PORCENTAGEM", "UMIDADE_REL_HORARIA_PCT", "float"),
    StationColumn("VENTO, DIREÇÃO HORARIA (gr) (° (gr))", "vento_direcao_gr", "vento_direcao_horaria_(gr)_(°_(gr))", "VENTO_DIRECAO_HORARIA_GRAUS", None, "int"),
    StationColumn("VENTO, RAJADA MAXIMA (m/s)", "vento_rajada_max_ms", "vento_rajada_maxima_(m/s)", "VENTO_RAJADA_MAXIMA_M_S", "VENTO_RAJADA_MAX_MS", "float"),
    StationColumn("VENTO, VELOCIDADE HORARIA (m/s)", "vento_velocidade_ms", "vento_velocidade_horaria_(m/s)", "VENTO_VELOCIDADE_HORARIA_M_S", "VENTO_VELOCIDADE_HORARIA_MS", "float"),
)

# Names of the short typed model, by friendly name.
SHORT_MODEL = {
    "data": "date",
    "hora_utc": "hour",
    "precipitacao_mm": "precipitacao",
    "temperatura_ar_c": "temperatura",
    "umidade_rel_ar_pct": "umidade",
    "vento_velocidade_ms": "vento",
}

# Model features, in order.
FEATURES = [
    "area_km2",
    "centroid_lon",
    "centroid_lat",
    "num_total_usinas",
    "potencia_total_mw",
    "radiacao_media_anual",
]

# Generation-type codes.
SOLAR, WIND, HYDRO = "UFV", "EOL", ("UHE", "PCH", "CGH")

MEASURES = tuple(c for c in STATION_COLUMNS if c.kind in ("float", "int"))

RAW_SCHEMA = T.StructType([T.StructField(c.header, T.StringType()) for c in STATION_COLUMNS])

_DDL_TYPES = {"date": T.TimestampNTZType(), "time": T.StringType(), "float": T.DoubleType(), "int": T.DoubleType()}
DDL_SCHEMA = T.StructType([T.StructField(c.ddl, _DDL_TYPES[c.kind]) for c in STATION_COLUMNS])


def header_to(layer: str) -> dict[str, str]:
    """Map of file header to the name in ``layer`` (friendly, loaded, ddl or staging)."""
    return {c.header: getattr(c, layer) for c in STATION_COLUMNS if getattr(c, layer)}


def canonical_name(name: str) -> str | None:
    """Friendly name for any known spelling of a station column, else None."""
    wanted = name.strip().upper()
    for c in STATION_COLUMNS:
        if wanted in {s.upper() for s in (c.header, c.friendly, c.loaded, c.ddl, c.staging or c.ddl)}:
            return c.friendly
    return None

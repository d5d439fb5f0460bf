"""Plant registry files: Latin-1, semicolons, decimal commas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliogrid.functions import text

# Registry columns and the values that mark a plant in operation.
STATE, PHASE, KIND = "SigUFPrincipal", "DscFaseUsina", "SigTipoGeracao"
LATITUDE, LONGITUDE, POWER = "NumCoordNEmpreendimento", "NumCoordEEmpreendimento", "MdaPotenciaFiscalizadaKw"
DEFAULT_STATE, OPERATING = "GO", "Operação"


def scan_plants(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Every column as text, by the header of the file."""
    return spark.read.options(header="true", sep=";", encoding="ISO-8859-1", recursiveFileLookup="true").csv(paths)


def operating_plants(
    registry: DataFrame, state: str = DEFAULT_STATE, phase: str = OPERATING, power_decimal: str = ","
) -> DataFrame:
    """Plants of one state and phase with numeric position and power; rows lacking any are dropped.

    ``power_decimal='.'`` refuses power written with a comma, as a plain numeric cast does.
    """
    kept = registry.filter((F.col(STATE) == state) & (F.col(PHASE) == phase))
    numbers = {
        "latitude": text.try_number(F.col(LATITUDE)),
        "longitude": text.try_number(F.col(LONGITUDE)),
        "potencia_kw": text.try_number(F.col(POWER), decimal_sep=power_decimal),
    }
    return kept.withColumns(numbers).dropna(how="any", subset=list(numbers))

"""Plant aggregates per municipality."""

from pyspark.sql import functions as F

from heliogrid.operators import mart
from heliogrid.queries.base import MART_SQL, municipalities, plants, query, rounded

MEASURES_SQL = """num_total_usinas, num_usinas_solares, num_usinas_eolica, round(potencia_total_mw, 6) AS potencia_total_mw,
    round(potencia_hidro_mw, 6) AS potencia_hidro_mw"""


def build(spark, sf_dir):
    return mart.plant_mart(municipalities(spark, sf_dir), plants(spark, sf_dir))


@query("plant_mart", f"WITH {MART_SQL} SELECT cd_mun, nm_mun, radiacao_media_anual, {MEASURES_SQL} FROM mart")
def plant_mart(spark, sf_dir):
    return rounded(build(spark, sf_dir), 6)


@query("left_join_chain", f"WITH {MART_SQL} SELECT cd_mun, nm_mun, {MEASURES_SQL} FROM mart")
def left_join_chain(spark, sf_dir):
    """The same measures as five aggregates joined one by one."""
    p = plants(spark, sf_dir)
    hydro = p.filter(F.col("SigTipoGeracao").isin("UHE", "PCH", "CGH"))

    def size(rows, name):
        return rows.groupBy("cd_mun").agg(F.count(F.lit(1)).alias(name))

    def power(rows, name):
        return rows.groupBy("cd_mun").agg((F.sum("potencia_kw") / 1000).alias(name))

    sides = [
        size(p, "num_total_usinas"),
        size(p.filter(F.col("SigTipoGeracao") == "UFV"), "num_usinas_solares"),
        size(p.filter(F.col("SigTipoGeracao") == "EOL"), "num_usinas_eolica"),
        power(p, "potencia_total_mw"),
        power(hydro, "potencia_hidro_mw"),
    ]
    return rounded(mart.left_join_chain(municipalities(spark, sf_dir).drop("radiacao_media_anual"), sides, "cd_mun"), 6)

"""Projection, polygons, and spatial joins."""


from pyspark.sql import functions as F

from heliogrid.functions import geo
from heliogrid.operators import mart, spatial
from heliogrid.plans.energy import energy_mart
from heliogrid.plans.energy import potential_ranking as rank_potential
from heliogrid.queries.base import CELL_XY_SQL, PLANT_XY_SQL, cells, once, plant_places, query, rounded, table
from heliogrid.sources import polygons


def utm_sql(source: str, carry: str) -> str:
    """Krüger series as SQL: columns E and N for the lon and lat of ``source``."""
    e = geo._E
    a = geo.ALPHA
    scale_a = geo.SCALE * geo._A
    east = " + ".join(f"{a[j]!r} * cos({2 * j + 2} * xi) * sinh({2 * j + 2} * eta)" for j in range(3))
    north = " + ".join(f"{a[j]!r} * sin({2 * j + 2} * xi) * cosh({2 * j + 2} * eta)" for j in range(3))
    return f"""(SELECT {carry}, 500000 + {scale_a!r} * (eta + {east}) AS e, 10000000 + {scale_a!r} * (xi + {north}) AS n FROM (
        SELECT {carry}, atan2(t, cos(d)) AS xi, atanh(sin(d) / sqrt(1 + t * t)) AS eta FROM (
        SELECT {carry}, sinh(atanh(sin(radians(lat))) - {e!r} * atanh({e!r} * sin(radians(lat)))) AS t, radians(lon + 51) AS d FROM {source})))"""


def boxes(spark, sf_dir):
    """A box per customer with a box-shaped hole."""
    c = table(spark, sf_dir, "customer")
    x, y = (F.col("c_custkey") % 100).cast("double"), (F.floor(F.col("c_custkey") / 100) % 100).cast("double")
    w, h = (F.col("c_custkey") % 7 + 2).cast("double"), (F.col("c_custkey") % 5 + 3).cast("double")

    def box(x0, y0, x1, y1):
        return F.array(*[geo.point(a, b) for a, b in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))])

    hole = box(x + 1, y + 1, x + 1.5, y + 2)
    return c.select(F.col("c_custkey").alias("cd_mun"), F.col("c_name").alias("nm_mun"), F.array(F.array(box(x, y, x + w, y + h), hole)).alias("geometry"))


BOX_SQL = "(SELECT c_custkey AS cd_mun, c_custkey % 100 AS x, c_custkey // 100 % 100 AS y, c_custkey % 7 + 2 AS w, c_custkey % 5 + 3 AS h FROM customer)"


@query("polygon_area", f"SELECT cd_mun, round((w * h - 0.5)::DOUBLE, 6) AS area FROM {BOX_SQL}")
def polygon_area(spark, sf_dir):
    return rounded(boxes(spark, sf_dir).select("cd_mun", geo.area("geometry").alias("area")), 6)


@query(
    "polygon_centroid",
    f"""SELECT cd_mun, round(((x + w / 2) * w * h - (x + 1.25) * 0.5)::DOUBLE / (w * h - 0.5)::DOUBLE, 6) AS centroid_x,
               round(((y + h / 2) * w * h - (y + 1.5) * 0.5)::DOUBLE / (w * h - 0.5)::DOUBLE, 6) AS centroid_y FROM {BOX_SQL}""",
)
def polygon_centroid(spark, sf_dir):
    c = boxes(spark, sf_dir).select("cd_mun", geo.moments("geometry").alias("m")).select("cd_mun", geo.centroid_of("m").alias("c"))
    return rounded(c.select("cd_mun", F.col("c.x").alias("centroid_x"), F.col("c.y").alias("centroid_y")), 6)


@query(
    "polygon_scan",
    f"""SELECT CAST(cd_mun AS VARCHAR) AS cd_mun, c_name AS nm_mun, CAST(2 AS INTEGER) AS n_rings, CAST(x AS DOUBLE) AS x0, CAST(y + h AS DOUBLE) AS y1
        FROM {BOX_SQL} JOIN customer ON c_custkey = cd_mun""",
)
def polygon_scan(spark, sf_dir):
    """A layer written as GeoJSON lines and scanned."""

    def write(path):
        layer = boxes(spark, sf_dir)
        feature = polygons.to_geojson({"CD_MUN": F.col("cd_mun").cast("string"), "NM_MUN": F.col("nm_mun")}, "geometry")
        layer.select(feature.alias("value")).write.text(path)

    layer = polygons.scan_polygons(spark, once(spark, sf_dir, "layer", write), {"CD_MUN": "cd_mun", "NM_MUN": "nm_mun"})
    box = geo.bounding_box("geometry")
    return layer.select("cd_mun", "nm_mun", F.size(F.flatten("geometry")).alias("n_rings"), box["x0"].alias("x0"), box["y1"].alias("y1"))


@query(
    "utm_project",
    f"SELECT c_custkey, round(e, 3) AS easting, round(n, 3) AS northing, round(lon, 6) AS lon, round(lat, 6) AS lat FROM {utm_sql('(SELECT c_custkey, longitude AS lon, latitude AS lat FROM (SELECT c_custkey, ' + PLANT_XY_SQL + ' FROM customer))', 'c_custkey, lon, lat')}",
)
def utm_project(spark, sf_dir):
    """To metres and back to degrees."""
    p = plant_places(spark, sf_dir).select("c_custkey", geo.utm("longitude", "latitude").alias("m"))
    p = p.withColumn("g", geo.lonlat("m.x", "m.y"))
    flat = p.select("c_custkey", F.col("m.x").alias("easting"), F.col("m.y").alias("northing"), F.col("g.x").alias("lon"), F.col("g.y").alias("lat"))
    return rounded(rounded(flat, 3, "easting", "northing"), 6, "lon", "lat")


def layer(spark, sf_dir):
    """A triangle per supplier: half of a quarter-degree cell."""
    s = cells(spark, sf_dir)
    x, y = F.col("x0"), F.col("y0")
    ring = F.array(geo.point(x, y), geo.point(x + 0.25, y), geo.point(x, y + 0.25), geo.point(x, y))
    return s.select(F.col("s_suppkey").alias("cd_mun"), F.col("s_name").alias("nm_mun"), F.array(F.array(ring)).alias("geometry"))


VERTEX_SQL = f"""(SELECT cd_mun, k, x0 + 0.25::DOUBLE * (k = 1)::INT AS lon, y0 + 0.25::DOUBLE * (k = 2)::INT AS lat
    FROM (SELECT s_suppkey AS cd_mun, {CELL_XY_SQL}, unnest([0, 1, 2]) AS k FROM supplier))"""


@query(
    "mart_geometry",
    f"""SELECT cd_mun, round(abs((e1 - e0) * (n2 - n0) - (n1 - n0) * (e2 - e0)) / 2 / 1e6, 4) AS area_km2 FROM (
        SELECT cd_mun, max(e) FILTER (WHERE k = 0) AS e0, max(e) FILTER (WHERE k = 1) AS e1, max(e) FILTER (WHERE k = 2) AS e2,
               max(n) FILTER (WHERE k = 0) AS n0, max(n) FILTER (WHERE k = 1) AS n1, max(n) FILTER (WHERE k = 2) AS n2
        FROM {utm_sql(VERTEX_SQL, 'cd_mun, k')} GROUP BY cd_mun)""",
)
def mart_geometry(spark, sf_dir):
    """Area of every municipality in km², measured on the projected polygon."""
    return rounded(mart.with_geometry(layer(spark, sf_dir)).select("cd_mun", "area_km2"))


WITHIN_SQL = f"""(SELECT c_custkey, c_mktsegment, c_acctbal, longitude, latitude, s_suppkey AS cd_mun
    FROM (SELECT *, {PLANT_XY_SQL} FROM customer) JOIN (SELECT s_suppkey, {CELL_XY_SQL} FROM supplier)
      ON floor(longitude * 4) / 4 = x0 AND floor(latitude * 4) / 4 = y0
    WHERE longitude > x0 AND latitude > y0 AND (longitude - x0) + (latitude - y0) < 0.25)"""


@query("spatial_within", f"SELECT c_custkey, cd_mun FROM {WITHIN_SQL}")
def spatial_within(spark, sf_dir):
    """Plants strictly inside a municipality."""
    return spatial.join_within(plant_places(spark, sf_dir), layer(spark, sf_dir)).select("c_custkey", "cd_mun")


@query(
    "nearest_station",
    f"""SELECT c_custkey, s_suppkey, round(sqrt(d2), 6) AS distance FROM (
        SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY d2, s_suppkey) AS r FROM (
        SELECT c_custkey, s_suppkey, (longitude - x0) * (longitude - x0) + (latitude - y0) * (latitude - y0) AS d2
        FROM (SELECT c_custkey, {PLANT_XY_SQL} FROM customer), (SELECT s_suppkey, {CELL_XY_SQL} FROM supplier))) WHERE r = 1""",
)
def nearest_station(spark, sf_dir):
    """Each place with its nearest station; equal distances go to the smaller id."""
    found = spatial.nearest_join(plant_places(spark, sf_dir), cells(spark, sf_dir), "c_custkey", "s_suppkey", ("longitude", "latitude"), ("x0", "y0"))
    return rounded(found, 6)


SEGMENT_KIND_SQL = "CASE c_mktsegment WHEN 'BUILDING' THEN 'UFV' WHEN 'MACHINERY' THEN 'EOL' WHEN 'HOUSEHOLD' THEN 'UHE' WHEN 'FURNITURE' THEN 'PCH' ELSE 'CGH' END"


def energy(spark, sf_dir):
    """Cells as municipalities, customers as plants, suppliers as stations, line items as readings."""
    points = plant_places(spark, sf_dir).select(
        "longitude", "latitude", F.expr(SEGMENT_KIND_SQL).alias("SigTipoGeracao"), F.abs("c_acctbal").alias("potencia_kw")
    )
    means = mart.station_mean(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_extendedprice")
    # The hint keeps Spark from broadcasting cells, which may be small only as a compressed file.
    stations = cells(spark, sf_dir).hint("merge").join(means, F.col("s_suppkey") == F.col("l_suppkey")).drop("l_suppkey")
    return energy_mart(layer(spark, sf_dir), points, stations, "s_suppkey", ("x0", "y0"))


@query(
    "potential_ranking",
    f"""WITH r AS (SELECT l_suppkey, avg(l_extendedprice) AS radiacao FROM lineitem GROUP BY 1),
        p AS (SELECT cd_mun, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS solar, count(*) AS total, sum(abs(c_acctbal)) / 1000 AS mw FROM {WITHIN_SQL} GROUP BY 1),
        m AS (SELECT s_suppkey AS cd_mun, s_name AS nm_mun, coalesce(solar, 0) AS solar, coalesce(total, 0) AS total, coalesce(mw, 0) AS mw, radiacao
              FROM supplier LEFT JOIN p ON cd_mun = s_suppkey LEFT JOIN r ON l_suppkey = s_suppkey),
        b AS (SELECT min(radiacao) AS r0, max(radiacao) AS r1, min(solar) AS s0, max(solar) AS s1 FROM m),
        x AS (SELECT m.*, CASE WHEN r1 = r0 THEN 0 ELSE (radiacao - r0) / (r1 - r0) END * 0.7::DOUBLE - CASE WHEN s1 = s0 THEN 0 ELSE (solar - s0) / (s1 - s0) END * 0.3::DOUBLE AS raw FROM m, b)
        SELECT nm_mun, total AS num_total_usinas, round(mw, 6) AS potencia_total_mw, round((raw - lo) / (hi - lo), 6) AS potencial_score,
               CAST(row_number() OVER (ORDER BY (raw - lo) / (hi - lo) DESC, nm_mun) AS INTEGER) AS rank
        FROM x, (SELECT min(raw) AS lo, max(raw) AS hi FROM x) ORDER BY 5 LIMIT 15""",
)
def potential_ranking(spark, sf_dir):
    """The whole analysis: mart, score and the fifteen best municipalities."""
    best = rank_potential(energy(spark, sf_dir), 15)
    return rounded(best.select("nm_mun", "num_total_usinas", "potencia_total_mw", "potencial_score", "rank"), 6)


import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliogrid import session
from heliogrid.functions import geo
from heliogrid.operators import mart, spatial
from heliogrid.sources import polygons

LAYER = "cd_mun int, geometry " + geo.SHAPE


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]


def test_area_and_centroid(spark):
    shapes = [[box(0.0, 0.0, 2.0, 3.0)], [box(0.0, 0.0, 4.0, 4.0), box(1.0, 1.0, 2.0, 2.0)[::-1]], [[(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)]]]
    df = spark.createDataFrame([(i, [s]) for i, s in enumerate(shapes)] + [(3, [[box(0.0, 0.0, 1.0, 1.0)], [box(3.0, 0.0, 4.0, 1.0)]])], LAYER)
    got = df.select(geo.moments("geometry").alias("m")).select("m.a", geo.centroid_of("m").alias("c")).collect()
    assert got[0].a == 6 and tuple(got[0].c) == (1.0, 1.5)
    assert got[1].a == 15 and got[1].c.x == pytest.approx((8 * 4 - 1.5) / 15)
    assert got[2].a == 0 and got[2].c is None
    assert got[3].a == 2 and tuple(got[3].c) == (2.0, 0.5)


def test_projection_constants(spark):
    df = spark.createDataFrame([(-49.25, -16.68), (-51.0, 0.0)], "x double, y double")
    rows = df.select(geo.utm("x", "y").alias("p")).select("p", geo.lonlat("p.x", "p.y").alias("g")).collect()
    assert (round(rows[0].p.x, 3), round(rows[0].p.y, 3)) == (686613.291, 8155026.233)
    assert (rows[1].p.x, rows[1].p.y) == (500000, 10000000)
    assert rows[0].g.x == pytest.approx(-49.25, abs=1e-8) and rows[0].g.y == pytest.approx(-16.68, abs=1e-8)


def test_projection_round_trip_and_additive_area(spark):
    rng = np.random.default_rng(11)
    spots = [(float(x), float(y)) for x, y in zip(rng.uniform(-53, -46, 500), rng.uniform(-20, -12, 500))]
    df = spark.createDataFrame(spots, "x double, y double").withColumn("p", geo.utm("x", "y")).withColumn("g", geo.lonlat("p.x", "p.y"))
    worst = df.selectExpr("max(abs(g.x - x)) + max(abs(g.y - y)) AS e").first().e
    assert worst < 2e-8
    halves = [(i, [[box(x, y, x + 0.5, y + 1.0)]]) for i, (x, y) in enumerate(spots)] + [(i, [[box(x + 0.5, y, x + 1.0, y + 1.0)]]) for i, (x, y) in enumerate(spots)]
    whole = [(i, [[box(x, y, x + 1.0, y + 1.0)]]) for i, (x, y) in enumerate(spots)]
    a, b = (spark.createDataFrame(s, LAYER).select("cd_mun", geo.area("geometry").alias("a")).groupBy("cd_mun").sum("a").orderBy("cd_mun").collect() for s in (halves, whole))
    assert [r[1] for r in a] == pytest.approx([r[1] for r in b])


def test_geometry_of_a_small_box(spark):
    ring = [(-49.0, -16.0), (-48.9, -16.0), (-48.9, -15.9), (-49.0, -15.9), (-49.0, -16.0)]
    row = mart.with_geometry(spark.createDataFrame([(1, [[ring]])], LAYER)).first()
    # One degree is about 111.3 km; the scale factor stays within 0.1 %.
    assert row.area_km2 == pytest.approx(11.13**2 * math.cos(math.radians(15.95)), rel=0.01)
    assert row.centroid_lon == pytest.approx(-48.95, abs=1e-4) and row.centroid_lat == pytest.approx(-15.95, abs=1e-4)


def test_edges_and_holes_are_outside(spark):
    poly = spark.createDataFrame([(1, [[box(0.0, 0.0, 4.0, 4.0), box(1.0, 1.0, 2.0, 2.0)]])], LAYER)
    spots = {(3.0, 3.0): True, (1.5, 1.5): False, (1.0, 1.5): False, (0.0, 2.0): False, (4.0, 2.0): False, (2.0, 0.0): False, (0.0, 0.0): False, (5.0, 1.0): False, (0.5, 1.0): True}
    points = spark.createDataFrame([(x, y) for x, y in spots] + [(None, 1.0)], "longitude double, latitude double")
    found = {(r.longitude, r.latitude) for r in spatial.join_within(points, poly).collect()}
    assert found == {p for p, inside in spots.items() if inside}


@pytest.mark.parametrize("limit", [session.BROADCAST_BYTES, 0])
def test_within_matches_brute_force(spark, monkeypatch, limit):
    """Overlapping polygons of very different size, with and without broadcast."""
    monkeypatch.setattr(session, "BROADCAST_BYTES", limit)
    rng = np.random.default_rng(5)
    boxes = [(float(x), float(y), float(x + s), float(y + s)) for x, y, s in zip(rng.uniform(-10, 10, 40), rng.uniform(-10, 10, 40), 10.0 ** rng.uniform(-2, 1.3, 40))]
    poly = spark.createDataFrame([(i, [[box(*b)]]) for i, b in enumerate(boxes)], LAYER)
    xy = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-12, 14, (400, 2)))]
    points = spark.createDataFrame(xy, "id int, longitude double, latitude double")
    got = sorted((r.id, r.cd_mun) for r in spatial.join_within(points, poly).collect())
    want = sorted((i, k) for i, x, y in xy for k, (a, b, c, d) in enumerate(boxes) if a < x < c and b < y < d)
    assert got == want and len(want) > 50


def test_crowded_cells_are_divided(spark, monkeypatch):
    """Stars of thousands of edges and a hole: few edges a cell, whole cells inside, and the points of the exact test."""
    rng = np.random.default_rng(8)
    stars = []
    for cx, cy, scale in ((0.0, 0.0, 5.0), (3.0, 1.0, 40.0), (-7.3, 2.2, 0.7)):
        turn = np.linspace(0, 2 * math.pi, 2500)[:-1]
        radius = scale * (0.6 + 0.3 * np.sin(9 * turn) + 0.01 * rng.random(len(turn)))
        ring = [(float(cx + r * math.cos(t)), float(cy + r * math.sin(t))) for r, t in zip(radius, turn)]
        stars.append([[*ring, ring[0]], box(cx - scale / 20, cy - scale / 20, cx + scale / 20, cy + scale / 20)])
    poly = spark.createDataFrame([(i, [s]) for i, s in enumerate(stars)], LAYER)
    cells = spatial.polygon_cells(poly)[0].selectExpr("cd_mun", "size(_segs) AS n", "_edge", "_level").collect()
    lowest = {i: min(c["_level"] for c in cells if c.cd_mun == i) for i in range(3)}
    assert all(c.n <= spatial.CELL_EDGES or c["_level"] == lowest[c.cd_mun] for c in cells if c["_edge"])
    assert all(c.n == 0 for c in cells if not c["_edge"]) and sum(not c["_edge"] for c in cells) > 20
    xy = [(i, float(x), float(y)) for i, (x, y) in enumerate(np.vstack([rng.uniform(-40, 45, (1500, 2)), rng.uniform(-9, 6, (1500, 2))]))]

    def inside(x, y, rings):
        odd = False
        for ring in rings:
            (ax, ay), (bx, by) = np.array(ring[:-1]).T, np.array(ring[1:]).T
            cross = (ay > y) != (by > y)
            with np.errstate(divide="ignore", invalid="ignore"):
                odd ^= bool(np.sum(cross & (x < (bx - ax) * (y - ay) / (by - ay) + ax)) % 2)
        return odd

    want = sorted((i, k) for i, x, y in xy for k, rings in enumerate(stars) if inside(x, y, rings))
    for limit in (session.BROADCAST_BYTES, 0):
        monkeypatch.setattr(session, "BROADCAST_BYTES", limit)
        found = spatial.join_within(spark.createDataFrame(xy, "id int, longitude double, latitude double"), poly)
        assert sorted((r.id, r.cd_mun) for r in found.collect()) == want and len(want) > 500
        assert found.columns == ["id", "longitude", "latitude", "cd_mun"]


@pytest.mark.parametrize("leaf", [spatial.LEAF_SITES, 4])
@pytest.mark.parametrize("limit", [session.BROADCAST_BYTES, 0])
def test_nearest_matches_brute_force(spark, monkeypatch, limit, leaf):
    """A dense cluster, far outliers, doubled places and ties."""
    monkeypatch.setattr(session, "BROADCAST_BYTES", limit)
    rng = np.random.default_rng(9)
    places = np.vstack([rng.normal(0, 0.01, (400, 2)), rng.uniform(-50, 50, (100, 2)), np.zeros((5, 2)), [[10, 0], [12, 0]]])
    sites = [(i, float(x), float(y)) for i, (x, y) in enumerate(places)]
    spots = np.vstack([rng.uniform(-60, 60, (150, 2)), rng.normal(0, 0.02, (150, 2)), [[11, 0], [0, 0]]])
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(spots)]
    found = spatial.nearest_join(
        spark.createDataFrame(points + [(-1, None, 1.0)], "p int, px double, py double"),
        spark.createDataFrame(sites + [(-1, None, 0.0)], "s int, sx double, sy double"),
        "p", "s", ("px", "py"), ("sx", "sy"), leaf_sites=leaf,
    )
    got = {r.p: (r.s, r.distance) for r in found.collect()}
    assert got.pop(-1) == (None, None)
    assert len(got) == len(points)
    for i, x, y in points:
        d2, s = min(((x - sx) ** 2 + (y - sy) ** 2, s) for s, sx, sy in sites)
        assert got[i][0] == s and got[i][1] == pytest.approx(math.sqrt(d2))


def test_nested_tiles_keep_lists_short(spark):
    """A hundred times the sites in the same number of tiles: lists grow with the square root of a tile."""
    longest = {}
    for n in (2_000, 200_000):
        places = spark.range(n).select("id", F.sin("id").alias("_sx"), F.pow(F.cos(F.col("id") * 7), 3).alias("_sy")).withColumn("_tile", F.expr("int(floor((_sx + 1) * 2.5))"))
        sizes = spatial.inner_tiles(places, n // 5).groupBy("_tile", "_inner").count()
        longest[n] = sizes.agg(F.max("count")).first()[0]
        assert sizes.agg(F.sum("count")).first()[0] == n
    assert longest[200_000] <= 12 * longest[2_000] and longest[200_000] <= 4 * math.sqrt(200_000 / 5)


def test_cells_of_middle_size_are_not_broadcast(spark, monkeypatch):
    """A broadcast takes several times the text of its rows in the driver; crowded cells are salted instead."""
    poly = spark.createDataFrame([(i, [[box(float(i), 0.0, i + 1.0, 1.0)]]) for i in range(40)], LAYER)
    xy = [(i, 0.5 + (i % 40 if i < 400 else 7), 0.25 + i % 3 / 4) for i in range(1000)] + [(-1, None, 0.5)]
    points = spark.createDataFrame(xy, "id int, longitude double, latitude double")
    _, size_bytes, _ = spatial.polygon_cells(poly)
    monkeypatch.setattr(session, "BROADCAST_BYTES", 2 * size_bytes)
    monkeypatch.setattr(spatial, "HOT_POINTS", 100)
    found = spatial.join_within(points, poly)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in text and "_salt" in text
    assert sorted((r.id, r.cd_mun) for r in found.collect()) == sorted((i, int(x)) for i, x, _ in xy if x)


def test_points_meet_few_sites(spark):
    """A hundred times the sites: the lists of the tree stay short, also where all sites lie on one line."""
    for y in ("id % 317", "3"):
        for n in (1_000, 100_000):
            places = spark.range(n).selectExpr("double(id) AS _sx", f"double({y}) AS _sy", "id AS _site")
            levels = spatial.site_tree(places, n, 32)
            sizes = levels[-1].groupBy("_tile").count().agg(F.max("count"), F.sum("count")).first()
            assert sizes[0] <= 32 * spatial.UNEVEN and sizes[1] == n
            up = levels[-1].select("_site", F.expr(f"_tile div {spatial.TOP_TILES}").alias("_tile"))
            assert len(levels) == 1 or up.exceptAll(levels[-2].select("_site", "_tile")).isEmpty()


def test_plant_mart(spark):
    layer = spark.createDataFrame([(1, [[box(0.0, 0.0, 2.0, 3.0)]]), (2, [[box(5.0, 0.0, 7.0, 3.0)]])], LAYER)
    rows = [("UFV", 1000.0), ("UFV", 500.0), ("PCH", 2000.0), ("EOL", 250.0)]
    plants = spark.createDataFrame([(k, p, 1.0, 1.0) for k, p in rows], "SigTipoGeracao string, potencia_kw double, longitude double, latitude double")
    inside = spatial.join_within(plants, layer)
    got = {r.cd_mun: tuple(r[c] for c in mart.PLANT_MEASURES) for r in mart.plant_mart(layer.select("cd_mun"), inside).collect()}
    assert got == {1: (4, 2, 1, 3.75, 2.0), 2: (0, 0, 0, 0.0, 0.0)}


def test_geojson(spark, tmp_path):
    lines = [
        '{"type":"Feature","properties":{"CD_MUN":"1","NM_MUN":"A"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}}',
        '{"type":"Feature","properties":{"CD_MUN":"2","NM_MUN":"B"},"geometry":{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]],[[[5,5],[6,5],[6,6],[5,5]]]]}}',
        "",
    ]
    (tmp_path / "layer.geojsonl").write_text("\n".join(lines))
    df = polygons.scan_polygons(spark, str(tmp_path), {"CD_MUN": "cd_mun", "NM_MUN": "nm_mun"})
    assert [(r.cd_mun, r.nm_mun, len(r.geometry)) for r in df.orderBy("cd_mun").collect()] == [("1", "A", 1), ("2", "B", 2)]
    points = spark.createDataFrame([(5.7, 5.2), (0.7, 0.2)], "longitude double, latitude double")
    assert spatial.join_within(points, df).groupBy("cd_mun").count().orderBy("cd_mun").collect() == [("1", 1), ("2", 2)]


def test_points_without_coordinates_have_no_site(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, float("nan"), 1.0), (3, None, 1.0)], "p int, x double, y double")
    sites = spark.createDataFrame([(7, 0.0, 1.0)], "s int, x double, y double")
    got = spatial.nearest_join(points, sites, "p", "s", ("x", "y"), ("x", "y")).orderBy("p").collect()
    assert [(r.p, r.s, r.distance) for r in got] == [(1, 7, 1.0), (2, None, None), (3, None, None)]

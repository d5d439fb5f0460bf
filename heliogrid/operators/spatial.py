"""Point-in-polygon and nearest-point joins as equi-joins on cells."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliogrid.functions import geo
from heliogrid.session import may_broadcast, serialised_bytes, stage_table

TOP_TILES = 16  # tiles of all sites of a nearest join, and of each tile that is divided
LEAF_SITES = 32  # sites of a tile from which it is divided again
UNEVEN = 4  # times that number which some tiles may hold
MAX_LEVELS = 14  # the number of a tile fits 64 bits
CELL_EDGES = 64  # edges of a polygon in a cell from which the cell is divided
DIVISIONS = 5  # of a cell at most
SALTS = 16  # pieces a hot cell is split into when neither side is small
HELD = 8  # times its JSON text that a broadcast table takes in the driver: rows, hash table and blocks at once
HOT_SHARE = 64  # a cell with more than one in so many of the points is hot
HOT_POINTS = 65_536  # of a cell at least, for it to be hot


def _judged(cells: DataFrame) -> DataFrame:
    """Cells that a polygon reaches: ``_edge`` tells whether one of its edges may pass, else the cell lies inside.

    Of the edges those stay that a point in the cell can meet, itself or by a ray to the right.
    """
    size = "pow(2D, _level)"
    x0, x1, y0, y1 = f"_cx * {size}", f"(_cx + 1) * {size}", f"_cy * {size}", f"(_cy + 1) * {size}"
    beside = f"least(s.a.y, s.b.y) <= {y1} AND greatest(s.a.y, s.b.y) >= {y0} AND greatest(s.a.x, s.b.x) >= {x0}"
    cells = cells.withColumn("_segs", F.expr(f"filter(_segs, s -> {beside})"))
    # A cell that was found to lie inside has no edges any more.
    cells = cells.withColumnRenamed("_edge", "_open").withColumn("_edge", F.expr(f"exists(_segs, s -> least(s.a.x, s.b.x) <= {x1})"))
    centre = geo.strictly_inside("_segs", f"((_cx + 0.5D) * {size})", f"((_cy + 0.5D) * {size})")
    cells = cells.filter(~F.col("_open") | F.col("_edge") | centre).drop("_open")
    return cells.withColumn("_segs", F.expr("if(_edge, _segs, filter(_segs, s -> false))"))


def polygon_cells(polygons: DataFrame, shape: str = "geometry") -> tuple[DataFrame, int, list[int]]:
    """The cells (``_level``, ``_cx``, ``_cy``) that each polygon reaches, with their edges; their bytes, and the grids in use.

    A polygon is put on the grid whose cell is about half its longer side, so it covers few cells whatever its size. A
    cell with more than CELL_EDGES edges is divided in four, up to DIVISIONS times; cells outside of the polygon go.
    """
    extent = "greatest(_box.x1 - _box.x0, _box.y1 - _box.y0)"
    placed = polygons.withColumn("_box", geo.bounding_box(shape)).filter(f"{extent} > 0")
    placed = placed.withColumn("_level", F.expr(f"int(ceil(log2({extent}))) - 1")).withColumn("_segs", geo.segments(shape))
    cells = placed.drop(shape)
    for axis in "xy":
        span = f"explode(sequence(floor(_box.{axis}0 / pow(2D, _level)), floor(_box.{axis}1 / pow(2D, _level))))"
        cells = cells.withColumn(f"_c{axis}", F.expr(span))
    cells = stage_table(_judged(cells.drop("_box").withColumn("_edge", F.lit(True))), "cells")
    quarter = "named_struct('_level', _level - 1, '_cx', 2 * _cx + {}, '_cy', 2 * _cy + {})"
    quarters = ", ".join(quarter.format(i, j) for i in (0, 1) for j in (0, 1))
    same = "named_struct('_level', _level, '_cx', _cx, '_cy', _cy)"
    parts = F.expr(f"explode(if(_edge AND size(_segs) > {CELL_EDGES}, array({quarters}), array({same})))")
    for left in range(DIVISIONS, -1, -1):
        # The grids in use are a set of binary exponents, a few dozen at most.
        size_bytes, levels, most = cells.agg(serialised_bytes(), F.collect_set("_level"), F.max(F.size("_segs"))).first()
        if not left or (most or 0) <= CELL_EDGES:
            return cells, size_bytes, levels
        divided = cells.withColumn("_part", parts).withColumns({c: F.col(f"_part.{c}") for c in ("_level", "_cx", "_cy")}).drop("_part")
        cells = stage_table(_judged(divided), "cells")


def _constant(value, kind: str) -> str:
    """SQL of a bounded driver-side value, folded to one constant by the optimizer."""
    return f"from_json('{json.dumps(value)}', '{kind}')"


def _hot_cells(probes: DataFrame, keys: list[str]) -> list:
    """Cells with more than a HOT_SHARE-th of the points of their grid, so no more than HOT_SHARE for each grid."""
    counts = probes.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.dropna()
    most = probes.groupBy("_level").agg(F.greatest(F.lit(HOT_POINTS), F.count(F.lit(1)) / HOT_SHARE).alias("_most"))
    return counts.filter(f"_n > {HOT_POINTS}").join(most, "_level").filter("_n > _most").select(*keys).collect()


def join_within(
    points: DataFrame,
    polygons: DataFrame,
    x: str = "longitude",
    y: str = "latitude",
    shape: str = "geometry",
    salts: int = SALTS,
) -> DataFrame:
    """Each point with every polygon that strictly contains it.

    Polygons become the cells of a quadtree; a point is looked up once per grid in use. The candidates
    of the equi-join then pass the exact test, unless their cell lies inside the polygon as a whole.
    Cells are broadcast only if measured small; else the points of a crowded cell are spread over
    ``salts`` pieces, so that it is no hot key.
    """
    cells, size_bytes, levels = polygon_cells(polygons, shape)
    size = "pow(2D, _level)"
    small = may_broadcast(HELD * size_bytes)
    probes = points.withColumn("_level", F.explode(F.lit(levels).cast("array<int>")))
    probes = probes.withColumns({"_cx": F.expr(f"floor({x} / {size})"), "_cy": F.expr(f"floor({y} / {size})")})
    keys = ["_level", "_cx", "_cy"]
    # The hint keeps Spark from broadcasting what is small only as a compressed file.
    cells = F.broadcast(cells) if small else cells.hint("merge")
    hot = [] if small else _hot_cells(probes.select(*keys), keys)
    if hot:
        # All columns take part, so that many points at one place still spread.
        flat = [c for c, kind in points.dtypes if "map<" not in kind]
        crowded = F.expr(f"array_contains({_constant([c.asDict() for c in hot], 'array<struct<_level:int,_cx:bigint,_cy:bigint>>')}, struct({', '.join(keys)}))")
        probes = probes.withColumn("_salt", F.when(crowded, F.pmod(F.xxhash64(*flat), F.lit(salts))).otherwise(F.lit(0).cast("long")))
        cells = cells.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.when(crowded, F.lit(salts - 1)).otherwise(F.lit(0)).cast("long"))))
        keys.append("_salt")
    hit = ~F.col("_edge") | geo.strictly_inside("_segs", x, y)
    return probes.join(cells, keys).filter(hit).drop(*keys, "_segs", "_edge")


def _tiling(places: DataFrame, side: int) -> Column:
    """Tile number of a place (``_sx``, ``_sy``): quantile strips in x, quantile rows in each strip.

    The sketches bring back at most ``side`` cuts for each of ``side`` strips.
    """
    if side == 1:
        return F.lit(0)
    shares = [i / side for i in range(1, side)]
    xs = sorted(set(places.agg(F.percentile_approx("_sx", shares, 1000)).first()[0]))
    strip = f"size(filter({_constant(xs, 'array<double>')}, b -> b <= _sx))"
    rows = places.groupBy(F.expr(strip).alias("strip")).agg(F.percentile_approx("_sy", shares, 1000).alias("ys")).collect()
    by_strip = {r["strip"]: sorted(set(r["ys"])) for r in rows}
    ys = _constant([by_strip.get(i, []) for i in range(len(xs) + 1)], "array<array<double>>")
    return F.expr(f"{strip} * {side + 1} + size(filter(get({ys}, {strip}), b -> b <= _sy))")


def inner_tiles(tiled: DataFrame, per_tile: int) -> DataFrame:
    """Sites with the number of their tile inside their tile, about sqrt(``per_tile``) of nearly equal counts.

    The cuts of each tile are found and applied by joins on the tile, which all hold about the same number of sites.
    """
    side = max(2, round(per_tile**0.25))
    shares = [i / side for i in range(1, side)]
    xs = tiled.groupBy("_tile").agg(F.percentile_approx("_sx", shares, 1000).alias("_xs"))
    strips = tiled.join(xs, "_tile").withColumn("_strip", F.expr("size(filter(_xs, b -> b <= _sx))")).drop("_xs")
    ys = strips.groupBy("_tile", "_strip").agg(F.percentile_approx("_sy", shares, 1000).alias("_ys"))
    inner = F.expr(f"_strip * {side} + size(filter(_ys, b -> b <= _sy))")
    return strips.join(ys, ["_tile", "_strip"]).withColumn("_inner", inner).drop("_strip", "_ys")


def site_tree(places: DataFrame, n: int, leaf_sites: int) -> list[DataFrame]:
    """The ``n`` sites (``_sx``, ``_sy``), all at different places, with their ``_tile`` in each level of a tree, the last one with the smallest tiles.

    Tiles are divided into TOP_TILES of nearly equal counts, whatever the number of sites, until they hold about
    ``leaf_sites``; more levels follow where equal coordinates made some tiles much larger.
    """
    levels = [places.withColumn("_tile", _tiling(places, math.isqrt(TOP_TILES)).cast("long"))]
    while True:
        levels[-1] = stage_table(levels[-1], "tiles")
        if n > leaf_sites * TOP_TILES ** len(levels):
            most = n / TOP_TILES ** len(levels)
        else:
            most = levels[-1].groupBy("_tile").count().agg(F.max("count")).first()[0] / UNEVEN
        if most <= leaf_sites or len(levels) == MAX_LEVELS:
            return levels
        # The number of a tile starts with that of the tile above.
        inner = inner_tiles(levels[-1], TOP_TILES**2).withColumn("_tile", F.col("_tile") * TOP_TILES + F.col("_inner"))
        levels.append(inner.drop("_inner"))


def _near(b: str) -> str:
    """Square of the distance of a point from a box."""
    dx, dy = (f"greatest({b}_{c}0 - _p{c}, _p{c} - {b}_{c}1, 0D)" for c in "xy")
    return f"{dx} * {dx} + {dy} * {dy}"


def _far() -> str:
    """Every side of an exact box has a site on it, so one lies within the smaller of two distances."""
    (nx, fx), (ny, fy) = [[f"pow({f}(abs(_p{c} - b._{c}0), abs(_p{c} - b._{c}1)), 2)" for f in ("least", "greatest")] for c in "xy"]
    return f"least({nx} + {fy}, {fx} + {ny})"


SLACK = f"{1 + 1e-12!r}D"  # keeps rounding from dropping the tile that sets the bound


def nearest_join(
    points: DataFrame,
    sites: DataFrame,
    point_id: str,
    site_id: str,
    point_xy: tuple[str, str],
    site_xy: tuple[str, str],
    salts: int = SALTS,
    leaf_sites: int = LEAF_SITES,
) -> DataFrame:
    """Each point with its nearest site (Euclid) and ``distance``; ties go to the smallest id.

    Sites are packed into a tree of tiles of nearly equal counts, so crowded places get small tiles. A point first goes
    down the tree to one promising tile; the nearest site in it sets a bound. Then it goes down to all tiles whose exact
    bounding boxes lie within that bound and meets only their sites. Each step is an equi-join on the tile, so a point
    meets a number of boxes that grows with the logarithm of the sites. Sides that are not small are shuffled.
    Points without coordinates (null or NaN) have a null site. Sites at the same place count once, by their smallest id. ``point_id`` must be unique.
    """
    sx, sy = (F.col(c).cast("double") for c in site_xy)
    places = sites.select(sx.alias("_sx"), sy.alias("_sy"), F.col(site_id).alias("_site")).dropna()
    places = stage_table(places.groupBy("_sx", "_sy").agg(F.min("_site").alias("_site")), "sites")
    size_bytes, n = places.agg(serialised_bytes(), F.count(F.lit(1))).first()
    levels = site_tree(places, n, leaf_sites)
    box = {"_x0": F.min("_sx"), "_x1": F.max("_sx"), "_y0": F.min("_sy"), "_y1": F.max("_sy")}
    boxes = [sited.groupBy("_tile").agg(*[f.alias(c) for c, f in box.items()]) for sited in levels]

    # At most some TOP_TILES rows, one per tile; they enter the plan as one folded constant.
    names = ("t", *box)
    top = _constant([dict(zip(names, b)) for b in boxes[0].collect()], "array<struct<t:bigint,_x0:double,_x1:double,_y0:double,_y1:double>>")
    x, y = F.col("_px"), F.col("_py")
    located = points.select(point_id, *[F.col(c).cast("double").alias(n) for c, n in zip(point_xy, ("_px", "_py"))])
    placed = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    unplaced = located.filter(~placed).select(point_id)

    def meet(probes: DataFrame, side: DataFrame, rows: float) -> DataFrame:
        """An equi-join on tiles; the points of a crowded tile are spread if ``side`` is not known to be small."""
        if may_broadcast(HELD * int(size_bytes * min(rows, n) / max(n, 1))):
            return probes.join(F.broadcast(side), "_tile")
        probes = probes.withColumn("_salt", F.pmod(F.xxhash64(point_id), F.lit(salts)))
        side = side.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        return probes.join(side.hint("merge"), ["_tile", "_salt"]).drop("_salt")

    def below(level: int) -> DataFrame:
        """The boxes of a level by the tile above."""
        return boxes[level].withColumnRenamed("_tile", "_below").withColumn("_tile", F.expr(f"_below div {TOP_TILES}"))

    # Down to one tile of each level, that with the least distance within which a site is known to lie.
    least = "array_min(transform({}, b -> named_struct('d2', {}, 't', b.t))).t"
    # Spread first: points come in few file splits, and the last grouping needs no other shuffle.
    down = located.filter(placed).repartition(point_id).select(point_id, "_px", "_py", F.expr(least.format(top, _far())).alias("_tile"))
    for level in range(1, len(levels)):
        listed = below(level).groupBy("_tile").agg(F.collect_list(F.struct(F.col("_below").alias("t"), *box)).alias("_boxes"))
        down = meet(down, listed, 2 * TOP_TILES**(level + 1)).select(point_id, "_px", "_py", F.expr(least.format("_boxes", _far())).alias("_tile"))
    lists = levels[-1].groupBy("_tile").agg(F.collect_list(F.struct(F.col("_sx").alias("x"), F.col("_sy").alias("y"))).alias("_sites"))
    nearest = "array_min(transform(_sites, s -> (_px - s.x) * (_px - s.x) + (_py - s.y) * (_py - s.y)))"
    bounded = meet(down, lists, n).select(point_id, "_px", "_py", F.expr(f"{nearest} * {SLACK}").alias("_bound"))

    # Down to all tiles that can hold a nearer site or one as near.
    chosen = f"filter({top}, b -> {_near('b.')} <= _bound)"
    probes = bounded.withColumn("_tile", F.expr(f"explode(transform({chosen}, b -> b.t))"))
    for level in range(1, len(levels)):
        probes = meet(probes, below(level), 2 * TOP_TILES**(level + 1)).filter(f"{_near('')} <= _bound")
        probes = probes.select(point_id, "_px", "_py", "_bound", F.col("_below").alias("_tile"))
    met = meet(probes, levels[-1], n).withColumn("_d2", F.expr("(_px - _sx) * (_px - _sx) + (_py - _sy) * (_py - _sy)"))
    best = F.struct(F.col("_d2").alias("d2"), F.col("_site").alias("id"))
    found = met.filter("_d2 <= _bound").groupBy(point_id).agg(F.min(best).alias("_b"))
    found = found.select(point_id, F.col("_b.id").alias(site_id), F.sqrt("_b.d2").alias("distance"))
    none = [F.lit(None).cast(found.schema[c].dataType).alias(c) for c in (site_id, "distance")]
    return found.unionByName(unplaced.select(point_id, *none))

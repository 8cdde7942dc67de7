"""Nearest line of a point, nearest station of a segment, segment centroids."""

from __future__ import annotations

import functools

from pyspark.sql import Window
from pyspark.sql import functions as F

from segment_hours.config import MAX_DISTANCE_M, SEGMENT, SEGMENT_MILES
from segment_hours.functions.geo import (
    chord_km,
    osgb_to_wgs84,
    segment_direction,
    segment_distance,
    unit_vector,
)
from segment_hours.functions.text import segment_id
from segment_hours.session import cut_lineage, spread

# Cells of the first pass are so many times as wide as the mean spacing of points where they are crowded: an entry of a piece in a cell costs
# about as much as ten comparisons. Its radius is a share of the cell, so that most pieces are listed only in cells that they cross.
_CROWDED = 3
_NEAR_SHARE = 1 / 8
# Cells of the first pass are at least this share of the widest radius, and at most so many along a piece of mean length.
_FINEST_SHARE = 1 / 64
_MAX_COLUMNS = 512
# Cells of stations on the unit sphere: the first level has cells of width 1, each further one splits their edges. The last has
# cells of less than a metre. A cell with so few stations is not split.
_CUBE_SPLIT = 4
_CUBE_LEVELS = 13
_LEAF_STATIONS = 32
# The search starts at the finest level with no more cells.
_FIRST_CELLS = 128
_BOUNDS = [f"{name}_{c}" for c in "xyz" for name in ("low", "high")]
# Squared distances may be off by this share and amount, far above their rounding error.
_SLACK = 1 + 1e-9
_TINY = 1e-18
# Covers are a little wider than the radius, so that rounding never loses a partner at its edge.
_MARGIN = 1 + 1e-6


def centroids(df, key=SEGMENT, easting="EASTING", northing="NORTHING"):
    """Mean coordinates per segment."""
    absent = [c for c in (key, easting, northing) if c not in df.columns]
    if absent:
        raise KeyError(f"missing columns: {absent}")
    return df.groupBy(key).agg(F.avg(easting).alias(easting), F.avg(northing).alias(northing))


def centroids_wgs84(df, key=SEGMENT, easting="EASTING", northing="NORTHING"):
    """Centroids in degrees.

    One row per segment, written as a stage: a later filter on the degrees would be pushed through
    every step of the conversion and repeat its expressions each time.
    """
    placed = osgb_to_wgs84(centroids(df, key, easting, northing), easting, northing)
    return cut_lineage(placed.select(key, "Latitude", "Longitude"), "centroids")


def _cell(value, size):
    return F.floor(value / size).cast("bigint")


def _search(points, identity, passes, cells_of_points, cover, distance, found):
    """Nearest shape of each point by passes of growing radius: [(radius, cell, point rows with ``found``)].

    In a pass (radius, cell) every shape is listed in all grid cells (of width ``cell``) that touch its
    surroundings of the radius, and each point looks into its own cell only. A best distance of at most
    the radius is final, as no shape that near can be missing; only the other points go on to the next pass.
    """
    waiting, settled = points, []
    for radius, cell in passes:
        pairs = cells_of_points(waiting, cell).join(cover(radius, cell), ["_i", "_j"])
        best = pairs.groupBy(*identity).agg(found(distance).alias("_best"))
        best = cut_lineage(best.where(F.col("_best._d") <= radius), "nearest")
        settled.append((radius, cell, best))
        if (radius, cell) == passes[-1]:
            break
        # written, so that Spark knows how few they are
        waiting = cut_lineage(waiting.join(best, identity, "left_anti"), "waiting")
        if waiting.isEmpty():
            break
    return settled


def _pieces(lines, geometry):
    """Straight pieces (x1, y1, x2, y2) of each distinct polyline, with the polyline's id."""
    last = F.greatest(F.size(geometry) - 1, F.lit(1))
    ends = F.arrays_zip(
        F.slice(geometry, 1, last).alias("a"),
        F.slice(geometry, F.least(F.lit(2), F.size(geometry)), last).alias("b"),
    )
    pieces = lines.where(F.size(geometry) > 0).select("_line", F.explode(ends).alias("_p"))
    corners = {f"{c}{i}": F.col(f"_p.{end}.{c}") for i, end in ((1, "a"), (2, "b")) for c in "xy"}
    distinct = pieces.select("_line", *[corner.alias(n) for n, corner in corners.items()]).distinct()
    ux, uy = segment_direction(*(F.col(c) for c in ("x1", "y1", "x2", "y2")))
    return distinct.withColumns({"ux": ux, "uy": uy})


def _line_cells(pieces, radius, cell):
    """Grid cells of width ``cell`` within ``radius`` of each piece, column by column."""
    reach = radius * _MARGIN
    low_x, high_x = F.least("x1", "x2"), F.greatest("x1", "x2")
    columns = F.sequence(_cell(low_x - reach, cell), _cell(high_x + reach, cell))
    cut = pieces.withColumn("_i", F.explode(columns))

    def height(x):
        inside = F.greatest(low_x, F.least(high_x, x))
        slope = (F.col("y2") - F.col("y1")) / F.nullif(F.col("x2") - F.col("x1"), F.lit(0.0))
        return F.col("y1") + slope * (inside - F.col("x1"))

    left, right = height(F.col("_i") * cell - reach), height((F.col("_i") + 1) * cell + reach)
    bottom = F.coalesce(F.least(left, right), F.least("y1", "y2"))
    top = F.coalesce(F.greatest(left, right), F.greatest("y1", "y2"))
    # the clipped heights of a near-vertical piece can round past its ends
    bottom = F.greatest(F.least("y1", "y2"), bottom)
    top = F.least(F.greatest("y1", "y2"), top)
    rows = F.sequence(_cell(bottom - reach, cell), _cell(top + reach, cell))
    return cut.withColumn("_j", F.explode(rows))


def _line_passes(spots, pieces, cells_of_points, max_distance):
    """Radius and cell width of each pass: a narrow one by how crowded the points and how long the pieces are, then the widest.

    Narrow cells cost entries of pieces, wide ones comparisons; both are least together where cells are a few times as wide as the spacing of
    the points. Work then grows with the points times the root of their density, not with points times lines.
    """
    counts = cells_of_points(spots, max_distance).groupBy("_i", "_j").agg(F.count("*").cast("double").alias("n"))
    crowd = counts.agg((F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("crowd"))
    length = pieces.agg(F.avg(F.greatest(F.abs(F.col("x2") - F.col("x1")), F.abs(F.col("y2") - F.col("y1")))).alias("length"))
    crowd, length = crowd.first()[0], length.first()[0]
    cell = max_distance * max(_CROWDED / max(crowd or 1.0, 1.0) ** 0.5, _FINEST_SHARE)
    cell = min(max(cell, (length or 0.0) / _MAX_COLUMNS), max_distance)
    return [(cell * _NEAR_SHARE, cell), (max_distance, max_distance)]


def nearest_lines(points, lines, easting, northing, geometry, max_distance=MAX_DISTANCE_M):
    """Pairs (easting, northing, line columns, distance) of each distinct point and its nearest lines.

    ``geometry`` is an array of struct (x, y). Lines at exactly the same distance are all returned,
    copies of a line included. Points further than ``max_distance`` from every line are left out.
    Repeated points and repeated geometries are compared once.
    """
    vertices = F.transform(geometry, lambda p: F.concat_ws(",", p["x"], p["y"]))
    named = lines.withColumn("_line", F.md5(F.concat_ws(";", vertices)))
    corners = ["x1", "y1", "x2", "y2"]
    of_lines = cut_lineage(_pieces(named, geometry), "pieces")
    pieces = of_lines.drop("_line").distinct()
    spots = points.select(F.col(easting).alias("_x"), F.col(northing).alias("_y")).dropna().distinct()
    spots = cut_lineage(spots, "spots")

    def cells_of_points(df, cell):
        return df.withColumns({"_i": _cell(F.col("_x"), cell), "_j": _cell(F.col("_y"), cell)})

    def cover(radius, cell):
        # few rows that each become many: merged by size they would be one task's work
        return _line_cells(spread(pieces, *corners), radius, cell)

    distance = segment_distance(*(F.col(c) for c in ("_x", "_y", *corners, "ux", "uy")))
    passes = _line_passes(spots, pieces, cells_of_points, max_distance)
    settled = _search(
        spots, ["_x", "_y"], passes, cells_of_points, cover, distance, lambda d: F.struct(F.min(d).alias("_d"))
    )
    ties = []
    for radius, cell, best in settled:
        at = cells_of_points(best, cell).join(cover(radius, cell), ["_i", "_j"])
        ties.append(at.where(distance == F.col("_best._d")).select("_x", "_y", "_best._d", *corners))
    nearest = functools.reduce(lambda a, b: a.unionByName(b), ties)
    pairs = nearest.join(of_lines, corners).select("_x", "_y", "_d", "_line").distinct()
    return pairs.join(named.drop(geometry), "_line").select(
        F.col("_x").alias(easting),
        F.col("_y").alias(northing),
        *[c for c in lines.columns if c != geometry],
        F.col("_d").alias("DIST_M"),
    )


def link_locations(
    locations,
    track,
    code="STANOX",
    easting="EASTING",
    northing="NORTHING",
    line="ELR",
    start="START",
    geometry="geometry",
    max_distance=MAX_DISTANCE_M,
    size=SEGMENT_MILES,
    ties=True,
):
    """Segment map: each location with the segment id of its nearest track line.

    Equal distances give one row per line; ``ties=False`` keeps the smallest segment id.
    """
    nearest = nearest_lines(
        locations, track.select(line, start, geometry), easting, northing, geometry, max_distance
    )
    named = nearest.where(F.col(line).isNotNull()).select(
        easting, northing, segment_id(F.col(line), F.col(start), size).alias(SEGMENT)
    )
    if not ties:
        named = named.groupBy(easting, northing).agg(F.min(SEGMENT).alias(SEGMENT))
    return locations.join(named, [easting, northing]).select(SEGMENT, code, easting, northing)


def _on_sphere(df):
    vector = unit_vector(F.col("lat"), F.col("lon"))
    return df.withColumn("_v", vector).withColumns({c: F.col("_v")[c] for c in "xyz"}).drop("_v", "lat", "lon")


def _cube(level):
    """Cell of a position in the grid of a level."""
    return F.struct(*[_cell(F.col(c), 1 / _CUBE_SPLIT**level).alias(c) for c in "xyz"])


def station_index(sites, station="src_id", leaf=_LEAF_STATIONS):
    """Occupied cells of all levels: (nodes, leaves). ``sites`` are (year, x, y, z, station), one a position.

    A node (year, level, cell, n, bounds of its stations) has as parent the cell around it. A cell with at most ``leaf`` stations is
    a leaf and has no finer ones, so places that are dense get as many levels as they need. ``leaves`` holds the stations by leaf.
    """
    levels = F.array(*[F.struct(F.lit(i).alias("level"), _cube(i).alias("cell")) for i in range(_CUBE_LEVELS)])
    listed = sites.select("year", "x", "y", "z", station, F.explode(levels).alias("_l")).select("*", "_l.level", "_l.cell").drop("_l")
    bounds = [end(c).alias(f"{name}_{c}") for c in "xyz" for name, end in (("low", F.min), ("high", F.max))]
    nodes = listed.groupBy("year", "level", "cell").agg(F.count("*").alias("n"), *bounds)
    nodes = nodes.withColumn("leaf", (F.col("n") <= leaf) | (F.col("level") == _CUBE_LEVELS - 1))
    over = F.transform(F.array(*[f"cell.{c}" for c in "xyz"]), lambda v: F.floor(v / _CUBE_SPLIT))
    parent = F.struct(*[over[i].alias(c) for i, c in enumerate("xyz")])
    nodes = cut_lineage(nodes.withColumn("parent", parent), "cells")
    settled = listed.join(nodes.where("leaf").select("year", "level", "cell"), ["year", "level", "cell"])
    first = F.min(F.struct("level", "cell")).alias("_at")
    leaves = settled.groupBy("year", "x", "y", "z", station).agg(first).select("*", "_at.level", "_at.cell").drop("_at")
    return nodes, leaves.withColumnsRenamed({c: f"s{c}" for c in "xyz"})


def _first_level(nodes):
    """The finest level that has few cells, the leaves above it included; the first one has at most 27 a year."""
    counts = {r["level"]: r for r in nodes.groupBy("level").agg(F.count("*").alias("n"), F.count_if("leaf").alias("leaves")).collect()}
    found, above = 0, 0
    for level in sorted(counts):
        if level and counts[level]["n"] + above > _FIRST_CELLS:
            break
        found, above = level, above + counts[level]["leaves"]
    return found


def nearby_leaves(spots, nodes, key):
    """(key, year, x, y, z, level, cell): leaves that may hold the station nearest to a spot (key, year, x, y, z).

    Level by level, a spot keeps the cells that begin no further away than the cell that ends nearest, and goes on to the
    cells within. Far stations are thus told apart by a few coarse cells, however many there are.
    """
    low = sum(F.pow(F.greatest(F.col(f"low_{c}") - F.col(c), F.col(c) - F.col(f"high_{c}"), F.lit(0.0)), 2) for c in "xyz")
    high = sum(F.pow(F.greatest(F.col(c) - F.col(f"low_{c}"), F.col(f"high_{c}") - F.col(c)), 2) for c in "xyz")
    spot = [*key, "year", "x", "y", "z"]
    start = _first_level(nodes)
    # A bounded table: a few cells, all of one level but for leaves above it.
    top = nodes.where((F.col("level") == start) | (F.col("leaf") & (F.col("level") < start))).drop("parent", "n")
    near = spots.select(*spot).join(F.broadcast(top), "year").withColumn("_top", F.lit(4.0) * _SLACK)
    for level in range(start, _CUBE_LEVELS):
        within = Window.partitionBy(*key, "year")
        near = near.withColumns({"_low": F.coalesce("_low", low) if "_low" in near.columns else low, "_high": high})
        near = near.withColumn("_top", F.least("_top", F.min("_high").over(within)))
        near = near.where(F.col("_low") <= F.col("_top") * _SLACK + _TINY)
        near = cut_lineage(near.select(*spot, "level", "cell", "leaf", "_low", "_top", *_BOUNDS), "near-cells")
        inner = near.where(~F.col("leaf"))
        if level == _CUBE_LEVELS - 1 or inner.isEmpty():
            break
        finer = nodes.where(F.col("level") == level + 1).withColumnRenamed("parent", "_parent")
        own = inner.select(*spot, F.col("cell").alias("_parent"), "_top")
        finer = own.join(finer, ["year", "_parent"]).drop("_parent", "n").withColumn("_low", F.lit(None).cast("double"))
        near = near.where("leaf").select(*spot, "level", "cell", "leaf", "_low", "_top", *_BOUNDS).unionByName(finer)
    return near.where("leaf").select(*spot, "level", "cell")


def nearest_stations(places, stations, years, place="loc_id", station="src_id"):
    """Station nearest to each place in each year: place, year, station and distance in km.

    Both sides have lat and lon in degrees; stations have a year. The smallest id wins a tie. Rows without a place or position have no
    station, nor has a place in a year without stations. Positions are compared in leaves of :func:`station_index` only.
    """
    spots = _on_sphere(places.select(place, "lat", "lon").dropna().distinct())
    spots = spots.withColumn("year", F.explode(F.array(*[F.lit(int(y)) for y in years])))
    sites = stations.where(F.col("year").isin([int(y) for y in years])).groupBy("year", "lat", "lon")
    sites = _on_sphere(sites.agg(F.min(station).alias(station)).dropna())
    nodes, leaves = station_index(sites, station)
    near = nearby_leaves(spots, nodes, [place])

    def gap(c):
        return F.col(c) - F.col(f"s{c}")

    distance = F.sqrt(gap("x") * gap("x") + gap("y") * gap("y") + gap("z") * gap("z"))
    best = near.join(leaves, ["year", "level", "cell"]).groupBy(place, "year").agg(F.min(F.struct(distance.alias("_d"), station)).alias("_best"))
    return best.select(
        place, "year", F.col("_best")[station].alias(station), chord_km(F.col("_best._d")).alias("distance_km")
    )

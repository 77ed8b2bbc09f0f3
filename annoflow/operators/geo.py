"""Geo enrichment.

Countries are a small input table: ``iso_a2, name_en, region_wb, subregion,
rings array<array<struct<lon,lat>>>`` plus a table order ``ord`` (a point
inside several polygons gets the first one, as in the reference).

Point-in-country goes by a grid index: a cell holds the edges of a country that touch it and whether its upper right
corner lies inside, or, if no edge touches it, that it lies wholly inside.  A point joins its cell only, and walks
from itself to that corner: the country's edges on this way, with the corner, tell its side.  Points inside no polygon get the
nearest country by planar point-segment distance, searched in growing neighbourhoods until the nearest candidate is
provably closer than any country outside; there, whole cells are ruled out by their distance before edges are
looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annoflow.session import stage

# Fixed values (country table repair): codes missing from the source data and
# territories mapped onto the polygon of a neighbouring country.
CODE_REPAIRS = {"France": "FR", "Norway": "NO"}
EXTRA_CODES = [("Serbia", "CS"), ("Dominica", "MQ"), ("Dominica", "GP"), ("Madagascar", "RE"),
               ("Madagascar", "YT"), ("Suriname", "GF")]
INVALID_CODE = "-99"


def prepare_countries(df: DataFrame) -> DataFrame:
    """Repair FR/NO codes, add CS, MQ, GP, RE, YT, GF copies, drop '-99'."""
    fixed = df
    for name, code in CODE_REPAIRS.items():
        fixed = fixed.withColumn("iso_a2", F.when(F.col("name_en") == name, F.lit(code)).otherwise(F.col("iso_a2")))
    last = fixed.agg(F.max("ord")).first()[0] or 0
    extra = F.array(*[F.struct(F.lit(name).alias("_of"), F.lit(code).alias("_code"), F.lit(last + 1 + i).alias("_ord"))
                      for i, (name, code) in enumerate(EXTRA_CODES)])
    first = (fixed.where(F.col("name_en").isin(*{name for name, _ in EXTRA_CODES}))
             .groupBy("name_en").agg(F.min_by(F.struct(*fixed.columns), "ord").alias("r")))
    copies = (first.select("r.*", F.inline(extra)).where(F.col("_of") == F.col("name_en"))
              .withColumns({"iso_a2": F.col("_code"), "ord": F.col("_ord").cast(df.schema["ord"].dataType)}))
    return fixed.unionByName(copies.select(*fixed.columns)).where(F.col("iso_a2") != INVALID_CODE)


#: Slack in degrees by which edges are given to neighbouring cells, against rounding.
_EPS = 1e-9


def country_edges(countries: DataFrame) -> DataFrame:
    """ord, iso_a2 and one ring edge (ax, ay)-(bx, by) a row."""
    def edges(ring):
        n = F.size(ring)
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.struct(
            ring[i]["lon"].alias("ax"), ring[i]["lat"].alias("ay"),
            ring[F.when(i == 0, n - 1).otherwise(i - 1)]["lon"].alias("bx"), ring[F.when(i == 0, n - 1).otherwise(i - 1)]["lat"].alias("by"))))
    rings = countries.select("ord", "iso_a2", F.explode("rings").alias("ring"))
    return rings.select("ord", "iso_a2", F.inline(edges(F.col("ring"))))


def _x_at(y, e=F.col) -> Column:
    """Where an edge meets the height y."""
    return (e("bx") - e("ax")) * (y - e("ay")) / (e("by") - e("ay")) + e("ax")


def _cells_between(lo: Column, hi: Column, cell: float) -> Column:
    return F.sequence(F.floor(lo / cell).cast("int"), F.floor(hi / cell).cast("int"))


def country_grid(countries: DataFrame, cell: float = 1.0) -> DataFrame:
    """The index: cx, cy, ord, iso_a2, edges (those that touch the closed cell), corner (1: its upper right corner is inside).

    ``cell`` should be a power of two, so that cell borders are exact.  A country has rows for cells that an edge touches and for
    those that lie wholly inside (no edges, corner 1).
    """
    edges = country_edges(countries)
    low, high = F.least("ay", "by"), F.greatest("ay", "by")
    rows = edges.withColumn("cy", F.explode(_cells_between(low - _EPS, high + _EPS, cell)))
    # The part of the edge within its row of cells.
    y0 = F.least(F.greatest(low, F.col("cy") * cell), high)
    y1 = F.greatest(F.least(high, (F.col("cy") + 1) * cell), low)
    flat = F.col("ay") == F.col("by")
    x0, x1 = F.when(flat, F.col("ax")).otherwise(_x_at(y0)), F.when(flat, F.col("bx")).otherwise(_x_at(y1))
    touched = (rows.withColumn("cx", F.explode(_cells_between(F.least(x0, x1) - _EPS, F.greatest(x0, x1) + _EPS, cell)))
               .groupBy("ord", "iso_a2", "cx", "cy").agg(F.collect_list(F.struct("ax", "ay", "bx", "by")).alias("edges")))
    # Of each row's upper line: the last cells whose right end lies before a crossing edge.  A corner is inside if an
    # odd number of crossings lies beyond it.
    top = (F.col("cy") + 1) * cell
    lines = (edges.withColumn("cy", F.explode(_cells_between(low - cell, high, cell)))
             .where((F.col("ay") > top) != (F.col("by") > top))
             .groupBy("ord", "iso_a2", "cy").agg(F.sort_array(F.collect_list((F.ceil(_x_at(top) / cell) - 2).cast("int")), asc=False).alias("last")))
    beyond = F.size(F.filter(F.coalesce("last", F.array().cast("array<int>")), lambda c: c >= F.col("cx")))
    border = touched.join(lines.select("ord", "cy", "last"), ["ord", "cy"], "left").withColumn("corner", beyond % 2).drop("last")
    spans = F.transform(F.sequence(F.lit(0), (F.size("last") / 2 - 1).cast("int")), lambda i: F.struct(
        (F.get("last", (2 * i + 1).cast("int")) + 1).alias("a"), F.get("last", (2 * i).cast("int")).alias("b")))
    inner = (lines.select("ord", "iso_a2", "cy", F.inline(spans)).where("a <= b")
             .select("ord", "iso_a2", "cy", F.explode(F.sequence("a", "b")).alias("cx"))
             .join(touched.select("ord", "cx", "cy"), ["ord", "cx", "cy"], "left_anti")
             .withColumns({"edges": F.array().cast(touched.schema["edges"].dataType), "corner": F.lit(1)}))
    return border.unionByName(inner)


def _side(x: Column, y: Column, cell: float) -> Column:
    """Crossings, of the cell's edges, on the way from (x, y) right to the cell's border and up to its corner.

    The border counts as a little more than it is, and heights as still less more: an edge that only touches is met once or
    not at all, and one through a corner of the way falls to the same side wherever it is asked.
    """
    right, top = (F.col("cx") + 1) * cell, (F.col("cy") + 1) * cell

    def met(acc, e):
        at = e.getField
        x_cross = _x_at(y, at)
        across = ((at("ay") > y) != (at("by") > y)) & (x < x_cross) & (x_cross <= right)
        y_cross = (at("by") - at("ay")) * (right - at("ax")) / (at("bx") - at("ax")) + at("ay")
        rises = (at("by") - at("ay")) * (at("bx") - at("ax")) > 0
        up = (((at("ax") > right) != (at("bx") > right)) & ((y < y_cross) | ((y == y_cross) & rises))
              & ((y_cross < top) | ((y_cross == top) & ~rises)))
        return acc + F.when(across, 1).otherwise(0) + F.when(up, 1).otherwise(0)
    return F.aggregate("edges", F.lit(0), met)


def _edge_distance(x: Column, y: Column) -> Column:
    """Planar distance from (x, y) to the nearest of the cell's edges; null if it has none."""
    def seg(e):
        ax, ay, dx, dy = e["ax"], e["ay"], e["bx"] - e["ax"], e["by"] - e["ay"]
        len2 = dx * dx + dy * dy
        t = F.when(len2 == 0, F.lit(0.0)).otherwise(
            F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - ax) * dx + (y - ay) * dy) / len2)))
        px, py = ax + t * dx, ay + t * dy
        return F.sqrt((x - px) * (x - px) + (y - py) * (y - py))
    return F.array_min(F.transform("edges", seg))


def point_countries(points: DataFrame, countries: DataFrame, cell: float = 1.0) -> DataFrame:
    """G2 + G3 on distinct points ``(_x, _y)`` -> ``country_code``.

    Exact containment first (first polygon in table order), then the nearest
    country for points inside none.  A point on a border is inside none; among
    countries equally near the first in table order wins.
    """
    uniq = stage(points.select("_x", "_y").where(F.col("_x").isNotNull() & F.col("_y").isNotNull()).distinct(), "points")
    grid = stage(country_grid(countries, cell), "grid")
    x, y = F.col("_x"), F.col("_y")
    keyed = uniq.withColumns({"cx": F.floor(x / cell).cast("int"), "cy": F.floor(y / cell).cast("int")})
    inside = (keyed.join(grid, ["cx", "cy"])
              .where(((F.col("corner") + _side(x, y, cell)) % 2 == 1) & F.coalesce(_edge_distance(x, y) > 0, F.lit(True)))
              .groupBy("_x", "_y").agg(F.min_by("iso_a2", "ord").alias("country_code")))
    inside = stage(inside, "inside")
    outside = uniq.join(inside.select("_x", "_y"), ["_x", "_y"], "left_anti")
    return inside.unionByName(_nearest(outside, grid.where(F.size("edges") > 0), cell))


def country_of_points(points: DataFrame, countries: DataFrame, lon: str = "longitude", lat: str = "latitude",
                      key: str = "id", cell: float = 1.0) -> DataFrame:
    """G2 + G3: ``key -> country_code``; duplicate coordinates are resolved once."""
    pts = points.select(key, F.col(lon).alias("_x"), F.col(lat).alias("_y"))
    found = point_countries(pts, countries, cell)
    return pts.join(found, ["_x", "_y"], "left").select(key, "country_code")


def _nearest(points: DataFrame, grid: DataFrame, cell: float) -> DataFrame:
    """Nearest country of points that lie in none.  ``grid``: the cells that have edges.

    Round k searches a square of half-width ``cell * 2**k`` around each point.  Beyond four cells squares of cells
    (size = half-width / 4) are looked up, at most 9 x 9 a point whatever the radius.  A cell found is at most as far as
    its farthest corner; only cells that begin within the least of these are asked for their edges.  A country outside the
    square is farther than its half-width, so the best candidate is final once its distance is within it.  The last
    round's square covers all countries from any point, so every point gets a country if there is one.
    """
    none = points.select("_x", "_y", F.lit(None).cast("string").alias("country_code")).limit(0)
    if points.isEmpty() or grid.isEmpty():
        return none
    occupied = stage(grid.select("cx", "cy").distinct(), "occupied")
    todo = points = stage(points, "outside")
    extent = max(points.agg(F.max(F.greatest(F.abs("_x"), F.abs("_y")))).first()[0],
                 cell * (1 + occupied.agg(F.max(F.greatest(F.abs("cx"), F.abs("cy")))).first()[0]))
    x, y, result, k = F.col("_x"), F.col("_y"), none, -1
    while not todo.isEmpty():
        k += 1
        radius = cell * (2 ** k)
        size = cell if radius <= 4 * cell else radius / 4.0
        r = int(math.ceil(radius / size))
        offs = F.sequence(F.lit(-r), F.lit(r))
        squares = occupied.withColumns({"sx": F.floor(F.col("cx") * cell / size).cast("int"), "sy": F.floor(F.col("cy") * cell / size).cast("int")})
        left, low = F.col("cx") * cell, F.col("cy") * cell
        gap = lambda v, lo: F.greatest(lo - v, v - lo - cell, F.lit(0.0))
        far = lambda v, lo: F.greatest(F.abs(v - lo), F.abs(v - lo - cell))
        met = (todo.withColumn("_dx", F.explode(offs)).withColumn("_dy", F.explode(offs))
               .withColumns({"sx": (F.floor(x / size) + F.col("_dx")).cast("int"), "sy": (F.floor(y / size) + F.col("_dy")).cast("int")})
               .join(squares, ["sx", "sy"])
               .select("_x", "_y", "cx", "cy", F.hypot(gap(x, left), gap(y, low)).alias("near"), F.hypot(far(x, left), far(y, low)).alias("far")))
        asked = (met.groupBy("_x", "_y").agg(F.collect_list(F.struct("cx", "cy", "near")).alias("cells"), F.min("far").alias("bound"))
                 .select("_x", "_y", F.inline(F.filter("cells", lambda c: c["near"] <= F.col("bound") + 1e-6))))
        found = asked.join(grid, ["cx", "cy"]).withColumn("_d", _edge_distance(x, y))
        best = stage(found.groupBy("_x", "_y").agg(F.min_by(F.struct("iso_a2", "_d"), F.struct("_d", "ord")).alias("b")), "nearest")
        last = radius >= 2 * extent
        sure = best.where(F.lit(last) | (F.col("b._d") <= r * size)).select("_x", "_y", F.col("b.iso_a2").alias("country_code"))
        result = result.unionByName(sure)
        todo = todo.join(sure.select("_x", "_y"), ["_x", "_y"], "left_anti")
        if last:
            break
    return result


def ring_centroid(ring: Column) -> Column:
    """Polygon centroid (shoelace) of a ring of [lon, lat] pairs; zero area -> mean point."""
    n = F.size(ring)
    idx = F.sequence(F.lit(0), n - 1)

    def nxt(i):
        return ring[F.when(i == n - 1, 0).otherwise(i + 1)]

    def cross(i):
        a, b = ring[i], nxt(i)
        return a[0] * b[1] - b[0] * a[1]
    area2 = F.aggregate(F.transform(idx, cross), F.lit(0.0), lambda s, v: s + v)
    cx = F.aggregate(F.transform(idx, lambda i: (ring[i][0] + nxt(i)[0]) * cross(i)), F.lit(0.0), lambda s, v: s + v)
    cy = F.aggregate(F.transform(idx, lambda i: (ring[i][1] + nxt(i)[1]) * cross(i)), F.lit(0.0), lambda s, v: s + v)
    mean_x = F.aggregate(F.transform(ring, lambda p: p[0]), F.lit(0.0), lambda s, v: s + v) / n
    mean_y = F.aggregate(F.transform(ring, lambda p: p[1]), F.lit(0.0), lambda s, v: s + v) / n
    zero = F.abs(area2) < F.lit(1e-15)
    return F.struct(F.when(zero, mean_x).otherwise(cx / (3 * area2)).alias("lon"),
                    F.when(zero, mean_y).otherwise(cy / (3 * area2)).alias("lat"))


def location_key(c: Column) -> Column:
    """Normalised free-text location: lower case, non-alphanumerics -> single spaces."""
    return F.trim(F.regexp_replace(F.lower(c), "[^\\p{L}\\p{N}]+", " "))


def gazetteer_matches(locations: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Decode distinct location keys ``_loc`` with a gazetteer table.

    A place is looked for only where the one or two words that a name begins with stand: a table of these beginnings has the lengths
    of the names that follow, and only word sequences of these lengths are formed and joined with the names.  The longest match wins,
    then the larger population.
    Returns _loc, longitude, latitude, country_code, geoname_id, location_type.
    """
    distinct = locations.select("_loc").where(F.length("_loc") > 0).distinct()
    gaz = gazetteer.select(location_key(F.col("name")).alias("_name"), "longitude", "latitude", "country_code",
                           "geoname_id", "location_type", "population")
    begins = lambda words, i, k: F.array_join(F.slice(words, i, k), " ")
    words = F.split("_name", " ")
    heads = (gaz.select(begins(words, 1, 2).alias("head"), F.size(words).alias("len")).groupBy("head")
             .agg(F.collect_set("len").alias("lens")))
    words = F.split("_loc", " ")
    at = F.sequence(F.lit(1), F.size(words))
    places = distinct.select("_loc", F.explode(at).alias("i")).select("_loc", "i", F.explode(F.array_distinct(F.array(
        begins(words, F.col("i"), F.lit(1)), begins(words, F.col("i"), F.lit(2))))).alias("head"))
    grams = (places.join(heads, "head").select("_loc", "i", F.explode("lens").alias("len")).where(F.col("i") + F.col("len") - 1 <= F.size(words))
             .select("_loc", F.struct(begins(words, F.col("i"), F.col("len")).alias("name"), "len").alias("g")))
    hits = grams.join(gaz, grams["g"]["name"] == gaz["_name"])
    best = hits.groupBy("_loc").agg(F.max_by(
        F.struct("longitude", "latitude", "country_code", "geoname_id", "location_type"),
        F.struct(F.col("g.len"), F.col("population"), F.col("geoname_id"))).alias("b"))
    return best.select("_loc", "b.*")


def locate_by_gazetteer(df: DataFrame, gazetteer: DataFrame, location: str = "user_location",
                        key: str = "id") -> DataFrame:
    """G5 per row: key, longitude, latitude, country_code, geoname_id, location_type."""
    locs = df.select(key, location_key(F.col(location)).alias("_loc"))
    return locs.join(gazetteer_matches(locs, gazetteer), "_loc").drop("_loc")


def basics(rec: DataFrame, coords: str = "_coordinates", place: str = "_place") -> DataFrame:
    """G1 without lookups: branches 1 (coordinates) and 2 (place box) only;
    the country is the one the place names (null when empty or absent)."""
    c, p = F.col(coords), F.col(place)
    has_xy = c.isNotNull() & (F.size(c) >= 2)
    ring = p["bounding_box"]["coordinates"][0]
    has_box = ~has_xy & p.isNotNull() & ring.isNotNull() & (F.size(ring) > 0)
    centre = ring_centroid(ring)
    return (rec.withColumn("geo_type", F.when(has_xy, 1).when(has_box, 2).otherwise(0).cast("int"))
            .withColumn("longitude", F.when(has_xy, c[0]).when(has_box, centre["lon"]))
            .withColumn("latitude", F.when(has_xy, c[1]).when(has_box, centre["lat"]))
            .withColumn("country_code", F.when(has_box, F.nullif(p["country_code"], F.lit(""))))
            .withColumn("location_type", F.when(has_box, p["place_type"]))
            .withColumn("geoname_id", F.lit(None).cast("string"))
            .withColumn("region", F.lit(None).cast("string"))
            .withColumn("subregion", F.lit(None).cast("string"))
            .drop(coords, place))


def enrich(rec: DataFrame, countries: DataFrame, gazetteer: DataFrame | None = None,
           coords: str = "_coordinates", place: str = "_place", location: str = "user_location") -> DataFrame:
    """G1: geo cascade -> longitude, latitude, country_code, geoname_id,
    location_type, geo_type (1 coordinates, 2 place box, 3 user location, 0 none),
    region, subregion.

    Rows are split by branch, and only those of a branch are joined: rows with coordinates or a
    place without a country meet the distinct points; rows with nothing but a location text
    meet the distinct locations, whose points are resolved before; all others are not
    shuffled.  ``rec`` is read once per branch, so pass stored rows.
    """
    c, p = F.col(coords), F.col(place)
    has_xy = c.isNotNull() & (F.size(c) >= 2)
    ring = p["bounding_box"]["coordinates"][0]
    has_box = ~has_xy & p.isNotNull() & ring.isNotNull() & (F.size(ring) > 0)
    centre = ring_centroid(ring)
    countries = countries.checkpoint(eager=True)
    none = F.lit(None).cast("string")

    direct = (rec.where(has_xy | has_box)
              .withColumn("geo_type", F.when(has_xy, 1).otherwise(2))
              .withColumn("longitude", F.when(has_xy, c[0]).otherwise(centre["lon"]))
              .withColumn("latitude", F.when(has_xy, c[1]).otherwise(centre["lat"]))
              .withColumn("country_code", F.when(has_box, p["country_code"]))
              .withColumn("geoname_id", none)
              .withColumn("location_type", F.when(has_box, p["place_type"])))
    need = (F.col("geo_type") == 1) | F.coalesce(F.col("country_code") == "", F.lit(False))
    text_only = rec.where(~F.coalesce(has_xy | has_box, F.lit(False))).withColumn("_loc", location_key(F.col(location)))
    known = F.lit(False) if gazetteer is None else F.coalesce(F.length("_loc") > 0, F.lit(False))
    nowhere = (text_only.where(~known).drop("_loc").withColumn("geo_type", F.lit(0))
               .withColumns({"longitude": F.lit(None).cast("double"), "latitude": F.lit(None).cast("double")})
               .withColumns({n: none for n in ("country_code", "geoname_id", "location_type")}))

    xy = [F.col("longitude").alias("_x"), F.col("latitude").alias("_y")]
    points = direct.where(need).select(*xy)
    if gazetteer is not None:
        matches = gazetteer_matches(text_only.where(known), gazetteer).checkpoint(eager=True)
        unnamed = F.col("country_code") == ""
        points = points.unionByName(matches.where(unnamed).select(*xy))
    found = point_countries(points, countries).select("_x", "_y", F.col("country_code").alias("_pip"))

    def resolve(rows: DataFrame) -> DataFrame:
        at = (F.col("longitude") == F.col("_x")) & (F.col("latitude") == F.col("_y"))
        return rows.join(found, at, "left").withColumn("country_code", F.col("_pip")).drop("_x", "_y", "_pip")

    parts = [resolve(direct.where(need)), direct.where(~need), nowhere]
    if gazetteer is not None:
        places = matches.where(~F.coalesce(unnamed, F.lit(False))).unionByName(resolve(matches.where(unnamed)))
        places = places.select("_loc", "longitude", "latitude", "country_code", F.col("geoname_id").cast("string"),
                               "location_type", F.lit(3).alias("_type"))
        parts.append(text_only.where(known).join(places, "_loc", "left").drop("_loc")
                     .withColumn("geo_type", F.coalesce("_type", F.lit(0))).drop("_type"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return region_lookup(out.withColumn("geo_type", F.col("geo_type").cast("int")).drop(coords, place), countries)


def region_lookup(df: DataFrame, countries: DataFrame, code: str = "country_code") -> DataFrame:
    """Region and subregion by ISO-A2 (unknown codes give nulls)."""
    regions = countries.groupBy("iso_a2").agg(F.min_by(F.struct("region_wb", "subregion"), "ord").alias("r"))
    regions = regions.select(F.col("iso_a2").alias(code), F.col("r.region_wb").alias("region"),
                             F.col("r.subregion").alias("subregion"))
    return df.join(regions, code, "left")

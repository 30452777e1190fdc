"""Geometry as Column expressions: distances, cells, containment, areas.

Polygons are nested arrays (polygon, ring, point [lng, lat]); the first ring is the outer one.
For joins they are unfolded into edge tables, so containment is a count of crossed edges.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .binding import let

EARTH_M, KM_PER_DEGREE = 6_371_000.0, 111.32
COUNTRY_BOX = (42.30, 46.60, 13.40, 19.50)
POLYGONS = "array<array<array<array<double>>>>"


def in_country(lat: Column, lng: Column) -> Column:
    south, north, west, east = COUNTRY_BOX
    return lat.between(south, north) & lng.between(west, east)


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    # least would take the 1 where a place is unknown; null stays null
    return 2 * EARTH_M * F.asin(F.sqrt(F.when(a > 1, 1.0).otherwise(a)))


def plane_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    return KM_PER_DEGREE * F.hypot(lat2 - lat1, (lng2 - lng1) * F.cos(F.radians((lat1 + lat2) / 2)))


def degrees2(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Squared distance in degrees of latitude."""
    return F.pow(lat2 - lat1, 2) + F.pow((lng2 - lng1) * F.cos(F.radians((lat1 + lat2) / 2)), 2)


def _columns(cy: Column, degrees: float) -> Column:
    """Cells in a row of the grid: each is wide enough that no radius from its row or the neighbouring ones spans more than two."""
    top = F.least(F.greatest(F.abs(cy * degrees), F.abs((cy + 1) * degrees)) + degrees, F.lit(90.0))
    return F.greatest(F.floor(360.0 * F.cos(F.radians(top)) / degrees), F.lit(1)).cast("bigint")


def cell(lat: Column, lng: Column, degrees: float) -> Column:
    """struct(cx, cy) of a grid for radii of so many degrees of latitude; rows near the poles have fewer, wider cells."""
    cy = F.floor(lat / degrees)
    return let(cy, lambda y: F.struct(F.pmod(F.floor((lng + 180.0) * _columns(y, degrees) / 360.0), _columns(y, degrees)).alias("cx"), y.alias("cy")))


def cells_around(lat: Column, lng: Column, degrees: float) -> Column:
    """All cells that hold points within the radius of a point: its own and its neighbours, also over the date line."""
    steps = F.sequence(F.lit(-1), F.lit(1))

    def row(lng: Column, y: Column) -> Column:
        return let(_columns(y, degrees), lambda n: F.transform(steps, lambda d: F.struct(F.pmod(F.floor((lng + 180.0) * n / 360.0) + d, n).alias("cx"), y.alias("cy"))))

    def rows(at: Column) -> Column:
        return F.array_distinct(F.flatten(F.transform(F.transform(steps, lambda d: F.floor(at["lat"] / degrees) + d), lambda y: row(at["lng"], y))))

    return let(F.when(lat.isNotNull() & lng.isNotNull(), F.struct(lat.alias("lat"), lng.alias("lng"))), rows)


def degrees_of(radius_km: float) -> float:
    """Degrees of latitude of a radius on the sphere, with a hundredth to spare."""
    return radius_km * 1000 / EARTH_M * 180 / math.pi * 1.01


def edges(layer: DataFrame, key: str, polygons: str = "polygons") -> DataFrame:
    """(key, part, x1, y1, x2, y2): one row for each side of each ring; a ring need not be closed."""
    parts = layer.select(key, F.posexplode(polygons).alias("part", "polygon")).select(key, "part", F.posexplode("polygon").alias("ring", "points"))
    n = F.size("points")
    side = F.transform("points", lambda p, k: F.struct(p[0].alias("x1"), p[1].alias("y1"), F.get(F.get("points", (k + 1) % n), F.lit(0)).alias("x2"), F.get(F.get("points", (k + 1) % n), F.lit(1)).alias("y2")))
    return parts.select(key, "part", "ring", F.explode(side).alias("e")).select(key, "part", "ring", "e.*")


def crosses(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Whether a ray from (x, y) towards greater x meets the side; its lower end counts, its upper one doesn't."""
    return ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / F.nullif(y2 - y1, F.lit(0.0)) + x1)


def _steps(ring: Column) -> Column:
    n = F.size(ring)
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Ray casting over a ring as an array, without a join."""

    def odd(ring: Column) -> Column:
        def side(k: Column) -> Column:
            return let(F.struct(F.get(ring, k).alias("a"), F.get(ring, (k + 1) % F.size(ring)).alias("b")), lambda s: F.coalesce(crosses(x, y, s["a"][0], s["a"][1], s["b"][0], s["b"][1]), F.lit(False)).cast("int"))

        return F.aggregate(_steps(ring), F.lit(0), lambda s, k: s + side(k)) % 2 == 1

    return let(ring, odd)


def in_polygons(x: Column, y: Column, polygons: Column) -> Column:
    """In the outer ring of a part and in none of its holes."""

    def holds(at: Column, p: Column) -> Column:
        return in_ring(at["x"], at["y"], F.get(p, F.lit(0))) & ~F.exists(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), lambda hole: in_ring(at["x"], at["y"], hole))

    return let(F.struct(x.alias("x"), y.alias("y")), lambda at: F.exists(polygons, lambda p: holds(at, p)))


def ring_area(ring: Column) -> Column:
    """Unsigned shoelace area in square degrees."""

    def area(ring: Column) -> Column:
        cross = lambda k: let(F.struct(F.get(ring, k).alias("a"), F.get(ring, (k + 1) % F.size(ring)).alias("b")), lambda s: s["a"][0] * s["b"][1] - s["b"][0] * s["a"][1])
        return F.abs(F.aggregate(_steps(ring), F.lit(0.0), lambda s, k: s + cross(k))) / 2

    return let(ring, area)


def ring_centroid(ring: Column) -> Column:
    """struct(lng, lat) of the area's centre; a ring without area gives its first point."""

    def centre(ring: Column) -> Column:
        def add(s: Column, k: Column) -> Column:
            return let(F.struct(F.get(ring, k).alias("a"), F.get(ring, (k + 1) % F.size(ring)).alias("b")), lambda e: let(e["a"][0] * e["b"][1] - e["b"][0] * e["a"][1], lambda c: F.struct((s["a"] + c).alias("a"), (s["x"] + (e["a"][0] + e["b"][0]) * c).alias("x"), (s["y"] + (e["a"][1] + e["b"][1]) * c).alias("y"))))

        zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
        first = F.get(ring, F.lit(0))
        point = lambda s: F.when(F.abs(s["a"]) < 1e-15, F.struct(first[0].alias("lng"), first[1].alias("lat"))).otherwise(F.struct((s["x"] / (3 * F.nullif(s["a"], F.lit(0.0)))).alias("lng"), (s["y"] / (3 * F.nullif(s["a"], F.lit(0.0)))).alias("lat")))
        return let(F.aggregate(_steps(ring), zero, add), point)

    return let(ring, centre)


def biggest(polygons: Column, by: str = "area") -> Column:
    """The polygon with the greatest outer ring, by area or by number of points."""
    size = (lambda p: ring_area(F.get(p, F.lit(0)))) if by == "area" else (lambda p: F.size(F.get(p, F.lit(0))).cast("double"))
    ranked = F.transform(F.filter(polygons, lambda p: F.size(p) > 0), lambda p, k: F.struct(size(p).alias("s"), (-k).alias("k"), p.alias("p")))
    return F.array_max(ranked)["p"]


def representative_point(polygons: Column) -> Column:
    """struct(lat, lng) truly inside: the centre, else the middle of the widest span on one of five scan lines."""
    return let(biggest(polygons), _inner_point)


def _inner_point(polygon: Column) -> Column:
    outer = F.get(polygon, F.lit(0))
    spot = lambda lng, lat: F.when(in_polygons(lng, lat, F.array(polygon)), F.struct(lat.alias("lat"), lng.alias("lng")))

    def on_line(y: Column) -> Column:
        def hits(ring: Column) -> Column:
            n = F.size(ring)
            return F.filter(F.transform(F.sequence(F.lit(0), n - 1), lambda k: _hit(F.get(ring, k), F.get(ring, (k + 1) % n), y)), lambda s: s.isNotNull())

        def widest(xs: Column) -> Column:
            spans = F.transform(F.sequence(F.lit(0), F.greatest(F.floor(F.size(xs) / 2).cast("int") - 1, F.lit(0))), lambda k: F.struct((F.get(xs, 2 * k + 1) - F.get(xs, 2 * k)).alias("w"), (-k).alias("k"), ((F.get(xs, 2 * k + 1) + F.get(xs, 2 * k)) / 2).alias("x")))
            return F.array_max(F.filter(spans, lambda s: s["w"].isNotNull()))["x"]

        return let(let(F.array_sort(F.flatten(F.transform(polygon, hits))), widest), lambda x: spot(x, y))

    def lines(ys: Column) -> Column:
        tried = F.transform(F.array(*(F.lit(v) for v in (0.5, 0.35, 0.65, 0.2, 0.8))), lambda share: let(F.array_min(ys) + (F.array_max(ys) - F.array_min(ys)) * share, on_line))
        return F.get(F.filter(tried, lambda t: t.isNotNull()), F.lit(0))

    centre = let(ring_centroid(outer), lambda c: spot(c["lng"], c["lat"]))
    return F.coalesce(centre, let(F.transform(outer, lambda p: p[1]), lines))


def _hit(a: Column, b: Column, y: Column) -> Column:
    return F.when((a[1] > y) != (b[1] > y), (b[0] - a[0]) * (y - a[1]) / F.nullif(b[1] - a[1], F.lit(0.0)) + a[0])


def area_km2(square_degrees: Column, lat: Column) -> Column:
    return square_degrees * KM_PER_DEGREE**2 * F.cos(F.radians(lat))


def geojson_polygons(geometry: Column) -> Column:
    """Polygon or MultiPolygon GeoJSON text as nested arrays; other types give no polygons."""
    kind = F.get_json_object(geometry, "$.type")
    body = F.get_json_object(geometry, "$.coordinates")
    return F.when(kind == "MultiPolygon", F.from_json(body, POLYGONS)).when(kind == "Polygon", F.array(F.from_json(body, POLYGONS[6:-1]))).otherwise(F.array().cast(POLYGONS))


def rounded(polygons: Column, digits: int = 6) -> Column:
    return F.transform(polygons, lambda p: F.transform(p, lambda r: F.transform(r, lambda q: F.transform(q, lambda v: F.round(v, digits)))))

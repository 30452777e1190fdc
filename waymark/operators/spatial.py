"""Spatial joins by grid cells: radius and nearest, containment, layers, concentric pools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, text
from .numbering import spread, written

POLYGON_CELL, POINT_CELL = 0.1, 0.01
#: Points that one key of a cell takes; a cell with more is split.
DENSE = 20_000
#: Sides that a band of a polygon's height has at least, if so many are there.
BAND = 16
#: Points in a cell of the first radius of a nearest search, and how often its radius is halved at most for that.
FEW, HALVINGS = 16, 7


def _met(left: DataFrame, right: DataFrame, degrees: float, prefix: str, also: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of points from neighbouring cells, a superset of those within so many degrees; also: columns that agree.

    Left points meet right points of their cell and its neighbours by an equi join, never all of them.
    """
    a = left.withColumn("_cell", F.explode(geo.cells_around(F.col("lat"), F.col("lng"), degrees)))
    b = right.select(*(F.col(c).alias(f"{prefix}{c}") for c in right.columns)).withColumn("_cell", geo.cell(F.col(f"{prefix}lat"), F.col(f"{prefix}lng"), degrees))
    on = a["_cell"] == b["_cell"]
    for c in also:
        on &= F.col(c) == F.col(f"{prefix}{c}")
    return a.join(b, on).drop("_cell")


def within(left: DataFrame, right: DataFrame, radius_km: float, prefix: str = "r_") -> DataFrame:
    """Pairs of points (columns lat, lng on either side) at most so far apart, with metres; at any latitude, and over the date line."""
    met = _met(left, right, geo.degrees_of(radius_km), prefix)
    return met.withColumn("metres", geo.haversine_m(F.col("lat"), F.col("lng"), F.col(f"{prefix}lat"), F.col(f"{prefix}lng"))).where(F.col("metres") <= radius_km * 1000)


def _reaches(pool: DataFrame, radius_km: float, few: int = FEW) -> list[float]:
    """Radii that double up to the whole one; the first is the widest whose cells hold at most so few points of the pool each."""
    ladder = [radius_km / 2**k for k in range(HALVINGS + 1)]
    cells = F.array(*(F.struct(F.lit(k).alias("k"), geo.cell(F.col("lat"), F.col("lng"), geo.degrees_of(km)).alias("c")) for k, km in enumerate(ladder)))
    held = pool.select(F.explode(cells).alias("x")).groupBy("x.k", "x.c").agg(F.count("*").alias("n"))
    crowded = held.groupBy("k").agg(F.max("n").alias("n")).where(F.col("n") > few).agg(F.max("k")).first()[0]
    return ladder[: 1 if crowded is None else crowded + 2][::-1]


def nearest_within(left: DataFrame, right: DataFrame, left_id: str, right_id: str, radius_km: float, accept: Column | None = None) -> DataFrame:
    """(left_id, r_<right_id>, metres) of the nearest acceptable right point; ties go to the smaller id.

    Points ask first within a radius that fits where right points lie densest; those that found nothing
    ask again at twice the radius, up to the whole one. So nobody meets all points of a wide circle where
    near ones are enough. Without a condition, points at one spot ask once, and right points at one spot
    are one, that of the smallest id.
    """
    known = written(left.where("lat is not null and lng is not null"), "left")
    pool = right.where("lat is not null and lng is not null")
    if accept is None:
        known, own = known.select(left_id, "lat", "lng"), ["lat", "lng"]
        pool, rest = pool.groupBy("lat", "lng").agg(F.min(right_id).alias(right_id)), known.select(*own).distinct()
    else:
        own, rest = [left_id], known
    pool, out = written(pool, "pool"), None
    for km in _reaches(pool, radius_km):
        met = within(rest, pool, km)
        if accept is not None:
            met = met.where(accept)
        best = written(met.groupBy(*own).agg(F.min(F.struct("metres", f"r_{right_id}")).alias("n")), "nearest")
        out = best if out is None else out.unionByName(best)
        if km < radius_km:
            rest = written(rest.join(best, own, "left_anti"), "rest")
            if rest.isEmpty():
                break
    found = known.select(left_id, *own).join(out, own) if accept is None else out
    return found.groupBy(left_id).agg(F.min("n").alias("n")).select(left_id, f"n.r_{right_id}", "n.metres")


def contained(points: DataFrame, layer: DataFrame, point_id: str, feature: str = "idx", polygons: str = "polygons", cell: float = POLYGON_CELL) -> DataFrame:
    """(point_id, feature) of the first feature, by its number, that holds each point.

    Each polygon of a feature is listed by itself, at the level of the grid whose cells are as wide as its
    bounding box (each level doubles them), so it has four cells at most, however large it is; points ask
    the levels that occur. Cells with many points are split by a count: their points are dealt to several
    keys, and the polygons listed there are repeated for each. Points meet the polygons of their cell, then
    the box, and then only those sides that pass their height: sides are listed by bands of their polygon's
    height, about twice each, so a point tries BAND sides or twice as many as a level line meets on average.
    """
    own = [feature, "part"]
    sides = geo.edges(layer, feature, polygons)
    edge = [lo(c).alias(n) for lo, c, n in ((F.min, "x1", "_w"), (F.max, "x1", "_e"), (F.min, "y1", "_s"), (F.max, "y1", "_n"))]
    boxed = sides.groupBy(*own).agg(*edge, F.count("*").alias("_sides"), F.sum(F.abs(F.col("y2") - F.col("y1"))).alias("_tall")).where("_w is not null")
    passed = F.col("_tall") / F.nullif(F.col("_n") - F.col("_s"), F.lit(0.0))
    wide = F.greatest(F.col("_e") - F.col("_w"), F.col("_n") - F.col("_s"), F.lit(cell))
    bands = F.greatest(F.floor(F.col("_sides") / F.greatest(passed, F.lit(float(BAND)))), F.lit(1))
    boxed = written(boxed.select(*own, "_w", "_e", "_s", "_n", F.ceil(F.log2(wide / cell)).cast("int").alias("_level"), bands.alias("_bands")), "boxes")
    levels = [r._level for r in boxed.select("_level").distinct().collect()]  # a dozen at most
    if not levels:
        return points.select(point_id, F.lit(None).cast(layer.schema[feature].dataType).alias(feature)).limit(0)
    width = F.pow(F.lit(2.0), F.col("_level")) * cell
    span = lambda lo, hi: F.sequence(F.floor(F.col(lo) / width), F.floor(F.col(hi) / width))
    listed = boxed.withColumn("_cx", F.explode(span("_w", "_e"))).withColumn("_cy", F.explode(span("_s", "_n")))
    known = points.where("lat is not null and lng is not null").select(point_id, "lat", "lng")
    asked = known.withColumn("_level", F.explode(F.array(*map(F.lit, levels)))).withColumn("_cx", F.floor(F.col("lng") / width)).withColumn("_cy", F.floor(F.col("lat") / width))
    cells = ["_level", "_cx", "_cy"]
    dense = asked.groupBy(*cells).count().where(F.col("count") > DENSE).select(*cells, F.ceil(F.col("count") / DENSE).cast("int").alias("_parts"))
    parts = F.coalesce("_parts", F.lit(1))
    split = asked.join(dense, cells, "left").withColumn("_part", F.pmod(F.xxhash64(point_id), parts).cast("int")).drop("_parts")
    split = spread(split, *cells, "_part")
    repeated = listed.join(dense, cells, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    met = split.join(repeated, [*cells, "_part"]).where("lng between _w and _e and lat between _s and _n")
    band = lambda y: F.least(F.floor((y - F.col("_s")) / F.nullif(F.col("_n") - F.col("_s"), F.lit(0.0)) * F.col("_bands")), F.col("_bands") - 1)
    banded = sides.where("y1 <> y2").join(boxed.select(*own, "_s", "_n", "_bands"), own)
    banded = banded.withColumn("_band", F.explode(F.sequence(band(F.least("y1", "y2")), band(F.greatest("y1", "y2")))))
    listed_sides = banded.groupBy(*own, "_band").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("_sides"))
    tried = met.withColumn("_band", band(F.col("lat"))).join(listed_sides, [*own, "_band"])
    crossed = F.size(F.filter("_sides", lambda s: F.coalesce(geo.crosses(F.col("lng"), F.col("lat"), s["x1"], s["y1"], s["x2"], s["y2"]), F.lit(False))))
    return tried.where(crossed % 2 == 1).groupBy(point_id).agg(F.min(feature).alias(feature))


def locate(points: DataFrame, settlements: DataFrame, municipalities: DataFrame, point_id: str) -> DataFrame:
    """(point_id, settlement, municipality, county): by the settlement layer, else by the municipality layer."""
    near = contained(points, settlements, point_id).join(settlements.select("idx", F.col("name").alias("settlement"), F.col("jls").alias("s_jls"), F.col("county").alias("s_county")), "idx").drop("idx")
    wide = contained(points, municipalities, point_id).join(municipalities.select("idx", F.col("name").alias("m_jls"), F.col("county").alias("m_county")), "idx").drop("idx")
    both = points.select(point_id).join(near, point_id, "left").join(wide, point_id, "left")
    return both.select(point_id, "settlement", F.coalesce("s_jls", "m_jls").alias("municipality"), F.coalesce("s_county", "m_county").alias("county"))


def unique_by_name(asked: DataFrame, settlements: DataFrame, id_: str) -> DataFrame:
    """(id, lat, lng) of rows (id, name, county) whose settlement's name is unique, or unique in their county.

    A county in which no settlement has the name is ignored.
    """
    met = asked.select(id_, text.fold_key(F.col("name")).alias("_key"), F.col("county").alias("_county")).join(settlements.select(text.fold_key(F.col("name")).alias("_key"), "county", "lat", "lng"), "_key")
    own = F.col("_county").isNotNull() & (F.col("county") == F.col("_county"))
    tally = met.groupBy(id_).agg(F.count("*").alias("n"), F.count_if(own).alias("m"), F.max(F.struct("lat", "lng")).alias("any"), F.max(F.when(own, F.struct("lat", "lng"))).alias("mine"))
    chosen = F.when(F.col("m") == 1, F.col("mine")).when((F.col("m") == 0) & (F.col("n") == 1), F.col("any"))
    return tally.select(id_, chosen.alias("c")).where("c is not null").select(id_, "c.lat", "c.lng")


def name_candidates(asked: DataFrame, settlements: DataFrame, id_: str, name: str = "city", of: str = "idx") -> DataFrame:
    """(id, idx, exact): settlements of the name, and those whose first or last words it is.

    Whole-word beginnings and ends of settlements' names are listed, so both are equi joins.
    """
    key = text.fold_key(F.col("name"))
    words = settlements.select(of, F.split(key, " ").alias("w")).where("size(w) > 0")
    n = F.size("w")
    ends = F.array_union(F.transform(F.sequence(F.lit(1), n), lambda k: F.array_join(F.slice("w", 1, k), " ")), F.transform(F.sequence(F.lit(1), n), lambda k: F.array_join(F.slice("w", k, n), " ")))
    listed = words.select(of, F.array_join("w", " ").alias("_whole"), F.explode(F.array_distinct(ends)).alias("_key"))
    return asked.select(id_, text.fold_key(F.col(name)).alias("_key")).where("_key <> ''").join(listed, "_key").select(id_, of, (F.col("_key") == F.col("_whole")).alias("exact"))


def _first_reach(pool: DataFrame, own: list[str], near: int = 8) -> float:
    """Degrees within which a point has about so many pool points of its circle, if they lay evenly; between a hundredth and 90."""
    box = (F.max("lat") - F.min("lat")) * (F.max("lng") - F.min("lng"))
    groups = F.count_distinct(*own) if own else F.lit(1)
    area, n, k = pool.agg(box.alias("area"), F.count("*").alias("n"), groups.alias("k")).first()
    return min(90.0, max(0.01, (near * (area or 0.0) * max(k, 1) / max(n, 1) / 3.14) ** 0.5))


def concentric(asked: DataFrame, pool: DataFrame, id_: str, pool_id: str, circles: list[str], first_degrees: float | None = None) -> DataFrame:
    """(id, p_<pool_id>, circle) of the nearest pool point in the narrowest circle that has any; circle len(circles) is the whole pool.

    circles are columns of both sides, narrow first. In a circle points meet the pool by cells, first
    within a radius that fits the pool's density (or first_degrees); those that found nothing ask again
    at four times the radius, until the cells span the globe. So nobody is compared with a whole circle
    unless it is as sparse as that, and every point whose circle has a pool point finds the nearest. What
    a radius finds is written once, for the result and for those who ask again. Points without a place find none.
    """
    p = pool.where("lat is not null and lng is not null").select(pool_id, "lat", "lng", *circles)
    apart = geo.degrees2(F.col("lat"), F.col("lng"), F.col("p_lat"), F.col("p_lng"))
    out, rest = None, asked.where("lat is not null and lng is not null").select(id_, "lat", "lng", *circles)
    for k in range(len(circles) + 1):
        own = circles[k : k + 1]
        there = p.select(*own).distinct() if own else None
        here = rest.join(there, own, "left_semi") if own else rest
        degrees = first_degrees or _first_reach(p, own)
        while True:
            met = _met(here, p.select(pool_id, "lat", "lng", *own), degrees, "p_", tuple(own)).withColumn("_d", apart)
            near = met.where(F.col("_d") <= degrees**2) if degrees < 720 else met
            best = written(near.groupBy(id_).agg(F.min(F.struct("_d", f"p_{pool_id}")).alias("b")).select(id_, f"b.p_{pool_id}", F.lit(k).alias("circle")), "nearest")
            out = best if out is None else out.unionByName(best)
            if degrees >= 720:
                break
            here = written(here.join(best.select(id_), id_, "left_anti"), "rest")
            if here.isEmpty():
                break
            degrees *= 4
        if own:
            rest = written(rest.join(there, own, "left_anti"), "outside")
            if rest.isEmpty():
                break
    return out


def k_nearest(points: DataFrame, id_: str, k: int, radius_km: float) -> DataFrame:
    """(id, r_id, metres, nth): the k nearest other points within the radius; ids are unique, ties go to the smaller one.

    Points at one spot ask once, for one neighbour more than k, as one may be the point itself; so of a spot
    only its k + 1 smallest ids are met. They ask first within a radius that fits where points lie densest;
    spots that found too few ask again at twice the radius, up to the whole one.
    """
    spot = ["lat", "lng"]
    first = lambda df, *by: df.withColumn("_nth", F.row_number().over(Window.partitionBy(*spot).orderBy(*by))).where(F.col("_nth") <= k + 1)
    known = written(points.where(F.col(id_).isNotNull() & F.col("lat").isNotNull() & F.col("lng").isNotNull()), "points")
    pool = written(first(spread(known, *spot), id_).drop("_nth"), "pool")
    rest, out = spread(pool.select(*spot), *spot).distinct(), None
    for km in _reaches(pool, radius_km, max(FEW, 3 * k)):
        best = written(first(within(rest, pool, km), "metres", f"r_{id_}"), "nearest")
        full = best.where(F.col("_nth") == k + 1).select(*spot)
        ready = best.join(full, spot, "left_semi") if km < radius_km else best
        out = ready if out is None else out.unionByName(ready)
        if km < radius_km:
            rest = written(rest.join(full, spot, "left_anti"), "rest")
            if rest.isEmpty():
                break
    met = known.join(out, spot).where(F.col(id_) != F.col(f"r_{id_}"))
    return met.withColumn("nth", F.row_number().over(Window.partitionBy(id_).orderBy("_nth"))).where(F.col("nth") <= k).drop("_nth")


def verification(metres: Column, verified_m: float = 300.0, conflict_m: float = 750.0) -> Column:
    return F.when(metres.isNull(), "unknown").when(metres <= verified_m, "verified").when(metres > conflict_m, "conflict").otherwise("undecided")

"""Queries over outlines, overlaps and map clusters, each with SQL that works the figures out on its own.

Suppliers stand for settlements: unit squares, ten in a row, in groups that leave holes, islands and
corners where two parts of a group touch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import clusters, territory
from ..sources import sinks
from .catalogue import Tables, customers, query

CELLS = "g as (select x, y, ((x * x + y * 3 + x * y) % 3)::varchar as side from (select s_suppkey % 10 as x, s_suppkey // 10 as y from supplier))"
PLACES = "p as (select c_custkey, ((c_custkey * 7919) % 10000) / 1000.0::double + 0.0003::double as lng, ((c_custkey * 104729) % ((select count(*) from supplier) * 100)) / 1000.0::double + 0.0003::double as lat, (c_custkey % 3)::varchar as diocese from customer)"


def _cells(t: Tables, bend: bool = False) -> DataFrame:
    """idx, side, polygons; bend: the middle of each border strays by a third of a thousandth, the same for both cells."""
    k = F.col("s_suppkey").cast("bigint")
    cells = t.supplier.select(k.alias("idx"), (k % 10).alias("x"), F.floor(k / 10).alias("y")).withColumn("side", ((F.col("x") * F.col("x") + F.col("y") * 3 + F.col("x") * F.col("y")) % 3).cast("string"))
    at = lambda dx, dy: F.array((F.col("x") + dx).cast("double"), (F.col("y") + dy).cast("double"))
    corners = [at(0, 0), at(1, 0), at(1, 1), at(0, 1)]
    if bend:
        off = lambda dx, dy: ((F.col("x") + dx) * 3 + (F.col("y") + dy) * 5) % 3 * F.lit(0.00033)
        flat = lambda dy: F.array(F.col("x") + F.lit(0.5), F.col("y") + dy + off(0, dy))
        tall = lambda dx: F.array(F.col("x") + dx + off(dx, 0), F.col("y") + F.lit(0.5))
        corners = [corners[0], flat(0), corners[1], tall(1), corners[2], flat(1), corners[3], tall(0)]
    return cells.select("idx", "side", F.array(F.array(F.array(*corners))).alias("polygons"))


def _places(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    return t.customer.select(k.alias("idx"), (k * 7919 % 10000 / F.lit(1000.0) + 0.0003).alias("lng"), (k * 104729 % (t.supplier.count() * 100) / F.lit(1000.0) + 0.0003).alias("lat"), (k % 3).cast("string").alias("diocese"))


@query(f"with {CELLS}, {PLACES} select side as name, count(*) filter (where diocese = side) as hit, count(*) as total from p join g on floor(lng) = x and floor(lat) = y group by side")
def places_in_holes(t: Tables) -> DataFrame:
    """Places by the outline that holds them; one in a hole of an outline belongs to whatever fills the hole."""
    borders = territory.dissolve(_cells(t), "idx", "side").withColumnRenamed("side", "name")
    places = _places(t)
    return territory.agreement(places.select("idx", "lat", "lng"), places.select("idx", "diocese"), borders)


@query(f"""with {CELLS}, e as (select side, x as ax, y as ay, 0 as up from g union all select side, x, y + 1, 0 from g union all select side, x, y, 1 from g union all select side, x + 1, y, 1 from g),
o as (select ax, ay, up, min(side) as a, max(side) as b, count(*) as n from e group by all)
select a || case when n = 2 then b else '' end as between, count(*)::double as border_length from o where n = 1 or a <> b group by 1""")
def shared_borders(t: Tables) -> DataFrame:
    """Length of the borders that two simplified outlines have in common point by point, and of those that one has alone: bends, a millionth longer, are gone or kept on both sides alike."""
    shapes = territory.dissolve(_cells(t, bend=True), "idx", "side")
    sides = geo.edges(shapes.select("side", "polygons"), "side")
    a, b = (F.struct(F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y")) for k in (1, 2))
    once = sides.groupBy(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).agg(F.array_join(F.array_sort(F.collect_list("side")), "").alias("between"))
    return once.groupBy("between").agg(F.round(F.sum(F.hypot(F.col("b.x") - F.col("a.x"), F.col("b.y") - F.col("a.y"))), 6).alias("border_length"))


def _feature_area(coordinates: Column) -> Column:
    ring = lambda r: geo.ring_area(F.slice(r, 1, F.size(r) - 1))
    return F.aggregate(coordinates, F.lit(0.0), lambda s, p: s + ring(F.get(p, F.lit(0))) - F.aggregate(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), F.lit(0.0), lambda n, h: n + ring(h)))


@query(f"with {CELLS} select side, count(*)::double as square_degrees, true as closed from g group by side")
def outline_features(t: Tables) -> DataFrame:
    """What the exported features of the outlines cover, read back from their text; each ring closes."""
    features = sinks.polygon_features(territory.dissolve(_cells(t), "idx", "side").select("side", "polygons"), "polygons")
    read = features.select(F.get_json_object("feature", "$.properties.side").alias("side"), F.from_json(F.get_json_object("feature", "$.geometry.coordinates"), geo.POLYGONS).alias("c"))
    closed = F.forall("c", lambda p: F.forall(p, lambda r: F.element_at(r, 1) == F.element_at(r, -1)))
    return read.select("side", F.round(_feature_area(F.col("c")), 6).alias("square_degrees"), closed.alias("closed"))


@query("""with d as (select s_suppkey, s_suppkey % 3 as kind, (s_suppkey % 19) / 10.0::double as d from supplier),
a as (select *, case kind when 0 then (2 - d) * (2 - d) / 2 when 1 then 2 * d * d - case when d > 1 then 4 * (d - 1) * (d - 1) else 0 end else 1.8 * d end as shared, case kind when 0 then 4 when 1 then 4 + 2 * d * d else 6.6 + 3 * d end as total from d)
select s_suppkey, round(shared / (total - shared), 9) as iou from a""")
def overlap_exact(t: Tables) -> DataFrame:
    """Slanted and concave shapes: two triangles, one moved; a square and a diamond that grows beyond it; a U and a bar across it."""
    d = F.col("s_suppkey") % 19 / F.lit(10.0)
    ring = lambda *points: F.array(F.array(*(F.array(*(v.cast("double") if isinstance(v, Column) else F.lit(float(v)) for v in p)) for p in points)))
    kind = F.col("s_suppkey") % 3
    a = F.when(kind == 0, ring((0, 0), (2, 0), (0, 2))).when(kind == 1, ring((0, 0), (2, 0), (2, 2), (0, 2))).otherwise(ring((0, 0), (3, 0), (3, 3), (2.2, 3), (2.2, 1), (1, 1), (1, 3), (0, 3)))
    b = F.when(kind == 0, ring((d, 0), (d + 2, 0), (d, 2))).when(kind == 1, ring((1 - d, 1), (1, 1 - d), (d + 1, 1), (1, d + 1))).otherwise(ring((0, 1), (3, 1), (3, d + 1), (0, d + 1)))
    return t.supplier.select("s_suppkey", F.round(territory.iou(a, b), 9).alias("iou"))


@query()
def cluster_tree(t: Tables) -> DataFrame:
    """Customers on the map, clustered by radius at all zooms in one pass."""
    return clusters.cluster_tree(customers(t), "c_custkey").select("zoom", "key", "n", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"))


@query("select z.zoom::int as zoom, count(*) as n, true as apart from customer cross join (select unnest(range(0, 12)) as zoom) z group by 1")
def clustered_points(t: Tables) -> DataFrame:
    """What the clusters of each zoom hold together: every point once; and at each zoom no two clusters at one place."""
    out = clusters.cluster_tree(customers(t), "c_custkey").groupBy("zoom").agg(F.sum("n").alias("n"), (F.count_distinct("lat", "lng") == F.count("*")).alias("apart"))
    return out

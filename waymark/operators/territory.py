"""Territories: settlements assigned to dioceses, dissolved, measured and compared."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions import geo
from . import outlines, spatial

SIMPLIFY_DEGREES = 0.0008
RINGS = "array<array<array<double>>>"


def settlements(features: DataFrame) -> DataFrame:
    """Adds lat and lng, the centre of the biggest outer ring, to features (idx, name, polygons, ...)."""
    centre = geo.ring_centroid(F.get(geo.biggest(F.col("polygons")), F.lit(0)))
    return features.where("exists(polygons, p -> size(p) > 0)").withColumn("_c", centre).withColumn("lat", F.col("_c.lat")).withColumn("lng", F.col("_c.lng")).drop("_c")


def assign(places: DataFrame, parishes: DataFrame) -> DataFrame:
    """(idx, diocese, direct): seats inside a settlement vote, the greater name winning ties; settlements
    without a seat follow the nearest seated parish of their municipality, else county, else any parish."""
    seats = spatial.contained(parishes, places, "id")
    seated = parishes.join(seats, "id").join(places.select("idx", "jls", "county"), "idx")
    votes = seated.groupBy("idx", "diocese").agg(F.count("*").alias("n")).groupBy("idx").agg(F.max_by("diocese", F.struct("n", "diocese")).alias("diocese"))
    rest = places.join(votes.select("idx"), "idx", "left_anti").select("idx", "lat", "lng", "jls", "county")
    pool = parishes.join(seated.select("id", "jls", "county"), "id", "left")
    near = spatial.concentric(rest, pool, "idx", "id", ["jls", "county"]).join(parishes.select(F.col("id").alias("p_id"), "diocese"), "p_id")
    return votes.withColumn("direct", F.lit(True)).unionByName(near.select("idx", "diocese", F.lit(False).alias("direct")))


def border(layer: DataFrame, key: str, group: str, polygons: str = "polygons") -> DataFrame:
    """(group, x1, y1, x2, y2): sides that only one polygon of the group has; shared ones cancel."""
    grouped = layer.select(F.col(group), F.col(key), F.col(polygons).alias("polygons"))
    sides = geo.edges(grouped.withColumn("_k", F.struct(group, key)), "_k").select(F.col(f"_k.{group}").alias(group), "x1", "y1", "x2", "y2").where("x1 <> x2 or y1 <> y2")
    a, b = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    undirected = sides.groupBy(group, F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).agg(F.count("*").alias("n"), F.first(F.struct("x1", "y1", "x2", "y2")).alias("e"))
    return undirected.where("n = 1").select(group, "e.*")


def stitch(sides: np.ndarray) -> list[list[tuple[float, float]]]:
    """Closed rings of sides (x1, y1, x2, y2) in any order and direction; open chains are dropped."""
    at: dict[tuple, list[int]] = {}
    points = [((a, b), (c, d)) for a, b, c, d in sides.tolist()]
    for k, (p, q) in enumerate(points):
        at.setdefault(p, []).append(k)
        at.setdefault(q, []).append(k)
    used, rings = set(), []
    for first in range(len(points)):
        if first in used:
            continue
        used.add(first)
        ring, here = [points[first][0]], points[first][1]
        while here != ring[0]:
            ring.append(here)
            onward = next((k for k in at[here] if k not in used), None)
            if onward is None:
                break
            used.add(onward)
            p, q = points[onward]
            here = q if p == here else p
        else:
            if len(ring) > 2:
                rings.append(ring)
    return rings


def dissolve(layer: DataFrame, key: str, group: str, tolerance: float = SIMPLIFY_DEGREES) -> DataFrame:
    """(group, polygons, rings, square_degrees): each group's union with its holes, from borders that match point by point.

    Neighbours' outlines agree (see outlines). rings are all rings of the polygons, outer ones and holes.
    The area is the sum of the parts', so simplifying does not change it.
    """
    part = F.aggregate("polygons", F.lit(0.0), lambda s, p: s + geo.ring_area(F.get(p, F.lit(0))) - F.aggregate(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), F.lit(0.0), lambda t, h: t + geo.ring_area(h)))
    areas = layer.groupBy(F.col(group).cast("string").alias(group)).agg(F.sum(part).alias("square_degrees"))
    return outlines.outlines(layer, key, group, tolerance).withColumn("rings", F.flatten("polygons")).join(areas, group)


def polygonize(relations: DataFrame) -> DataFrame:
    """(name, rings) of boundary relations (type, tags.name, members): outer ways stitched end to end."""
    ways = relations.where("type = 'relation' and tags.name is not null").select(F.col("tags.name").alias("name"), F.explode("members").alias("m")).where("m.type = 'way' and coalesce(m.role, '') in ('outer', '')")
    pairs = F.transform(F.sequence(F.lit(0), F.size("m.geometry") - 2), lambda k: F.struct(*(F.get(F.col("m.geometry"), k + d)[f].alias(n) for d, f, n in ((0, "lon", "x1"), (0, "lat", "y1"), (1, "lon", "x2"), (1, "lat", "y2")))))
    sides = ways.where("size(m.geometry) > 1").select("name", F.explode(pairs).alias("e")).select("name", "e.*")

    def rings(pdf: pd.DataFrame) -> pd.DataFrame:
        found = stitch(pdf[["x1", "y1", "x2", "y2"]].to_numpy())
        return pd.DataFrame({"name": [pdf["name"].iloc[0]], "rings": [[[list(p) for p in r] for r in found]]}, dtype=object).iloc[: int(bool(found))]

    return sides.groupBy("name").applyInPandas(rings, f"name string, rings {RINGS}")


def agreement(places: DataFrame, assigned: DataFrame, boundaries: DataFrame) -> DataFrame:
    """(name, hit, total): of settlements whose centre lies in a boundary, how many are assigned to it.

    Boundaries have a name and polygons, whose holes are outside, or rings that are areas each, and may have a number idx; of several that hold a centre the first counts.
    """
    shape = F.col("polygons") if "polygons" in boundaries.columns else F.transform("rings", lambda r: F.array(r))
    numbered = boundaries.select(F.col("idx") if "idx" in boundaries.columns else F.xxhash64("name").alias("idx"), "name", shape.alias("polygons"))
    inside = spatial.contained(places.select(F.col("idx").alias("place"), "lat", "lng"), numbered, "place").join(numbered.select("idx", "name"), "idx")
    joined = inside.join(assigned.select(F.col("idx").alias("place"), "diocese"), "place", "left")
    return joined.groupBy("name").agg(F.count_if(F.col("diocese") == F.col("name")).alias("hit"), F.count("*").alias("total"))


def _sides(rings: list) -> np.ndarray:
    """(x1, y1, x2, y2) of all sides that are not level, the lower end first."""
    out = [np.hstack([r, np.roll(r, -1, 0)]) for r in (np.array([list(p) for p in ring], float).reshape(-1, 2) for ring in rings) if len(r) > 2]
    sides = np.vstack(out) if out else np.zeros((0, 4))
    sides = sides[sides[:, 1] != sides[:, 3]]
    return np.where((sides[:, 1] > sides[:, 3])[:, None], sides[:, [2, 3, 0, 1]], sides)


def _meetings(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Heights at which sides cross, strictly inside both."""
    found = [np.zeros(0)]
    for k in range(0, len(a), 256):
        p, q = a[k : k + 256, None], b[None]
        d, e = p[..., 2:] - p[..., :2], q[..., 2:] - q[..., :2]
        over = d[..., 0] * e[..., 1] - d[..., 1] * e[..., 0]
        away = q[..., :2] - p[..., :2]
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (away[..., 0] * e[..., 1] - away[..., 1] * e[..., 0]) / over
            u = (away[..., 0] * d[..., 1] - away[..., 1] * d[..., 0]) / over
            on = (over != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1)
            found.append((p[..., 1] + t * d[..., 1])[on])
    return np.concatenate(found)


def overlap_of(a: list, b: list) -> tuple[float, float]:
    """Areas of the intersection and the union of two sets of rings, each by the even-odd rule; exact for any rings.

    Between two neighbouring heights of corners and crossings no sides meet, so each slab is a row of
    trapezoids, whose areas are their height times their width in the middle.
    """
    sa, sb = _sides(a), _sides(b)
    sides, first = np.vstack([sa, sb]), len(sa)
    heights = np.unique(np.concatenate([sides[:, 1], sides[:, 3], _meetings(sides, sides)]))
    both = either = 0.0
    for k in range(0, len(heights) - 1, 512):
        ys = heights[k : k + 513]
        middle, tall = (ys[1:] + ys[:-1]) / 2, np.diff(ys)
        x = sides[:, 0] + (sides[:, 2] - sides[:, 0]) * (middle[:, None] - sides[:, 1]) / (sides[:, 3] - sides[:, 1])
        x[(middle[:, None] < sides[:, 1]) | (middle[:, None] > sides[:, 3])] = np.inf
        order = np.argsort(x, axis=1, kind="stable")
        x, own = np.take_along_axis(x, order, 1), order < first
        in_a, in_b = (np.cumsum(m, axis=1)[:, :-1] % 2 == 1 for m in (own, ~own))
        with np.errstate(invalid="ignore"):
            wide = np.nan_to_num(np.diff(x, axis=1), nan=0.0, posinf=0.0) * tall[:, None]
        both += float(wide[in_a & in_b].sum())
        either += float(wide[in_a | in_b].sum())
    return both, either


def iou_of(a: list, b: list) -> float:
    """Intersection over union of two sets of rings; 0 where there is no area."""
    both, either = overlap_of(a, b)
    return both / either if either else 0.0


@F.pandas_udf(DoubleType())
def iou(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([iou_of(x, y) for x, y in zip(a, b, strict=True)])


def rollup(places: DataFrame, assigned: DataFrame, parishes: DataFrame, churches: DataFrame) -> DataFrame:
    """Per diocese: settlements, population, area and numbers of parishes and churches."""
    base = assigned.join(places.select("idx", "population", "area_km2"), "idx").groupBy("diocese").agg(F.count("*").alias("settlements"), F.sum("population").alias("population"), F.sum("area_km2").alias("area_km2"))
    p = parishes.groupBy("diocese").agg(F.count("*").alias("parishes"))
    c = churches.join(parishes.select(F.col("id").alias("parish_id"), "diocese"), "parish_id").groupBy("diocese").agg(F.count("*").alias("churches"))
    return base.join(p, "diocese", "left").join(c, "diocese", "left").na.fill(0, ["parishes", "churches"])

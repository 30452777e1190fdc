"""Outlines of groups of polygons that share their borders: arcs, simplified once for both sides, and rings nested into polygons.

A side that only one polygon of a group has is on the group's border. Sides are kept once, with the
groups that they bound; a point where other than two such sides meet, or sides of different groups,
is a node. An arc runs from node to node (or round an island) between the same groups. Since an arc is
simplified once and its nodes stay, the outlines of neighbours agree point by point. An arc that would
come to touch or cross another one is simplified less, until it does not.

The joins and counts are Spark's; one task follows the border between two groups, or joins the arcs of
one group's outline, and never sees areas.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ..functions import geo
from .numbering import spread, written

LINE = "array<array<double>>"
#: Times that the tolerance of arcs in conflict is halved; after them an arc keeps all its bends.
HALVINGS = 6
#: Pairs of sides and points that are looked at together when rings are nested.
PAIRS = 1 << 22

Point = tuple[float, float]


def _ends(a: str, b: str) -> tuple[Column, Column]:
    return (F.struct(F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y")) for k in (a, b))


def border_sides(layer: DataFrame, key: str, group: str, polygons: str = "polygons") -> DataFrame:
    """(a, b, groups): each side on some group's border once, its ends in order, with the groups that it bounds in order."""
    rows = layer.select(F.struct(F.col(group).alias("g"), F.col(key).alias("k")).alias("_k"), F.col(polygons).alias("polygons"))
    sides = geo.edges(rows, "_k").where("x1 <> x2 or y1 <> y2")
    a, b = _ends(1, 2)
    own = sides.groupBy(F.col("_k.g").alias("g"), F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).agg(F.count("*").alias("n")).where("n % 2 = 1")
    return own.groupBy("a", "b").agg(F.array_sort(F.collect_set(F.col("g").cast("string"))).alias("groups"))


def follow(ends: np.ndarray, nodes: np.ndarray) -> list[list[Point]]:
    """Lines of sides (ax, ay, bx, by) from node to node; those without a node close at their least point. nodes: of each side's ends."""
    points = [((a, b), (c, d)) for a, b, c, d in ends.tolist()]
    at: dict[Point, list[int]] = {}
    stops: set[Point] = set()
    for k, (p, q) in enumerate(points):
        for place, stop in ((p, nodes[k][0]), (q, nodes[k][1])):
            at.setdefault(place, []).append(k)
            if stop:
                stops.add(place)
    used: set[int] = set()

    def walk(start: Point, k: int) -> list[Point]:
        line = [start]
        while True:
            used.add(k)
            p, q = points[k]
            line.append(q if line[-1] == p else p)
            if line[-1] in stops or line[-1] == start:
                return line
            k = next(j for j in at[line[-1]] if j not in used)

    lines = [walk(place, k) for place in sorted(stops) for k in at[place] if k not in used]
    for k in sorted(range(len(points)), key=lambda k: points[k]):
        if k not in used:
            lines.append(walk(points[k][0], k))
    return lines


def thinned(line: np.ndarray, tolerance: float) -> np.ndarray:
    """The points of a line that stray from the chords between kept ones by more than the tolerance; a closed line keeps its farthest point and one more."""
    n = len(line)
    if n < 3:
        return line
    keep = np.zeros(n, bool)
    keep[[0, -1]] = True
    stack = [(0, n - 1)]
    if closed := bool((line[0] == line[-1]).all()):
        far = int(np.argmax(((line - line[0]) ** 2).sum(1)))
        keep[far] = True
        stack = [(0, far), (far, n - 1)]
    widest = (0.0, 0)
    while stack:
        a, b = stack.pop()
        if b - a < 2:
            continue
        d, inner = line[b] - line[a], line[a + 1 : b] - line[a]
        along = np.clip(inner @ d / max(float(d @ d), 1e-300), 0, 1)
        away = np.hypot(*(inner - along[:, None] * d).T)
        k = int(away.argmax())
        if away[k] > widest[0]:
            widest = (float(away[k]), a + 1 + k)
        if away[k] > tolerance:
            keep[a + 1 + k] = True
            stack += [(a, a + 1 + k), (a + 1 + k, b)]
    if closed and keep.sum() < 4:
        keep[widest[1]] = True
    return line[keep]


@F.pandas_udf(ArrayType(ArrayType(DoubleType())))
def _thinned(lines: pd.Series, tolerances: pd.Series) -> pd.Series:
    return pd.Series([thinned(np.array([list(p) for p in line], float), t).tolist() for line, t in zip(lines, tolerances, strict=True)])


def _segments(arcs: DataFrame) -> DataFrame:
    pair = F.transform(F.sequence(F.lit(1), F.size("line") - 1), lambda k: F.struct(k.alias("k"), *(F.element_at(F.element_at("line", k + d), c).alias(f"{n}{d + 1}") for d in (0, 1) for c, n in ((1, "x"), (2, "y")))))
    return arcs.select("arc", F.explode(pair).alias("s")).select("arc", "s.*")


def conflicts(arcs: DataFrame, cell: float) -> DataFrame:
    """(arc) of lines that cross, touch or cover another or themselves elsewhere than at common ends; segments meet by cells of the plane."""
    span = lambda a, b: F.sequence(F.floor(F.least(a, b) / cell), F.floor(F.greatest(a, b) / cell))
    listed = spread(_segments(arcs).withColumn("cx", F.explode(span(F.col("x1"), F.col("x2")))).withColumn("cy", F.explode(span(F.col("y1"), F.col("y2")))), "cx", "cy")
    other = listed.select("cx", "cy", *(F.col(c).alias(f"o_{c}") for c in ("arc", "k", "x1", "y1", "x2", "y2")))
    met = listed.join(other, ["cx", "cy"]).where("arc < o_arc or (arc = o_arc and k < o_k)")
    turn = lambda a, b, c: f"(({b[0]} - {a[0]}) * ({c[1]} - {a[1]}) - ({b[1]} - {a[1]}) * ({c[0]} - {a[0]}))"
    p, q, r, s = ("x1", "y1"), ("x2", "y2"), ("o_x1", "o_y1"), ("o_x2", "o_y2")
    same = lambda a, b: f"({a[0]} = {b[0]} and {a[1]} = {b[1]})"
    within = lambda a, b, c: f"({turn(a, b, c)} = 0 and not {same(a, c)} and not {same(b, c)} and {c[0]} between least({a[0]}, {b[0]}) and greatest({a[0]}, {b[0]}) and {c[1]} between least({a[1]}, {b[1]}) and greatest({a[1]}, {b[1]}))"
    crossing = f"({turn(p, q, r)} > 0) <> ({turn(p, q, s)} > 0) and ({turn(r, s, p)} > 0) <> ({turn(r, s, q)} > 0) and {turn(p, q, r)} <> 0 and {turn(p, q, s)} <> 0 and {turn(r, s, p)} <> 0 and {turn(r, s, q)} <> 0"
    covering = f"({same(p, r)} and {same(q, s)}) or ({same(p, s)} and {same(q, r)})"
    bad = met.where(f"({crossing}) or {within(p, q, r)} or {within(p, q, s)} or {within(r, s, p)} or {within(r, s, q)} or {covering}")
    return bad.select(F.explode(F.array("arc", "o_arc")).alias("arc")).distinct()


def arcs(layer: DataFrame, key: str, group: str, tolerance: float, polygons: str = "polygons", cell: float = 0.1) -> DataFrame:
    """(arc, groups, full, line): arcs between the same groups, with all their points and simplified."""
    sides = written(border_sides(layer, key, group, polygons), "sides")
    at = sides.select(F.explode(F.array("a", "b")).alias("p"), "groups").groupBy("p").agg(((F.count("*") != 2) | (F.min("groups") != F.max("groups"))).alias("node"))
    flagged = sides.join(at.select(F.col("p").alias("a"), F.col("node").alias("na")), "a").join(at.select(F.col("p").alias("b"), F.col("node").alias("nb")), "b")
    flat = flagged.select("groups", F.array_join("groups", "\x01").alias("between"), "a.x", "a.y", F.col("b.x").alias("x2"), F.col("b.y").alias("y2"), "na", "nb")

    def lines(pdf: pd.DataFrame) -> pd.DataFrame:
        found = follow(pdf[["x", "y", "x2", "y2"]].to_numpy(), pdf[["na", "nb"]].to_numpy())
        full = [np.array(line, float) for line in found]
        return pd.DataFrame({"groups": [pdf["groups"].iloc[0]] * len(found), "full": [line.tolist() for line in full], "line": [thinned(line, tolerance).tolist() for line in full]})

    followed = spread(flat, "between").groupBy("between").applyInPandas(lines, f"groups array<string>, full {LINE}, line {LINE}")
    now = written(followed.select(F.xxhash64("groups", "full").alias("arc"), "groups", "full", F.lit(float(tolerance)).alias("tolerance"), "line"), "arcs")
    for k in range(HALVINGS + 1):
        bad = written(conflicts(now, cell), "conflicts")
        if tolerance <= 0 or bad.isEmpty():
            break
        less = F.when(F.col("bad"), F.col("tolerance") / 2 if k < HALVINGS else F.lit(0.0)).otherwise(F.col("tolerance"))
        marked = now.join(bad.withColumn("bad", F.lit(True)), "arc", "left").withColumn("bad", F.coalesce("bad", F.lit(False))).withColumn("tolerance", less)
        now = written(marked.withColumn("line", F.when(F.col("bad"), _thinned("full", "tolerance")).otherwise(F.col("line"))).drop("bad"), "arcs")
    return now.select("arc", "groups", "full", "line")


def _area(ring: list[Point]) -> float:
    x, y = np.array(ring, float).T
    return abs(float(x @ np.roll(y, -1) - y @ np.roll(x, -1))) / 2


def _holds(ring: list[Point], x: float, y: float) -> bool:
    px, py = np.array(ring, float).T
    qx, qy = np.roll(px, -1), np.roll(py, -1)
    on = (py > y) != (qy > y)
    return bool((x < (qx[on] - px[on]) * (y - py[on]) / (qy[on] - py[on]) + px[on]).sum() % 2)


def _sides(rings: list[list[Point]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Both ends of the sides of all rings in a row, the ring of each side, and the first side of each ring."""
    sizes = np.array([len(r) for r in rings])
    start = np.array([p for r in rings for p in r], float)
    first = np.cumsum(sizes) - sizes
    onward = np.arange(len(start)) + 1
    onward[first + sizes - 1] = first
    return start, start[onward], np.repeat(np.arange(len(rings)), sizes), first


def _inner(start: np.ndarray, end: np.ndarray, own: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A point strictly inside each ring: the middle of the widest span halfway between the two least heights."""
    (px, py), (qx, qy) = start.T, end.T
    low = np.minimum.reduceat(py, first)
    y = (low + np.minimum.reduceat(np.where(py > low[own], py, np.inf), first)) / 2
    on = (py > y[own]) != (qy > y[own])
    ring = own[on]
    xs = (qx[on] - px[on]) * (y[ring] - py[on]) / (qy[on] - py[on]) + px[on]
    order = np.lexsort((xs, ring))
    xs, ring = xs[order].reshape(-1, 2), ring[order][::2]
    widest = np.lexsort((xs[:, 0] - xs[:, 1], ring))
    ring, at = np.unique(ring[widest], return_index=True)
    x = start[first, 0]
    x[ring] = xs[widest[at]].sum(1) / 2
    return np.stack([x, y], 1)


def _around(rings: list[list[Point]]) -> tuple[np.ndarray, np.ndarray]:
    """Of rings, the greatest first: how many of those before it each lies in, and the last of them (or -1).

    A ring lies where a point in it does. Points are sorted by height, so a side meets a run of them; only
    these pairs are looked at, some millions at a time.
    """
    start, end, own, first = _sides(rings)
    inner = _inner(start, end, own, first)
    order = np.argsort(inner[:, 1], kind="stable")
    (x, y), n = inner[order].T, len(rings)
    (px, py), (qx, qy) = start.T, end.T
    begin, stop = np.searchsorted(y, np.minimum(py, qy)), np.searchsorted(y, np.maximum(py, qy))
    total = np.cumsum(stop - begin)
    cuts = np.searchsorted(total, np.arange(0, total[-1], PAIRS)[1:])
    odd = np.zeros(0, np.int64)
    for sides in np.split(np.arange(len(start)), cuts):
        met = (stop - begin)[sides]
        k = np.repeat(sides, met)
        at = np.arange(len(k)) - np.repeat(np.cumsum(met) - met, met) + begin[k]
        passed = (own[k] < order[at]) & (x[at] < (qx[k] - px[k]) * (y[at] - py[k]) / (qy[k] - py[k]) + px[k])
        pairs, times = np.unique(order[at[passed]] * n + own[k[passed]], return_counts=True)
        odd = np.setxor1d(odd, pairs[times % 2 == 1], assume_unique=True)
    last = np.full(n, -1)
    np.maximum.at(last, odd // n, odd % n)
    return np.bincount(odd // n, minlength=n), last


def simple_rings(lines: list[list[Point]]) -> list[list[Point]]:
    """Closed rings (first point not repeated) of lines joined end to end; a ring that meets itself in a point is parted there."""
    at: dict[Point, list[int]] = {}
    for k, line in enumerate(lines):
        at.setdefault(line[0], []).append(k)
        at.setdefault(line[-1], []).append(k)
    used: set[int] = set()
    rings: list[list[Point]] = []
    for first in range(len(lines)):
        if first in used:
            continue
        used.add(first)
        path = list(lines[first])
        while path[-1] != path[0]:
            k = next((k for k in at[path[-1]] if k not in used), None)
            if k is None:
                break  # an open chain bounds nothing
            used.add(k)
            line = lines[k] if lines[k][0] == path[-1] else lines[k][::-1]
            path += line[1:]
        else:
            stack: list[Point] = []
            where: dict[Point, int] = {}
            for p in path:
                if p in where:
                    cut = where[p]
                    loop = stack[cut:]
                    for q in loop[1:]:
                        del where[q]
                    del stack[cut + 1 :]
                    if len(loop) > 2 and _area(loop) > 0:
                        rings.append(loop)
                else:
                    where[p] = len(stack)
                    stack.append(p)
    return rings


def nested(rings: list[list[Point]]) -> list[list[list[Point]]]:
    """Polygons (outer ring, holes) of rings that do not cross: a ring inside an odd number of others is a hole of the least one around it."""
    if not rings:
        return []
    areas = [_area(r) for r in rings]
    rings = [rings[k] for k in sorted(range(len(rings)), key=lambda k: (-areas[k], rings[k]))]
    depth, last = _around(rings)
    polygons = {k: [ring] for k, ring in enumerate(rings) if depth[k] % 2 == 0}
    for k, ring in enumerate(rings):
        if depth[k] % 2:
            polygons[int(last[k])].append(ring)
    return list(polygons.values())


def outlines(layer: DataFrame, key: str, group: str, tolerance: float, polygons: str = "polygons", cell: float = 0.1) -> DataFrame:
    """(group, polygons): each group's union, with holes, from borders that match point by point; neighbours' outlines agree."""
    own = arcs(layer, key, group, tolerance, polygons, cell).select(F.explode("groups").alias(group), "line")

    def shape(pdf: pd.DataFrame) -> pd.DataFrame:
        lines = sorted([tuple(p) for p in line] for line in pdf["line"])
        found = nested(simple_rings(lines))
        return pd.DataFrame({group: [pdf[group].iloc[0]], "polygons": [[[[list(p) for p in ring] for ring in polygon] for polygon in found]]})

    return written(spread(own, group).groupBy(group).applyInPandas(shape, f"{group} string, polygons {geo.POLYGONS}"), "outlines")

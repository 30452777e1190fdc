"""Clusters of a map's points by radius, for all zooms: a tree built from the deepest zoom upwards.

At each zoom the nodes of the zoom below are taken in a fixed order (by a hash of their keys); one that
no earlier cluster has taken starts a cluster and takes all free nodes within the radius. So a node is a
start exactly if no earlier start is that near, and any other node belongs to the earliest start near it.
A cluster lies at the mean of its points and keeps its start's key.

Nodes are found by square cells whose diagonal is the radius. In rounds, the earliest free node of each
cell is a start unless a free node before it is near; starts take what is near them; the rest goes on.
Each node meets one candidate a cell, so a city in one cell is never paired with itself. Once at most
FEW nodes are left, all further zooms are done in one task; the result is the same.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbering import written

RADIUS_PX, TILE, MOST_ZOOM, FEW = 46, 512, 11, 20_000
SCHEMA = "zoom int, key string, ord bigint, n bigint, x double, y double"


def _reach(zoom: int, radius_px: float) -> float:
    return radius_px / (TILE * 2.0**zoom)


def _cells(reach: float) -> Column:
    """struct(a, b) of a node's cell."""
    side = reach / 2**0.5
    return F.struct(F.floor(F.col("x") / side).alias("a"), F.floor(F.col("y") / side).alias("b"))


def _around(cell: Column) -> Column:
    """The cells that hold what is within the radius of any node of a cell."""
    steps = [(i, j) for i in range(-2, 3) for j in range(-2, 3)]
    return F.array(*(F.struct((cell["a"] + i).alias("a"), (cell["b"] + j).alias("b")) for i, j in steps))


def _near(nodes: DataFrame, stars: DataFrame, reach: float) -> DataFrame:
    """Nodes with each star (s_key, s_ord) within the radius; both have a cell, stars at most one each."""
    other = stars.select(F.explode(_around(F.col("cell"))).alias("cell"), *(F.col(c).alias(f"s_{c}") for c in ("key", "ord", "x", "y")))
    return nodes.join(other, "cell").where((F.col("x") - F.col("s_x")) ** 2 + (F.col("y") - F.col("s_y")) ** 2 <= reach**2)


def _starts(nodes: DataFrame, reach: float) -> DataFrame:
    """The nodes that start clusters."""
    found, free = [], nodes
    while True:
        first = free.groupBy("cell").agg(F.min(F.struct("ord", "key", "n", "x", "y")).alias("f")).select("cell", "f.*")
        held = _near(free, first, reach).where("ord < s_ord or (ord = s_ord and key < s_key)").select(F.col("s_key").alias("key")).distinct()
        now = written(first.join(held, "key", "left_anti").select(*nodes.columns), "starts")
        found.append(now)
        taken = _near(free, now, reach).select("key").distinct()
        free = written(free.join(taken, "key", "left_anti"), "free")
        if free.isEmpty():
            return reduce(DataFrame.unionByName, found)


def _one_zoom(nodes: DataFrame, zoom: int, radius_px: float) -> DataFrame:
    reach = _reach(zoom, radius_px)
    placed = written(nodes.withColumn("cell", _cells(reach)), "nodes")
    starts = _starts(placed, reach)
    own = _near(placed, starts, reach).groupBy("key", "n", "x", "y").agg(F.min(F.struct("s_ord", "s_key")).alias("s"))
    mean = lambda c: (F.sum(F.col(c) * F.col("n")) / F.sum("n")).alias(c)
    return written(own.groupBy(F.col("s.s_key").alias("key"), F.col("s.s_ord").alias("ord")).agg(F.sum("n").alias("n"), mean("x"), mean("y")), f"zoom{zoom}")


def in_one_task(pdf: pd.DataFrame, zooms: list[int], radius_px: float) -> pd.DataFrame:
    """All zooms of few nodes."""
    out = []
    for zoom in zooms:
        reach = _reach(zoom, radius_px)
        pdf = pdf.sort_values(["ord", "key"], kind="stable").reset_index(drop=True)
        x, y, n = (pdf[c].to_numpy() for c in ("x", "y", "n"))
        side = reach / 2**0.5
        a, b = np.floor(x / side).astype(np.int64), np.floor(y / side).astype(np.int64)
        cells: dict[tuple[int, int], list[int]] = {}
        for k, cell in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
            cells.setdefault(cell, []).append(k)
        of = np.full(len(pdf), -1)
        for k in range(len(pdf)):
            if of[k] < 0:
                near = np.array([j for i in range(-2, 3) for m in range(-2, 3) for j in cells.get((a[k] + i, b[k] + m), ())])
                near = near[(of[near] < 0) & ((x[near] - x[k]) ** 2 + (y[near] - y[k]) ** 2 <= reach**2)]
                of[near] = k
        sums = pd.DataFrame({"of": of, "n": n, "x": x * n, "y": y * n}).groupby("of").sum()
        pdf = pd.DataFrame({"key": pdf["key"].to_numpy()[sums.index], "ord": pdf["ord"].to_numpy()[sums.index], "n": sums["n"].to_numpy(), "x": (sums["x"] / sums["n"]).to_numpy(), "y": (sums["y"] / sums["n"]).to_numpy()})
        out.append(pdf.assign(zoom=zoom))
    return pd.concat(out)[[c.split()[0] for c in SCHEMA.split(", ")]]


def cluster_tree(points: DataFrame, key: str, radius_px: float = RADIUS_PX, most_zoom: int = MOST_ZOOM) -> DataFrame:
    """(zoom, key, n, lat, lng): the clusters of each zoom from most_zoom down to 0, at their points' mean on the map.

    Points without a place are left out; two at one spot are one cluster at every zoom, so they are one
    node from the start, by the first of their keys; beyond most_zoom nothing is clustered.
    """
    s = F.sin(F.radians("lat"))
    y = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.5 - F.log((1 + s) / (1 - s)) / (4 * F.pi())))
    known = points.where("lat is not null and lng is not null and abs(lat) < 90")
    name = F.col(key).cast("string")
    spots = known.select(F.struct(F.xxhash64(name).alias("ord"), name.alias("key")).alias("first"), (F.col("lng") / 360 + 0.5).alias("x"), y.alias("y")).groupBy("x", "y").agg(F.min("first").alias("first"), F.count("*").alias("n"))
    nodes = written(spots.select("first.key", "first.ord", "n", "x", "y"), "points")
    levels, zooms = [], list(range(most_zoom, -1, -1))
    while zooms and nodes.limit(FEW + 1).count() > FEW:
        nodes = _one_zoom(nodes, zooms[0], radius_px)
        levels.append(nodes.select(F.lit(zooms.pop(0)).alias("zoom"), "key", "ord", "n", "x", "y"))
    if zooms:
        levels.append(nodes.groupBy(F.lit(0).alias("_all")).applyInPandas(lambda pdf: in_one_task(pdf.drop(columns="_all", errors="ignore"), zooms, radius_px), SCHEMA))
    all_ = reduce(DataFrame.unionByName, levels)
    lat = F.degrees(F.atan(F.sinh(F.pi() * (1 - 2 * F.col("y")))))
    return all_.select("zoom", "key", "n", lat.alias("lat"), ((F.col("x") - 0.5) * 360).alias("lng"))

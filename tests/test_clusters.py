import random

import pandas as pd
from pyspark.sql import functions as F

from waymark.operators import clusters


def brute(rows, zooms, radius):
    """Each node in order, against all others."""
    out, nodes = {}, sorted(rows, key=lambda r: (r[1], r[0]))
    for z in zooms:
        reach, free, made = clusters._reach(z, radius), list(nodes), []
        while free:
            x, y = free[0][3:]
            near = [p for p in free if (p[3] - x) ** 2 + (p[4] - y) ** 2 <= reach**2]
            n = sum(p[2] for p in near)
            made.append((free[0][0], free[0][1], n, sum(p[2] * p[3] for p in near) / n, sum(p[2] * p[4] for p in near) / n))
            free = [p for p in free if p not in near]
        nodes = sorted(made, key=lambda r: (r[1], r[0]))
        out |= {(z, r[0]): (r[2], round(r[3], 9), round(r[4], 9)) for r in nodes}
    return out


def test_equals_taking_points_one_by_one(spark, monkeypatch):
    r = random.Random(4)
    places = [(k, 44 + r.gauss(0, 0.5), 16 + r.gauss(0, 0.5)) for k in range(150)] + [(k, 45.8 + r.gauss(0, 0.002), 16.0 + r.gauss(0, 0.002)) for k in range(150, 220)] + [(300, 45.8, 16.0), (301, 45.8, 16.0), (302, None, 1.0)]
    points = spark.createDataFrame(places, "id long, lat double, lng double")
    s = F.sin(F.radians("lat"))
    nodes = points.where("lat is not null").select(F.col("id").cast("string").alias("key"), F.xxhash64(F.col("id").cast("string")).alias("ord"), F.lit(1).alias("n"), (F.col("lng") / 360 + 0.5).alias("x"), (0.5 - F.log((1 + s) / (1 - s)) / (4 * F.pi())).alias("y"))
    rows = [tuple(x) for x in nodes.collect()]
    want = brute(rows, [9, 8, 7], 46)
    got = clusters.in_one_task(pd.DataFrame(rows, columns=["key", "ord", "n", "x", "y"]), [9, 8, 7], 46)
    assert {(z, k): (n, round(x, 9), round(y, 9)) for z, k, _, n, x, y in got.itertuples(index=False)} == want
    few = {(x.zoom, x.key): (x.n, round(x.lat, 7), round(x.lng, 7)) for x in clusters.cluster_tree(points, "id", most_zoom=9).collect() if x.zoom > 6}
    assert {k: v[0] for k, v in few.items()} == {k: v[0] for k, v in want.items()}
    monkeypatch.setattr(clusters, "FEW", 10)  # the zooms with more nodes by rounds of joins
    many = {(x.zoom, x.key): (x.n, round(x.lat, 7), round(x.lng, 7)) for x in clusters.cluster_tree(points, "id", most_zoom=9).collect() if x.zoom > 6}
    assert many == few


def test_points_at_one_spot_are_one_node(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(clusters, "written", lambda df, tag: sizes.append((tag, df.count())) or df)
    points = spark.range(300).select("id", (F.col("id") % 3 + 44.0).alias("lat"), F.lit(16.0).alias("lng"))
    top = clusters.cluster_tree(points, "id", most_zoom=0).collect()
    assert sum(r.n for r in top) == 300 and dict(sizes)["points"] == 3

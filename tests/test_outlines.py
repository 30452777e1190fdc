import json
import time

import numpy as np

from waymark.functions import geo
from waymark.operators import outlines, territory
from waymark.sources import sinks


def cell(x, y, w=1.0, h=1.0):
    x, y = float(x), float(y)
    return [[[x, y], [x + w, y], [x + w, y + h], [x, y + h]]]


def layer(spark, rows):
    return spark.createDataFrame([(k, g, [p]) for k, (g, p) in enumerate(rows)], f"idx bigint, side string, polygons {geo.POLYGONS}")


def test_a_ring_of_eight_around_a_ninth_has_a_hole(spark):
    tiles = layer(spark, [("core" if (x, y) == (1, 1) else "ring", cell(x, y)) for x in range(3) for y in range(3)])
    out = {r.side: r for r in territory.dissolve(tiles, "idx", "side").collect()}
    assert [len(p) for p in out["ring"].polygons] == [2] and [len(p) for p in out["core"].polygons] == [1]
    assert out["ring"].square_degrees == 8 and sorted(map(tuple, out["ring"].polygons[0][1])) == sorted(map(tuple, out["core"].polygons[0][0]))
    borders = territory.dissolve(tiles, "idx", "side").withColumnRenamed("side", "name")
    places = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.5, 1.5), (3, 2.5, 1.5)], "idx long, lng double, lat double")
    assigned = spark.createDataFrame([(1, "ring"), (2, "ring"), (3, "ring")], "idx long, diocese string")
    assert {tuple(r) for r in territory.agreement(places, assigned, borders).collect()} == {("ring", 2, 2), ("core", 0, 1)}
    feature = json.loads(sinks.polygon_features(borders.where("name = 'ring'").select("name", "polygons"), "polygons").first().feature)
    assert [len(p) for p in feature["geometry"]["coordinates"]] == [2] and all(r[0] == r[-1] for p in feature["geometry"]["coordinates"] for r in p)
    assert feature["properties"] == {"name": "ring"}


def test_parts_that_touch_in_a_corner_and_islands_in_holes(spark):
    grid = ["aabaa", "abbba", "bbabb", "abbba", "aabaa"]
    tiles = layer(spark, [(grid[y][x], cell(x, y)) for x in range(5) for y in range(5)])
    for r in territory.dissolve(tiles, "idx", "side").collect():
        area = sum(outlines._area([tuple(q) for q in ring]) * (1 if k == 0 else -1) for p in r.polygons for k, ring in enumerate(p))
        assert area == r.square_degrees == sum(row.count(r.side) for row in grid)
        assert all(len({tuple(q) for q in ring}) == len(ring) for p in r.polygons for ring in p)
        for x in range(5):
            for y in range(5):
                inside = sum(outlines._holds([tuple(q) for q in p[0]], x + 0.4, y + 0.3) and not any(outlines._holds([tuple(q) for q in h], x + 0.4, y + 0.3) for h in p[1:]) for p in r.polygons)
                assert inside == (grid[y][x] == r.side)


def test_borders_are_simplified_once_for_both_sides(spark):
    bend = [[1.0, k / 10] if k % 2 == 0 else [1.0003, k / 10] for k in range(11)]
    left = [[[0.0, 0.0], *bend, [0.0, 1.0]]]
    right = [[[2.0, 0.0], [2.0, 1.0], *bend[::-1]]]
    tiles = layer(spark, [("l", left), ("r", right)])
    out = {r.side: [tuple(q) for q in r.polygons[0][0]] for r in territory.dissolve(tiles, "idx", "side").collect()}
    assert sorted(out["l"]) == [(0.0, 0.0), (0.0, 1.0), (1.0, 0.0), (1.0, 1.0)] and sorted(out["r"]) == [(1.0, 0.0), (1.0, 1.0), (2.0, 0.0), (2.0, 1.0)]
    whole = {r.side: len(r.polygons[0][0]) for r in territory.dissolve(tiles, "idx", "side", tolerance=0.0).collect()}
    assert whole == {"l": 13, "r": 13}


def test_arcs_do_not_collapse_onto_each_other(spark):
    """A sliver between two territories would vanish under the tolerance: its arcs keep their bends."""
    up, down = [[0.2, 0.5002], [0.5, 0.5004], [0.8, 0.5002]], [[0.2, 0.4998], [0.5, 0.4996], [0.8, 0.4998]]
    a, b = [0.0, 0.5], [1.0, 0.5]
    top = [[a, *up, b, [1.0, 1.0], [0.0, 1.0]]]
    bottom = [[[0.0, 0.0], [1.0, 0.0], b, *down[::-1], a]]
    sliver = [[a, *down, b, *up[::-1]]]
    tiles = layer(spark, [("t", top), ("b", bottom), ("s", sliver)])
    out = {r.side: r.polygons for r in territory.dissolve(tiles, "idx", "side", tolerance=0.01).collect()}
    assert set(out) == {"t", "b", "s"} and outlines._area([tuple(q) for q in out["s"][0][0]]) > 0
    lines = outlines.arcs(tiles, "idx", "side", 0.01)
    assert outlines.conflicts(lines, 0.1).count() == 0
    assert {tuple(r.groups) for r in lines.collect()} == {("t",), ("b",), ("b", "s"), ("s", "t")}


def test_crossings_touches_and_covers_are_conflicts(spark):
    rows = [(1, [[0.0, 0.0], [1.0, 1.0]]), (2, [[0.0, 1.0], [1.0, 0.0]]), (3, [[2.0, 0.0], [3.0, 0.0]]), (4, [[2.5, 0.0], [2.5, 1.0]]), (5, [[3.0, 0.0], [3.5, 0.0]]), (6, [[5.0, 0.0], [6.0, 0.0]]), (7, [[6.0, 0.0], [5.0, 0.0]]), (8, [[7.0, 0.0], [9.0, 0.0]]), (9, [[8.0, 0.0], [10.0, 0.0]])]
    lines = spark.createDataFrame(rows, "arc long, line array<array<double>>")
    assert sorted(r.arc for r in outlines.conflicts(lines, 0.3).collect()) == [1, 2, 3, 4, 6, 7, 8, 9]


def test_closed_lines_keep_an_area():
    ring = np.array([(np.cos(a), np.sin(a)) for a in np.linspace(0, 2 * np.pi, 60)])
    ring[-1] = ring[0]
    assert len(outlines.thinned(ring, 5.0)) >= 4 and len(outlines.thinned(ring, 0.0)) == 60


def test_containment_with_large_shapes_and_dense_cells(spark, monkeypatch):
    from waymark.operators import spatial

    monkeypatch.setattr(spatial, "DENSE", 10)
    comb = [[[float(x), 0.0 if x % 2 else 30.0] for x in range(41)] + [[40.0, 40.0], [0.0, 40.0]]]
    shapes = spark.createDataFrame([(1, [comb]), (2, [cell(0.5, 29.0, 0.2, 0.2)]), (3, [])], f"idx long, polygons {geo.POLYGONS}")
    points = [(k, 30.0 + (k % 7), (k * 37 % 400) / 10 + 0.05) for k in range(300)] + [(1000, 29.1, 0.6), (1001, None, 1.0), (1002, 90.0, 1.0)]
    got = {r.id: r.idx for r in spatial.contained(spark.createDataFrame(points, "id long, lat double, lng double"), shapes, "id").collect()}
    ring = [tuple(p) for p in comb[0]]
    assert got == {k: 1 for k, lat, lng in points if lat is not None and outlines._holds(ring, lng, lat)} | ({} if outlines._holds(ring, 0.6, 29.1) else {1000: 2})


def squares(n, sizes):
    return [[(x + a, y + a), (x + b, y + a), (x + b, y + b), (x + a, y + b)] for x in map(float, range(n)) for y in map(float, range(n)) for a, b in sizes]


def test_rings_are_nested_without_trying_all_pairs(monkeypatch):
    rings = squares(40, [(0.1, 0.9), (0.2, 0.8), (0.3, 0.7)])
    began = time.process_time()
    found = outlines.nested(rings)
    assert time.process_time() - began < 20  # over five minutes when each ring was tried against each greater one
    assert sorted(map(len, found)) == [1] * 1600 + [2] * 1600
    assert all(max(p[0]) > max(p[1]) and min(p[0]) < min(p[1]) and max(p[0])[0] - max(p[1])[0] < 0.11 for p in found if len(p) == 2)
    monkeypatch.setattr(outlines, "PAIRS", 50)
    assert outlines.nested(rings[:300]) == [p for p in found if p[0] in rings[:300]]
    assert outlines.nested([]) == [] and outlines.nested(rings[1:2]) == [[rings[1]]]


def test_small_outlines_are_dealt_to_several_tasks(spark):
    tiles = layer(spark, [(str(x % 2), cell(x, 0)) for x in range(4)])
    assert outlines.spread(tiles, "side").rdd.getNumPartitions() == 4
    out = territory.dissolve(tiles, "idx", "side")
    assert {r.side: (len(r.polygons), r.square_degrees) for r in out.collect()} == {"0": (2, 2.0), "1": (2, 2.0)}


def test_bands_grow_with_the_sides_and_polygons_are_listed_by_themselves(spark, monkeypatch):
    from waymark.operators import spatial

    wave = [[0.0 if y % 2 else 1.0, float(y)] for y in range(4000)]
    tower = [[*wave, [3.0, 3999.0], [3.0, 0.0]], [[2.0, 10.0], [2.5, 10.0], [2.5, 20.0], [2.0, 20.0]]]
    shapes = spark.createDataFrame([(5, [tower, cell(7, 0)[0:1], cell(2.2, 12, 0.1)]), (6, [cell(2.0, 10.0, 0.5, 10.0)]), (7, [])], f"idx long, polygons {geo.POLYGONS}")
    at = [(k, (k * 37 % 4100) + 0.3, (k * 91 % 800) / 100 + 0.003) for k in range(2000)] + [(9000, 15.0, 2.4), (9001, 12.5, 2.25), (9002, 0.5, 7.5), (9003, 15.0, 2.6)]
    kept = {}
    written = spatial.written
    monkeypatch.setattr(spatial, "written", lambda df, tag: kept.setdefault(tag, written(df, tag)))
    got = {r.id: r.idx for r in spatial.contained(spark.createDataFrame(at, "id long, lat double, lng double"), shapes, "id").collect()}
    inside = lambda polygons, x, y: any(sum(outlines._holds([tuple(p) for p in ring], x, y) for ring in polygon) % 2 for polygon in polygons)
    layers = [(r.idx, r.polygons) for r in shapes.collect()]
    assert got == {k: min(hit) for k, y, x in at if (hit := [idx for idx, polygons in layers if inside(polygons, x, y)])}
    assert (got[9000], got[9001], got[9002], got[9003]) == (6, 5, 5, 5)
    boxes = {(r.idx, r.part): r for r in kept["boxes"].collect()}
    assert sorted(boxes) == [(5, 0), (5, 1), (5, 2), (6, 0)] and boxes[5, 0]._bands > 200 and (boxes[5, 1]._w, boxes[5, 1]._e) == (7.0, 8.0)

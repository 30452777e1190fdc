import math
import random

from pyspark.sql import functions as F

from waymark.functions import geo
from waymark.operators import linking, search, spatial, stats, territory


def square(x, y, size=1.0):
    return [[[x, y], [x + size, y], [x + size, y + size], [x, y + size], [x, y]]]


LAYER = f"idx bigint, name string, jls string, county string, population int, area_km2 double, polygons {geo.POLYGONS}"


def layer(spark, *rows):
    return territory.settlements(spark.createDataFrame([(k, n, j, c, 100, 1.5, p if isinstance(p[0][0][0], list) else [p]) for k, (n, j, c, p) in enumerate(rows)], LAYER))


U = [[[0.0, 0.0], [3.0, 0.0], [3.0, 3.0], [2.0, 3.0], [2.0, 1.0], [1.0, 1.0], [1.0, 3.0], [0.0, 3.0]]]
RING = [[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0]], [[1.0, 1.0], [3.0, 1.0], [3.0, 3.0], [1.0, 3.0]]]


def test_distances(spark):
    row = spark.range(1).select(geo.haversine_m(F.lit(45.0), F.lit(16.0), F.lit(45.0), F.lit(16.0)).alias("z"), geo.haversine_m(F.lit(45.8150), F.lit(15.9819), F.lit(43.5081), F.lit(16.4402)).alias("d"), geo.plane_km(F.lit(45.8150), F.lit(15.9819), F.lit(43.5081), F.lit(16.4402)).alias("k")).first()
    assert row.z == 0 and abs(row.d - 259_000) < 2_000 and abs(row.k - 259) < 2
    box = spark.createDataFrame([(45.8, 16.0), (48.2, 16.4), (42.3, 13.4)], "lat double, lng double").select(geo.in_country(F.col("lat"), F.col("lng")).alias("i")).collect()
    assert [r.i for r in box] == [True, False, True]


def test_representative_points(spark):
    df = spark.createDataFrame([(1, [U]), (2, [RING]), (3, [square(5.0, 5.0)])], f"k int, p {geo.POLYGONS}")
    got = df.select("k", geo.representative_point(F.col("p")).alias("r"), geo.in_polygons(F.lit(1.5), F.lit(2.0), F.col("p")).alias("notch")).withColumn("inside", geo.in_polygons(F.col("r.lng"), F.col("r.lat"), F.lit(None).cast(geo.POLYGONS)))
    rows = {r.k: r for r in got.collect()}
    assert (rows[3].r.lat, rows[3].r.lng) == (5.5, 5.5)
    assert not rows[1].notch
    check = df.withColumn("r", geo.representative_point(F.col("p"))).select("k", geo.in_polygons(F.col("r.lng"), F.col("r.lat"), F.col("p")).alias("i"))
    assert all(r.i for r in check.collect())


def test_areas(spark):
    row = spark.createDataFrame([(square(0.0, 45.0)[0],)], "r array<array<double>>").select(geo.ring_area(F.col("r")).alias("a"), geo.ring_centroid(F.col("r")).alias("c"), geo.area_km2(F.lit(1.0), F.lit(45.5)).alias("k")).first()
    assert abs(row.a - 1) < 1e-9 and abs(row.c.lng - 0.5) < 1e-9 and abs(row.c.lat - 45.5) < 1e-9
    assert abs(row.k - 111.32**2 * math.cos(math.radians(45.5))) < 1e-6


def test_locate_first_feature_wins_and_falls_back(spark):
    near = layer(spark, ("A", "ja", "ca", square(14.0, 43.0)), ("B", "jb", "cb", square(14.5, 43.0)))
    wide = layer(spark, ("W", "w", "cw", square(13.0, 42.0, 4.0)))
    points = spark.createDataFrame([(1, 43.5, 14.7), (2, 43.5, 15.2), (3, 44.9, 13.5), (4, 10.0, 10.0), (5, None, None)], "id int, lat double, lng double")
    got = {r.id: (r.settlement, r.municipality, r.county) for r in spatial.locate(points, near, wide, "id").collect()}
    assert got == {1: ("A", "ja", "ca"), 2: ("B", "jb", "cb"), 3: (None, "W", "cw"), 4: (None, None, None), 5: (None, None, None)}


def test_names(spark):
    towns = layer(spark, ("Vid", "a", "c1", square(0.0, 0.0)), ("Sveti Vid", "b", "c2", square(2.0, 0.0)), ("Vid - Norin", "c", "c2", square(4.0, 0.0)), ("Vrh", "d", "c1", square(6.0, 0.0)), ("Vrh", "e", "c2", square(8.0, 0.0)))
    asked = spark.createDataFrame([(1, "Vid"), (2, "Id"), (3, None)], "id int, city string")
    got = sorted((r.id, r.idx, r.exact) for r in spatial.name_candidates(asked, towns, "id").collect())
    assert got == [(1, 0, True), (1, 1, False), (1, 2, False)]
    ask = spark.createDataFrame([(1, "Vid", "c9"), (2, "Vrh", None), (3, "Vrh", "c2"), (4, "Vrh", "c9")], "id int, name string, county string")
    assert sorted((r.id, r.lng) for r in spatial.unique_by_name(ask, towns, "id").collect()) == [(1, 0.5), (3, 8.5)]


def test_assign_and_agreement(spark):
    towns = layer(spark, ("A", "j1", "c1", square(14.0, 43.0)), ("B", "j1", "c1", square(15.0, 43.0)), ("C", "j2", "c1", square(16.0, 43.0)), ("D", "j3", "c2", square(17.0, 43.0)))
    parishes = spark.createDataFrame([(1, "p", "X", 43.5, 14.5), (2, "q", "Y", 43.4, 14.4), (3, "r", "Y", 43.6, 14.6), (4, "s", "Z", 43.5, 17.5)], "id bigint, name string, diocese string, lat double, lng double")
    got = {r.idx: (r.diocese, r.direct) for r in territory.assign(towns, parishes).collect()}
    assert got[0] == ("Y", True) and got[3] == ("Z", True)
    assert got[1][1] is False and got[1][0] in ("X", "Y") and got[2][1] is False and got[2][0] in ("X", "Y")
    limits = spark.createDataFrame([("Y", [square(14.0, 43.0, 2.0)[0]])], "name string, rings array<array<array<double>>>")
    row = territory.agreement(towns, territory.assign(towns, parishes), limits).first()
    assert row.total >= 1 and row.hit >= 1


def test_dissolve_and_polygonize(spark):
    tiles = [("A", "j", "c", square(float(x), float(y))) for x in range(2) for y in range(2)]
    out = territory.dissolve(layer(spark, *tiles).withColumn("g", F.lit("G")), "idx", "g").first()
    assert len(out.rings) == 1 and len(out.rings[0]) == 4 and abs(out.square_degrees - 4) < 1e-9
    ways = [("way", "outer", [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]), ("way", None, [(1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]), ("way", "inner", [(0.2, 0.2), (0.3, 0.2)])]
    rel = spark.createDataFrame([("relation", ("N",), ways), ("node", ("M",), [])], "type string, tags struct<name:string>, members array<struct<type:string,role:string,geometry:array<struct<lon:double,lat:double>>>>")
    got = territory.polygonize(rel).collect()
    assert [r.name for r in got] == ["N"] and len(got[0].rings[0]) == 4
    assert abs(territory.iou_of([[(0, 0), (2, 0), (2, 2), (0, 2)]], [[(1, 0), (3, 0), (3, 2), (1, 2)]]) - 1 / 3) < 1e-6


def test_resolve(spark):
    towns = layer(spark, ("Kraj", "j1", "c1", square(14.0, 43.0)), ("Kraj", "j2", "c2", square(18.0, 45.0)), ("Bol", "j3", "c1", square(15.0, 43.0)), ("Sam", "j4", "c3", square(16.0, 44.0)))
    wide = layer(spark, ("W1", "w", "c1", square(13.0, 42.0, 3.0)), ("W2", "w", "c2", square(17.5, 44.5, 2.0)), ("W3", "w", "c3", square(16.0, 43.9, 1.2)))
    rows = [("1", "D", "Sam", 42.4, 13.5), ("2", "D", "Kraj", 42.4, 18.9), ("3", "D", "Bol", 43.5, 15.5), ("4", "D", "Kraj", 45.5, 18.5), ("5", "D", "Bol", None, None), ("6", "E", "Nigdje", 43.5, 14.5), ("7", "D", "x", 43.5, 15.5), ("8", "F", "Kraj", 43.5, 14.5)]
    parishes = spark.createDataFrame(rows, "registry_id string, diocese string, city string, lat double, lng double")
    overrides = spark.createDataFrame([("7", "Kraj", "j1")], "registry_id string, settlement string, municipality string")
    allowed = spark.createDataFrame([("D", "c1")], "diocese string, county string")
    got = {r.registry_id: (r.action, r.target) for r in linking.resolve_seats(parishes, towns, wide, overrides, allowed).collect()}
    assert got == {"1": ("fix", 3), "2": ("drop", None), "3": ("keep", None), "4": ("fix", 0), "5": ("keep", None), "6": ("keep", None), "7": ("fix", 0), "8": ("keep", None)}
    moved = linking.apply_fixes(parishes.withColumn("name", F.lit("ŽUPA SV. ROKA")), linking.resolve_seats(parishes, towns, wide, overrides, allowed), towns, spark.createDataFrame([(1, "Crkva sv. Roka", "Kraj", 43.2, 14.2)], "id bigint, name string, settlement string, lat double, lng double"))
    spots = {r.registry_id: (r.lat, r.lng) for r in moved.collect()}
    assert spots["7"] == (43.2, 14.2) and spots["2"] == (None, None) and spots["1"] == (44.5, 16.5) and spots["3"] == (43.5, 15.5)
    county = linking.settled_counties(parishes, towns, overrides)
    assert sorted(map(tuple, county.collect())) == [("D", "c1"), ("D", "c2"), ("F", "c1")]


def test_verification_and_stats(spark):
    df = spark.createDataFrame([(100.0,), (300.0,), (500.0,), (800.0,), (None,)], "m double")
    assert [r.v for r in df.select(spatial.verification(F.col("m")).alias("v")).collect()] == ["verified", "verified", "undecided", "conflict", "unknown"]
    assert spark.range(1).select(stats.percent(F.lit(1), F.lit(3)).alias("p"), stats.percent(F.lit(1), F.lit(0)).alias("q")).first() == ("33.3 %", "—")
    people = spark.createDataFrame([(1, 2, 0, "b"), (1, 1, 1, "c"), (1, 3, 0, "a")], "p int, k int, main int, name string")
    assert [i.k for i in stats.child_list(people, "p", "main", "name", ["k"]).first()["items"]] == [1, 3, 2]
    assert stats.label_map(people, "name").first().counts == {"a": 1, "b": 1, "c": 1}


def test_search(spark):
    docs = spark.createDataFrame([(1, "Crkva svetog Đurđa", "Đakovo"), (2, "Crkva sv. Špire", "Split")], "id int, name string, city string")
    index = search.token_index(docs, "id", ["name", "city"])
    ids = lambda q: sorted(r.id for r in search.search_all(index, "id", q).collect())
    assert ids("spire split") == [2] and ids("crkva") == [1, 2] and ids("durda") == [] and ids("đurđa") == [1] and ids("spl*") == [2] and ids(" ") == []
    assert [r.id for r in search.search_text(docs, ["name", "city"], "djur").collect()] == []
    assert [r.id for r in search.search_text(docs, ["name", "city"], "DURDA").collect()] == [1]
    order = spark.createDataFrame([(w,) for w in ("Žir", "Zid", "Čep", "Cap", "Dom", "Đak")], "w string").orderBy(search.locale_order(F.col("w")))
    assert [r.w for r in order.collect()] == ["Cap", "Čep", "Dom", "Đak", "Zid", "Žir"]


def test_overlap_is_exact_for_any_rings():
    square, bowtie = [[(0, 0), (4, 0), (4, 4), (0, 4)]], [[(0, 0), (4, 4), (4, 0), (0, 4)]]
    assert territory.overlap_of(square, square) == (16.0, 16.0) and territory.overlap_of(square, []) == (0.0, 16.0)
    both, either = territory.overlap_of(square, bowtie)
    assert abs(both - 8) < 1e-12 and abs(either - 16) < 1e-12
    holed = [*square, [(1, 1), (3, 1), (3, 3), (1, 3)]]
    slanted = [[(2, -1), (5, 2), (2, 5), (-1, 2)]]
    both, either = territory.overlap_of(holed, slanted)
    # the square's corners beyond the diamond are triangles of half a unit each, and the hole lies inside the diamond
    assert abs(both - 10) < 1e-12 and abs(either - 20) < 1e-12
    assert territory.iou_of([[(0, 0), (1, 1)]], []) == 0.0


def test_nearest_in_circles_at_any_density(spark):
    r = random.Random(2)
    pool = [(k, 45 + r.gauss(0, 0.01), 16 + r.gauss(0, 0.01), "a" if k % 2 else "b", "w") for k in range(80)] + [(90, -30.0, 170.0, "c", "w"), (91, None, 1.0, "d", "w")]
    asked = [(k, 45 + r.gauss(0, 2), 16 + r.gauss(0, 2), r.choice("abcd"), "w") for k in range(60)]
    schema = "id long, lat double, lng double, n string, w string"
    got = {x.id: (x.p_id, x.circle) for x in spatial.concentric(spark.createDataFrame(asked, schema), spark.createDataFrame(pool, schema), "id", "id", ["n", "w"]).collect()}
    apart = lambda a, b: ((a[1] - b[1]) ** 2 + ((a[2] - b[2]) * math.cos(math.radians((a[1] + b[1]) / 2))) ** 2, b[0])
    for a in asked:
        near = [p for p in pool if p[3] == a[3] and p[1] is not None]
        best = min(near or [p for p in pool if p[1] is not None], key=lambda p: apart(a, p))
        assert got[a[0]] == (best[0], 0 if near else 1)


def test_nearest_of_crowded_points_meets_few_of_them(spark, monkeypatch):
    r, met = random.Random(4), []
    within = spatial.within
    monkeypatch.setattr(spatial, "within", lambda *a: met.append(within(*a)) or met[-1])
    spots = [(45 + r.gauss(0, 0.1), 16 + r.gauss(0, 0.1)) for _ in range(60)] + [(45.9, 16.9), (48.0, 16.0)]
    asked = [(k, *spots[k % len(spots)]) for k in range(300)] + [(900, None, 16.0)]
    pool = [(k, 45 + r.gauss(0, 0.1), 16 + r.gauss(0, 0.1)) for k in range(400)]
    pool += [(k + 400, lat, lng) for k, lat, lng in pool[:200]] + [(999, 45.0, None)]
    schema = "id long, lat double, lng double"
    left, right = spark.createDataFrame(asked, schema), spark.createDataFrame(pool, schema)
    want = {}
    for x in within(left, right, 90.0).collect():
        want[x.id] = min(want.get(x.id, (math.inf, 0)), (x.metres, x.r_id))
    assert 0 < len(want) < 300
    got = {x.id: (x.metres, x.r_id) for x in spatial.nearest_within(left, right, "id", "id", 90.0).collect()}
    assert got == want and len(met) > 2 and sum(m.count() for m in met) < 3_000  # over 100,000 pairs in the whole radius
    even = {x.id: (x.metres, x.r_id) for x in spatial.nearest_within(left, right, "id", "id", 90.0, F.col("r_id") % 2 == F.col("id") % 2).collect()}
    for x in within(left, right, 90.0).where("id % 2 = r_id % 2").collect():
        assert even[x.id] <= (x.metres, x.r_id)
    assert even.keys() == want.keys()


def test_k_nearest_of_crowded_points_meets_few_of_them(spark, monkeypatch):
    r, met = random.Random(5), []
    within = spatial.within
    spots = [(45 + r.gauss(0, 0.1), 16 + r.gauss(0, 0.1)) for _ in range(300)] + [(45.9, 16.9), (48.0, 16.0), (45.4, 16.2)]
    rows = [(k, *spots[k], "t") for k in range(len(spots))] + [(k, *spots[k % 7], "u") for k in range(400, 700)] + [(900, None, 16.0, "v"), (None, 45.0, 16.0, "w")]
    points = spark.createDataFrame(rows, "id long, lat double, lng double, tag string")
    want = {}
    for x in within(points, points, 90.0).where("id <> r_id").collect():
        want.setdefault(x.id, []).append((x.metres, x.r_id, x.r_tag))
    want = {(id_, n): near for id_, all_ in want.items() for n, near in enumerate(sorted(all_)[:5], 1)}
    assert len(want) > 2900 and (301, 1) not in want
    monkeypatch.setattr(spatial, "within", lambda *a: met.append(within(*a)) or met[-1])
    got = spatial.k_nearest(points, "id", 5, 90.0)
    assert {(x.id, x.nth): (x.metres, x.r_id, x.r_tag) for x in got.collect()} == want and got.count() == len(want)
    assert len(met) > 2 and sum(m.count() for m in met) < 30_000  # over 350,000 of all pairs within the whole radius
    assert {"tag", "lat", "lng", "r_lat"} <= set(got.columns) and "_nth" not in got.columns

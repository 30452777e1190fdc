"""Pages, seats and conflicts on small tables: empty ones, nulls, ties and stale rows."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.operators import publish, upkeep
from waymark.plans import upkeep as plans


def test_pages_keep_persons_without_buildings_and_drop_kinds_without_pages(spark):
    persons = spark.createDataFrame([(1, "a", "zupa", "A"), (2, "b", "samostan", ""), (3, "c", "biskupija", "C"), (4, "d", None, "D")], "id long, slug string, kind string, name string")
    buildings = spark.createDataFrame([(10, "Z", 1, None), (11, "Y", 1, 1), (12, "X", 1, 0), (13, "W", None, 1)], "id long, name string, parish_id long, is_parish_church int")
    pages = publish.person_pages(persons, buildings, ["id", "name"])
    docs = {r.slug: (r.route, json.loads(r.document)) for r in publish.documents(pages).collect()}
    assert set(docs) == {"a", "b"} and docs["a"][0] == "zupa" and docs["b"][0] == "ustanova"
    assert [c["id"] for c in docs["a"][1]["churches"]] == [11, 12, 10]
    assert docs["a"][1]["has_parish_church"] == 1 and docs["b"][1]["church_count"] == 0 and docs["b"][1]["churches"] == []
    assert "name" not in docs["b"][1]
    routed = {r.id: r.person_slug for r in publish.with_route(buildings, pages).collect()}
    assert routed == {10: "a", 11: "a", 12: "a", 13: None}
    assert publish.person_pages(persons.limit(0), buildings.limit(0), ["id"]).count() == 0


def test_orders_put_unknown_first_going_up_and_last_going_down(spark):
    rows = spark.createDataFrame([(1, 2.0), (2, None), (3, 5.0)], "id long, distance_m double")
    assert [r.id for r in publish.in_order(rows, "conflicts").collect()] == [3, 1, 2]
    named = spark.createDataFrame([("b", None, "x"), (None, "c", "y"), ("a", "c", "z")], "county string, city string, name string")
    assert [r.name for r in publish.in_order(named, "buildings").collect()] == ["y", "z", "x"]


def test_conflicts_of_judged_parishes_are_replaced(spark):
    old = spark.createDataFrame([(1, 1, 900.0), (2, 2, 800.0)], "parish_id long, church_id long, distance_m double")
    judged = spark.createDataFrame([(1, 1, 100.04), (3, 3, 750.06), (4, 3, None), (5, 1, 400.0)], "parish_id long, church_id long, metres double")
    assert {tuple(r) for r in upkeep.replace_conflicts(old, judged).collect()} == {(2, 2, 800.0), (3, 3, 750.1)}
    buildings = spark.createDataFrame([(1, 1, 2.0), (3, 1, 2.0), (9, 1, 2.0)], "id long, geo_verified int, geo_verify_m double")
    assert {tuple(r) for r in upkeep.verified_churches(buildings, judged).collect()} == {(1, 0, 400.0), (3, 0, None), (9, 1, 2.0)}
    assert upkeep.replace_conflicts(old.limit(0), judged.limit(0)).count() == 0


def test_schema_gains_columns_and_loses_none(spark):
    wanted = T.StructType([T.StructField("id", T.LongType()), T.StructField("duplicate_of", T.LongType())])
    out = upkeep.migrated(spark.range(2).withColumn("own", F.lit("x")), wanted)
    assert out.columns == ["id", "own", "duplicate_of"] and dict(out.dtypes)["duplicate_of"] == "bigint"
    assert upkeep.migrated(out, wanted).columns == out.columns


def test_pending_needs_something_to_look_for(spark):
    rows = [(1, None, "a", None, None, None), (2, None, None, None, None, None), (3, 1.0, "a", "c", None, None), (4, None, None, "c", "aktivna", None), (5, None, None, "c", "PRESTANAK", None), (6, None, None, "c", None, 4)]
    persons = spark.createDataFrame(rows, "id long, lat double, address string, city string, registry_status string, duplicate_of long")
    assert sorted(r.id for r in upkeep.pending(persons).collect()) == [1, 4]


def test_clusters_by_zoom(spark):
    points = spark.createDataFrame([(45.0, 16.0), (45.0001, 16.0001), (43.0, 18.0), (None, 1.0)], "lat double, lng double")
    assert sorted(r.n for r in publish.clusters(points, 5).collect()) == [1, 2]
    assert [r.n for r in publish.clusters(points, 12).collect()] == [1, 1, 1]


def test_markup_leaves_out_what_is_empty(spark):
    row = spark.createDataFrame([("a", "/a", "A", 45.0, 16.0, "", None)], "slug string, path string, name string, lat double, lng double, address string, city string")
    assert json.loads(publish.place_markup(row, "https://a.b/").first().document) == {"@context": "https://schema.org", "@type": "PlaceOfWorship", "name": "A", "url": "https://a.b/a", "geo": {"@type": "GeoCoordinates", "latitude": 45.0, "longitude": 16.0}}


def test_a_number_is_asked_of_names_and_not_of_towns(spark, tmp_path):
    spark.createDataFrame([(k, f"Supplier#{k}", 1) for k in (12, 15, 16)], "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(7, "Customer#7")], "c_custkey long, c_name string").write.parquet(f"{tmp_path}/customer.parquet")
    found = plans.QUERIES["browsed_persons"](spark, str(tmp_path))  # 16 is of the town Č5
    assert sorted(r.slug for r in found.collect()) == ["s-12", "s-15"]

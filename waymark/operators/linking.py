"""Compositions that link buildings, registers and legal persons, and that correct seats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo, rules, similarity, text
from . import match, merge, spatial

FILIAL_KM, SEAT_KM, ENRICH_KM, ANCHOR_M, NAME_MIN, COUNTY_SUPPORT = 25.0, 30.0, 0.15, 15_000.0, 70.0, 1
# Kinds of legal persons that may own a church.
OWNER_KINDS = ("zupa", "samostan", "svetiste", "parohija", "dzemat", "crkvena-opcina")


def link_heritage(heritage: DataFrame, buildings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links, queue left): records (id, name, settlement, municipality) matched in two tiers, each building once."""
    records = heritage.select(F.col("id").alias("rec_id"), "name", "settlement", "municipality")
    asked = match.once(records, ["settlement", "municipality"], lambda places: places.withColumn("tiers", F.array(text.place_keys(F.col("settlement")), text.place_keys(F.col("municipality")))))
    links = match.exclusive(match.best_match(asked, match.candidate_index(buildings, ["city", "settlement", "municipality"])))
    return links, merge.without_consumed(heritage, links.select(F.col("rec_id").alias("id")), ["id"])


def near_enough(lat1: Column, lng1: Column, lat2: Column, lng2: Column, km: float = FILIAL_KM) -> Column:
    """Unknown places pass."""
    return F.coalesce(geo.plane_km(lat1, lng1, lat2, lng2) <= km, F.lit(True))


def link_parish_churches(parishes: DataFrame, buildings: DataFrame) -> DataFrame:
    """(rec_id, cand_id, score, lat, lng): the church of each parish (id, name, city, lat, lng).

    A match too far from the parish's own seat is dropped before the church is given to the first
    of the parishes that want it; a parish without a seat takes over the church's. Where parishes have a
    column kind, only kinds that may own a church take part.
    """
    parishes = parishes.where(F.col("kind").isin(*OWNER_KINDS)) if "kind" in parishes.columns else parishes
    asked = match.once(parishes.select(F.col("id").alias("rec_id"), "name", "city"), ["city"], lambda places: places.withColumn("tiers", F.array(text.place_keys(F.col("city")))))
    found = match.best_match(asked, match.candidate_index(buildings, ["city", "settlement", "municipality"])).where("cand_id is not null").select("rec_id", "cand_id", "score")
    seats = parishes.select(F.col("id").alias("rec_id"), F.col("lat").alias("p_lat"), F.col("lng").alias("p_lng"))
    places = buildings.select(F.col("id").alias("cand_id"), F.col("lat").alias("c_lat"), F.col("lng").alias("c_lng"))
    near = found.join(seats, "rec_id").join(places, "cand_id").where(near_enough(F.col("p_lat"), F.col("p_lng"), F.col("c_lat"), F.col("c_lng")))
    return match.exclusive(near).select("rec_id", "cand_id", "score", F.coalesce("p_lat", "c_lat").alias("lat"), F.coalesce("p_lng", "c_lng").alias("lng"))


def link_filials(buildings: DataFrame, claimants: DataFrame) -> DataFrame:
    """(building, parish): buildings (id, places, lat, lng) whose place keys only one parish (id, places, lat, lng) has."""
    b = buildings.select(F.col("id").alias("building"), F.explode("places").alias("place"))
    p = claimants.select(F.col("id").alias("parish"), F.explode("places").alias("place"))
    only = match.only_claimant(b.join(p, "place"), "building", "parish")
    spots = only.join(buildings.select(F.col("id").alias("building"), F.col("lat").alias("b_lat"), F.col("lng").alias("b_lng")), "building").join(claimants.select(F.col("id").alias("parish"), F.col("lat").alias("p_lat"), F.col("lng").alias("p_lng")), "parish")
    return spots.where(near_enough(F.col("b_lat"), F.col("b_lng"), F.col("p_lat"), F.col("p_lng"))).select("building", "parish")


def enrich(buildings: DataFrame, items: DataFrame) -> DataFrame:
    """(qid, building, how): items (qid, name, lat, lng) met by id, else by the nearest building within 150 m
    whose dedication does not differ; how is id, place or new."""
    known = buildings.where("wikidata is not null").groupBy(F.col("wikidata").alias("qid")).agg(F.max("id").alias("by_id"))
    a = items.withColumn("_ta", rules.dedication_key(F.col("name")))
    b = buildings.select("id", "lat", "lng", rules.dedication_key(F.col("name")).alias("tb"))
    near = spatial.nearest_within(a.join(known, "qid", "left_anti"), b, "qid", "id", ENRICH_KM, F.coalesce(F.col("_ta") == F.col("r_tb"), F.lit(True)))
    both = items.select("qid").join(known, "qid", "left").join(near.select("qid", F.col("r_id").alias("by_place")), "qid", "left")
    return both.select("qid", F.coalesce("by_id", "by_place").alias("building"), F.when(F.col("by_id").isNotNull(), "id").when(F.col("by_place").isNotNull(), "place").otherwise("new").alias("how"))


def first_acceptable(results: DataFrame, name_min: float = NAME_MIN, anchor_m: float = ANCHOR_M) -> DataFrame:
    """(rec_id, query_no, result_no): of ordered search results the first that is sacral or alike in name,
    near the anchor if there is one, and in the person's county where both are known.

    Columns: rec_id, query_no, result_no, person_name, result_name, is_sacral, lat, lng, anchor_lat, anchor_lng, county, found_county.
    """
    alike = F.col("is_sacral") | (similarity.ratio(text.norm_key(F.col("person_name")), text.norm_key(F.col("result_name"))) >= name_min)
    near = F.coalesce(geo.haversine_m(F.col("anchor_lat"), F.col("anchor_lng"), F.col("lat"), F.col("lng")) <= anchor_m, F.lit(True))
    same = F.coalesce(F.nullif(F.col("county"), F.lit("")) == F.nullif(F.col("found_county"), F.lit("")), F.lit(True))
    return results.where(alike & near & same).groupBy("rec_id").agg(F.min(F.struct("query_no", "result_no")).alias("m")).select("rec_id", "m.*")


def settled_counties(parishes: DataFrame, settlements: DataFrame, overrides: DataFrame, support: int = COUNTY_SUPPORT) -> DataFrame:
    """(diocese, county): where a diocese surely has parishes. Overridden parishes count at their corrected place,
    others where their point lies in a settlement of the name in the register."""
    goal = overrides.join(settlements.select(text.fold_key(F.col("name")).alias("_key"), "jls", "county"), (text.fold_key(overrides["settlement"]) == F.col("_key")) & (overrides["municipality"] == F.col("jls"))).select("registry_id", F.col("county").alias("o_county"))
    named = spatial.name_candidates(parishes, settlements, "registry_id").join(settlements.select("idx", "county", "polygons"), "idx")
    own = named.join(parishes.select("registry_id", "lat", "lng"), "registry_id").where(geo.in_polygons(F.col("lng"), F.col("lat"), F.col("polygons")))
    first = own.groupBy("registry_id").agg(F.min_by("county", F.struct(~F.col("exact"), F.col("idx"))).alias("n_county"))
    placed = parishes.join(goal, "registry_id", "left").join(first, "registry_id", "left").withColumn("_county", F.coalesce("o_county", "n_county"))
    return placed.where("_county is not null and coalesce(diocese, '') <> ''").groupBy("diocese", F.col("_county").alias("county")).agg(F.count("*").alias("n")).where(F.col("n") >= support).select("diocese", "county")


def resolve_seats(parishes: DataFrame, settlements: DataFrame, municipalities: DataFrame, overrides: DataFrame, allowed: DataFrame, far_km: float = SEAT_KM) -> DataFrame:
    """(registry_id, action, target idx, reason): keep, fix or drop the point of each parish.

    Order: an override decides; no point, keep; a point far from every settlement of the name is
    moved if there is one such settlement and dropped if there are more; a point in a county where
    the diocese has parishes stays; else it moves if one settlement of the name, exact ones first, is allowed.
    """
    key = "registry_id"
    goals = overrides.join(settlements.select(F.col("idx").alias("o_idx"), text.fold_key(F.col("name")).alias("_key"), "jls", F.col("polygons").alias("o_poly")), (text.fold_key(overrides["settlement"]) == F.col("_key")) & (overrides["municipality"] == F.col("jls")), "left")
    goals = goals.groupBy(key).agg(F.min_by(F.struct("o_idx", "o_poly"), "o_idx").alias("o"), F.lit(True).alias("has_override"))
    named = spatial.name_candidates(parishes, settlements, key).join(settlements.select("idx", F.col("lat").alias("s_lat"), F.col("lng").alias("s_lng"), "polygons", F.col("county").alias("s_county")), "idx")
    named = named.join(parishes.select(key, "lat", "lng", "diocese"), key).join(allowed.select(F.col("diocese").alias("a_d"), F.col("county").alias("a_c"), F.lit(True).alias("ok")), (F.col("diocese") == F.col("a_d")) & (F.col("s_county") == F.col("a_c")), "left")
    ok, exact = F.coalesce(F.col("ok"), F.lit(False)), F.col("exact")
    tally = named.groupBy(key).agg(
        F.coalesce(F.bool_or(geo.in_polygons(F.col("lng"), F.col("lat"), F.col("polygons"))), F.lit(False)).alias("inside"),
        F.min(geo.plane_km(F.col("lat"), F.col("lng"), F.col("s_lat"), F.col("s_lng"))).alias("least_km"),
        F.count_if(exact).alias("n_exact"), F.count("*").alias("n_all"), F.max(F.when(exact, F.col("idx"))).alias("one_exact"), F.max("idx").alias("one_any"),
        F.count_if(exact & ok).alias("ok_exact"), F.count_if(ok).alias("ok_all"), F.max(F.when(exact & ok, F.col("idx"))).alias("ok_exact_idx"), F.max(F.when(ok, F.col("idx"))).alias("ok_idx"),
    )
    here = spatial.locate(parishes.select(key, "lat", "lng"), settlements, municipalities, key).select(key, F.col("county").alias("here"))
    lists = allowed.groupBy("diocese").agg(F.collect_set("county").alias("counties"))
    rows = parishes.join(goals, key, "left").join(tally, key, "left").join(here, key, "left").join(lists, "diocese", "left")
    has = F.coalesce(F.col("has_override"), F.lit(False))
    at_goal = F.coalesce(geo.in_polygons(F.col("lng"), F.col("lat"), F.col("o.o_poly")), F.lit(False))
    nowhere = F.col("lat").isNull()
    far = ~F.col("inside") & (F.col("least_km") > far_km)
    few = F.when(F.col("n_exact") > 0, F.col("n_exact")).otherwise(F.col("n_all"))
    fine = F.col("counties").isNull() | F.col("here").isNull() | F.array_contains("counties", F.col("here"))
    verdict = lambda action, target, reason: F.struct(action.alias("action"), target.cast("bigint").alias("target"), reason.alias("reason"))
    decided = (
        F.when(has & F.col("o.o_idx").isNotNull() & ~at_goal, verdict(F.lit("fix"), F.col("o.o_idx"), F.lit("override")))
        .when(has | nowhere, verdict(F.lit("keep"), F.lit(None).cast("bigint"), F.lit("settled")))
        .when(far & (few == 1), verdict(F.lit("fix"), F.when(F.col("n_exact") > 0, F.col("one_exact")).otherwise(F.col("one_any")), F.lit("far")))
        .when(far, verdict(F.lit("drop"), F.lit(None).cast("bigint"), F.lit("far")))
        .when(fine, verdict(F.lit("keep"), F.lit(None).cast("bigint"), F.lit("settled")))
        .when(F.col("ok_exact") == 1, verdict(F.lit("fix"), F.col("ok_exact_idx"), F.lit("county")))
        .when(F.col("ok_all") == 1, verdict(F.lit("fix"), F.col("ok_idx"), F.lit("county")))
        .otherwise(verdict(F.lit("keep"), F.lit(None).cast("bigint"), F.lit("unclear")))
    )
    d = rows.select(key, decided.alias("d"))
    return d.select(key, "d.*")


def apply_fixes(parishes: DataFrame, resolved: DataFrame, settlements: DataFrame, buildings: DataFrame) -> DataFrame:
    """Parishes with new lat and lng: for a fix the church of the same dedication in the target, else a point truly inside it."""
    key = "registry_id"
    goal = settlements.select(F.col("idx").alias("target"), text.fold_key(F.col("name")).alias("t_key"), "polygons", geo.representative_point(F.col("polygons")).alias("r"))
    fixes = resolved.where("action = 'fix'").join(goal, "target").join(parishes.select(key, rules.dedication_key(F.col("name")).alias("t")), key)
    own = buildings.select(text.fold_key(F.col("settlement")).alias("t_key"), rules.dedication_key(F.col("name")).alias("t"), F.col("lat").alias("b_lat"), F.col("lng").alias("b_lng"), F.col("id").alias("b_id"))
    churches = fixes.join(own, ["t_key", "t"]).where(geo.in_polygons(F.col("b_lng"), F.col("b_lat"), F.col("polygons"))).groupBy(key).agg(F.min_by(F.struct("b_lat", "b_lng"), "b_id").alias("c"))
    moved = fixes.join(churches, key, "left").select(key, F.coalesce("c.b_lat", "r.lat").alias("n_lat"), F.coalesce("c.b_lng", "r.lng").alias("n_lng"))
    joined = parishes.join(resolved.select(key, "action"), key, "left").join(moved, key, "left")
    lat, lng = (F.when(F.col("action") == "drop", None).when(F.col("action") == "fix", F.col(f"n_{c}")).otherwise(F.col(c)).alias(c) for c in ("lat", "lng"))
    return joined.select(*(lat if c == "lat" else lng if c == "lng" else c for c in parishes.columns))


def geocode(parishes: DataFrame, churches: DataFrame, centroids: DataFrame, geocoded: DataFrame | None = None) -> DataFrame:
    """Fills missing points from the own church, else the settlement's centre, else landed geocoder answers; geo_source tells which."""
    steps = [("church", churches), ("centroid", centroids), *([("geocoder", geocoded)] if geocoded is not None else [])]
    out = parishes.withColumn("geo_source", F.when(F.col("lat").isNotNull(), F.lit("own")))
    for name, df in steps:
        side = df.select("id", F.col("lat").alias("_lat"), F.col("lng").alias("_lng"))
        filled = F.col("lat").isNull() & F.col("_lat").isNotNull()
        out = out.join(side, "id", "left").withColumn("geo_source", F.when(filled, F.lit(name)).otherwise(F.col("geo_source"))).withColumn("lat", F.coalesce("lat", "_lat")).withColumn("lng", F.coalesce("lng", "_lng")).drop("_lat", "_lng")
    return out

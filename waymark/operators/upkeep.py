"""Upkeep of persons' seats and of their churches' verification, the tables' schemas, and checks of the matcher."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geo
from . import match, merge, spatial

# Kinds of dioceses with a territory, and the one that lies over all others.
TERRITORIAL_KINDS = ("nadbiskupija", "biskupija")
OVERLAPPING = ("krizevacka-eparhija",)


def migrated(df: DataFrame, wanted: T.StructType) -> DataFrame:
    """A stored table under a newer schema: columns that it lacks are added as nulls of their type, all others stay as they are."""
    have = {c.lower() for c in df.columns}
    return df.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in wanted.fields if f.name.lower() not in have))


def pending(persons: DataFrame) -> DataFrame:
    """Active persons, once each, without a point but with something to look for."""
    return persons.where(F.col("lat").isNull() & (F.col("address").isNotNull() | F.col("city").isNotNull()) & merge.active_distinct(F.col("registry_status"), F.col("duplicate_of")))


def territorial(dioceses: DataFrame) -> DataFrame:
    """Dioceses (kind, religion, slug) whose territories part the country."""
    return dioceses.where(F.col("kind").isin(*TERRITORIAL_KINDS) & (F.col("religion") == "christian") & ~F.col("slug").isin(*OVERLAPPING))


def border_key(c: Column) -> Column:
    """The key by which a diocese and a drawn border of its name meet."""
    return F.trim(F.translate(F.lower(c), "-", " "))


def backfill_county(persons: DataFrame, settlements: DataFrame, municipalities: DataFrame, id_: str = "id") -> DataFrame:
    """Fills the county of persons that have a point; a county that is known stays."""
    gaps = persons.where("county is null and lat is not null").select(id_, "lat", "lng")
    found = spatial.locate(gaps, settlements, municipalities, id_).select(id_, F.col("county").alias("_county"))
    return persons.join(found, id_, "left").withColumn("county", F.coalesce("county", "_county")).select(*persons.columns)


def refine(persons: DataFrame, hits: DataFrame, linked: DataFrame, settlements: DataFrame, municipalities: DataFrame, id_: str = "id") -> DataFrame:
    """Moves persons without a linked church (linked: their ids) to the place that a search found (hits: id, lat, lng, address).

    Those placed so before stay. Address and county are filled where they are missing.
    """
    open_ = persons.where(F.coalesce(F.col("geocode_source"), F.lit("")) != "places").select(id_)
    new = hits.select(id_, "lat", "lng", "address").join(open_, id_, "left_semi").join(linked.select(id_), id_, "left_anti")
    county = spatial.locate(new.select(id_, "lat", "lng"), settlements, municipalities, id_).select(id_, F.col("county").alias("_county"))
    placed = new.join(county, id_, "left").select(id_, F.col("lat").alias("_lat"), F.col("lng").alias("_lng"), F.col("address").alias("_address"), "_county", F.lit(True).alias("_hit"))
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    changed = {
        "lat": F.when(hit, F.col("_lat")).otherwise(F.col("lat")),
        "lng": F.when(hit, F.col("_lng")).otherwise(F.col("lng")),
        "geocode_source": F.when(hit, F.lit("places")).otherwise(F.col("geocode_source")),
        "address": F.coalesce("address", "_address"),
        "county": F.coalesce("county", "_county"),
    }
    return persons.join(placed, id_, "left").select(*(changed[c].alias(c) if c in changed else F.col(c) for c in persons.columns))


def replace_conflicts(conflicts: DataFrame, judged: DataFrame) -> DataFrame:
    """Conflicts (parish_id, church_id, distance_m) when judged (parish_id, church_id, metres) parishes replace their own earlier ones."""
    kept = conflicts.select("parish_id", "church_id", "distance_m").join(judged.select("parish_id"), "parish_id", "left_anti")
    new = judged.where(spatial.verification(F.col("metres")) == "conflict").select("parish_id", "church_id", F.round("metres", 1).alias("distance_m"))
    return kept.unionByName(new)


def verified_churches(buildings: DataFrame, judged: DataFrame) -> DataFrame:
    """Buildings with geo_verified and geo_verify_m of the new run; the judgement of the last parish counts, and one of conflict clears both."""
    outcome = spatial.verification(F.col("metres"))
    each = judged.where("metres is not null").select(F.col("church_id").alias("id"), "parish_id", (outcome == "verified").cast("int").alias("_ok"), F.when(outcome != "conflict", F.round("metres", 1)).alias("_m"))
    last = each.groupBy("id").agg(F.max_by(F.struct("_ok", "_m"), "parish_id").alias("_new"))
    new = {"geo_verified": F.when(F.col("_new").isNotNull(), F.col("_new._ok")).otherwise(F.col("geo_verified")), "geo_verify_m": F.when(F.col("_new").isNotNull(), F.col("_new._m")).otherwise(F.col("geo_verify_m"))}
    return buildings.join(last, "id", "left").select(*(new[c].alias(c) if c in new else F.col(c) for c in buildings.columns))


def outside_named(persons: DataFrame, settlements: DataFrame, id_: str = "id", name: str = "city") -> DataFrame:
    """(id, n_named) of persons whose point lies in none of the settlements that their registered place may name."""
    named = spatial.name_candidates(persons, settlements, id_, name).join(settlements.select("idx", "polygons"), "idx")
    met = named.join(persons.where("lat is not null and lng is not null").select(id_, "lat", "lng"), id_)
    tally = met.groupBy(id_).agg(F.count("*").alias("n_named"), F.bool_or(geo.in_polygons(F.col("lng"), F.col("lat"), F.col("polygons"))).alias("_in"))
    return tally.where(~F.coalesce(F.col("_in"), F.lit(False))).select(id_, "n_named")


def ablation(queries: DataFrame, index: DataFrame, variants: Mapping[str, Mapping[str, object]]) -> DataFrame:
    """(variant, links): how many records the matcher links under each variant's threshold, margin and tiered (false: all blocks at once)."""
    out, pool = None, match.candidates(index)
    for name, v in variants.items():
        asked = queries if v.get("tiered", True) else queries.withColumn("tiers", F.array(F.array_distinct(F.flatten("tiers"))))
        found = match.exclusive(match.best_match(asked, pool, v.get("threshold", match.THRESHOLD), v.get("margin", match.MARGIN)))
        row = found.agg(F.count("*").alias("links")).select(F.lit(name).alias("variant"), "links")
        out = row if out is None else out.unionByName(row)
    return out

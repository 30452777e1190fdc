"""Pages of the catalogue: who gets one, their documents, indexes, orders, figures and markup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..sources import sinks
from . import search, stats
from .numbering import numbered

# Kinds of legal persons that have pages, and the path segment of each.
ROUTES = {"zupa": "zupa", "samostan": "ustanova", "crkvena-opcina": "ustanova", "svetiste": "ustanova", "parohija": "ustanova", "dzemat": "ustanova"}

#: Orders of the exports by name; nulls come first going up and last going down.
ORDERS = {"points": ["id"], "territories": ["name"], "buildings": ["county", "city", "name"], "persons": ["diocese", "name"], "conflicts": ["distance_m desc"]}


def route(kind: Column) -> Column:
    """The path segment of a kind; null for kinds without pages."""
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in ROUTES.items() for x in kv)), F.coalesce(kind, F.lit("")))


def person_pages(persons: DataFrame, buildings: DataFrame, fields: Sequence[str], foreign: str = "parish_id", flag: str = "is_parish_church") -> DataFrame:
    """Persons (id, kind, ...) that have pages, with route, churches (flagged first, then by name), church_count and has_parish_church.

    A person without buildings keeps an empty list and a count of zero: the gap is a finding.
    """
    flagged = buildings.withColumn(flag, F.coalesce(F.col(flag).cast("int"), F.lit(0)))
    listed = stats.child_list(flagged, foreign, flag, "name", [*fields, flag]).withColumnRenamed(foreign, "id")
    out = persons.withColumn("route", route(F.col("kind"))).where("route is not null").join(listed, "id", "left")
    out = out.withColumn("churches", F.coalesce("items", F.array().cast(listed.schema["items"].dataType))).drop("items")
    return out.withColumn("church_count", F.size("churches")).withColumn("has_parish_church", F.exists("churches", lambda c: c[flag] == 1).cast("int"))


def documents(pages: DataFrame) -> DataFrame:
    """(route, slug, document) of pages, without empty fields; sinks.write_documents replaces the old ones."""
    return pages.select("route", "slug", F.to_json(F.struct(*sinks.clean_fields(pages, ("id",)))).alias("document"))


def with_route(buildings: DataFrame, pages: DataFrame, foreign: str = "parish_id") -> DataFrame:
    """Buildings with the route and slug of their person's page, null where it has none."""
    return buildings.join(pages.select(F.col("id").alias(foreign), F.col("route").alias("person_route"), F.col("slug").alias("person_slug")), foreign, "left")


def lookup(asked: DataFrame, table: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Many point lookups as one join; a key that is null or unknown finds nothing."""
    return asked.join(table.select(*keys, *fields), list(keys), "left")


def browse_persons(pages: DataFrame, part: str = "", diocese: str | None = None, only_gaps: bool = False, columns: Sequence[str] = ("name", "short_name", "city")) -> DataFrame:
    """Pages of one diocese, of those without a parish church, with a folded part of text in name, short name or city, or in fewer columns."""
    out = search.browse(pages, columns, part, equal={"diocese": diocese} if diocese else None)
    return out.where(F.coalesce(F.col("has_parish_church"), F.lit(0)) != 1) if only_gaps else out


def gap_counts(pages: DataFrame) -> DataFrame:
    """(diocese, pages, gaps): persons with pages, and those of them without a parish church."""
    return pages.groupBy("diocese").agg(F.count("*").alias("pages"), F.count_if(F.col("has_parish_church") == 0).alias("gaps"))


def manifest_counts(pages: DataFrame, buildings: DataFrame, dioceses: DataFrame) -> DataFrame:
    """One row of the manifest's counts (names are the published ones)."""
    of_pages = stats.coverage(pages, {"pravne_osobe_sa_stranicom": F.lit(True), "zupe": F.col("route") == "zupa", "ustanove": F.col("route") == "ustanova"})
    of_dioceses = stats.coverage(dioceses, {"biskupije": F.lit(True), "biskupije_s_teritorijem": F.col("has_area") == 1})
    return stats.coverage(buildings, {"crkve": F.lit(True)}).crossJoin(of_pages).crossJoin(of_dioceses)  # one row each


def figures(counts: DataFrame, maps: Mapping[str, tuple[DataFrame, str, int | None]]) -> DataFrame:
    """(document): the figures of one row of counts and of maps from label to count, the k greatest where k is given."""
    out = counts
    for name, (df, column, k) in maps.items():
        out = out.crossJoin(stats.label_map(df, column, k).withColumnRenamed("counts", name))  # one row each
    return out.select(F.to_json(F.struct(*out.columns)).alias("document"))


def in_order(df: DataFrame, export: str) -> DataFrame:
    return df.orderBy(*(F.expr(c.removesuffix(" desc")).desc() if c.endswith(" desc") else c for c in ORDERS[export]))


def ranked_dioceses(dioceses: DataFrame) -> DataFrame:
    """Adds place: dioceses with a territory by its parishes, then the others by theirs, most first; unknown numbers count as none, ties by name."""
    area = F.coalesce(F.col("has_area") == 1, F.lit(False))
    n = F.coalesce(F.when(area, F.col("area_parish_count")).otherwise(F.col("parish_count")), F.lit(0))
    return numbered(dioceses, [area.desc(), n.desc(), "name"])


def _address(df: DataFrame) -> Column:
    street, city = text.empty_to_null(F.col("address")), text.empty_to_null(F.col("city"))
    shown = F.struct(F.lit("PostalAddress").alias("@type"), street.alias("streetAddress"), city.alias("addressLocality"), F.lit("HR").alias("addressCountry"))
    return F.when(street.isNotNull() | city.isNotNull(), shown).alias("address")


def place_markup(df: DataFrame, base: str) -> DataFrame:
    """(slug, document): schema.org markup of buildings (slug, path, name, lat, lng, address, city); fields without a value are left out."""
    at = F.struct(F.lit("GeoCoordinates").alias("@type"), F.col("lat").alias("latitude"), F.col("lng").alias("longitude"))
    doc = F.struct(F.lit("https://schema.org").alias("@context"), F.lit("PlaceOfWorship").alias("@type"), "name", F.concat(F.lit(base.rstrip("/")), F.col("path")).alias("url"), at.alias("geo"), _address(df))
    return df.select("slug", F.to_json(doc).alias("document"))


def person_markup(df: DataFrame, base: str) -> DataFrame:
    """(slug, document): the same of legal persons (slug, path, name, oib, phone, website, address, city, diocese)."""
    oib, filled = text.empty_to_null(F.col("oib")), lambda c: text.empty_to_null(F.col(c))
    above = F.when(filled("diocese").isNotNull(), F.struct(F.lit("Organization").alias("@type"), F.col("diocese").alias("name")))
    doc = F.struct(
        F.lit("https://schema.org").alias("@context"), F.lit("Organization").alias("@type"), "name", F.concat(F.lit(base.rstrip("/")), F.col("path")).alias("url"), F.concat(F.lit("HR"), oib).alias("vatID"), oib.alias("taxID"),
        filled("phone").alias("telephone"), F.when(filled("website").isNotNull(), F.array("website")).alias("sameAs"), above.alias("parentOrganization"), _address(df),
    )
    return df.select("slug", F.to_json(doc).alias("document"))


def clusters(points: DataFrame, zoom: int, radius_px: int = 46, most_zoom: int = 11) -> DataFrame:
    """(cell_x, cell_y, n, lat, lng): points of a map by square cells of radius_px in web-Mercator pixels of 512 a tile, at their mean place.

    Beyond most_zoom nothing is clustered and each spot stays. Cells stand in for circles around a
    first point, which depend on the order of points.
    """
    known = points.where("lat is not null and lng is not null")
    if zoom > most_zoom:
        return known.select(F.lit(None).cast("bigint").alias("cell_x"), F.lit(None).cast("bigint").alias("cell_y"), F.lit(1).cast("bigint").alias("n"), "lat", "lng")
    world, s = 512.0 * 2**zoom, F.sin(F.radians("lat"))
    x = (F.col("lng") / 360 + 0.5) * world
    y = (0.5 - F.log((1 + s) / (1 - s)) / (4 * F.pi())) * world
    cell = lambda v: F.floor(v / radius_px).cast("bigint")
    return known.groupBy(cell(x).alias("cell_x"), cell(y).alias("cell_y")).agg(F.count("*").alias("n"), F.avg("lat").alias("lat"), F.avg("lng").alias("lng"))

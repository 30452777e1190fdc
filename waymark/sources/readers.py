"""Readers of landed extracts: whatever a live source returned is a file in the landing zone, named by its request."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, rules, text

FOREIGN = ("slovenija", "slovenia", "bosna i hercegovina", "bosnia", "bih", "srbija", "serbia", "crna gora", "montenegro", "italija", "italy", "mađarska", "hungary", "austrija", "austria")  # fixed values
SACRAL = ("church", "place_of_worship", "mosque", "synagogue", "hindu_temple", "cemetery")  # fixed values
DEFAULT_NAMES = {"kapela": "Kapela", "poklonac": "Poklonac", "crkva": "Crkva"}  # fixed values
# The register's classes of sacral heritage.
HERITAGE_CLASSES = ("sakralna graditeljska baština", "sakralno-profana graditeljska baština")


def landing_name(request: str, length: int = 24) -> str:
    """File name of a request's answer, so a second run reads instead of asking."""
    return hashlib.sha256(request.encode()).hexdigest()[:length] + ".json"


def elements(spark: SparkSession, path: str) -> DataFrame:
    """Tagged map objects, with their point or their centre."""
    raw = spark.read.schema("elements array<struct<type:string,id:bigint,lat:double,lon:double,center:struct<lat:double,lon:double>,tags:map<string,string>>>").json(path, multiLine=True)
    return raw.select(F.explode("elements").alias("e")).select("e.type", "e.id", F.coalesce("e.lat", "e.center.lat").alias("lat"), F.coalesce("e.lon", "e.center.lon").alias("lng"), "e.tags")


def sacral_elements(df: DataFrame) -> DataFrame:
    """The union of the source's predicates as one filter, so no object comes twice."""
    tag = lambda k: F.try_element_at("tags", F.lit(k))
    return df.where(F.coalesce((tag("amenity") == "place_of_worship"), F.lit(False)) | F.coalesce(tag("building").rlike("^(church|chapel|cathedral|mosque|synagogue|temple|monastery)$"), F.lit(False)) | F.coalesce(tag("amenity") == "monastery", F.lit(False)) | F.coalesce(tag("historic").isin("church", "wayside_shrine"), F.lit(False)))


def buildings(df: DataFrame) -> DataFrame:
    """Building rows of tagged objects: picks by precedence, empty strings skipped."""
    tag = lambda k: text.empty_to_null(F.try_element_at("tags", F.lit(k)))
    kind = rules.kind(F.col("tags"), F.coalesce(tag("name"), tag("official_name"), tag("alt_name")))
    out = df.withColumn("kind", kind)
    city = F.coalesce(tag("addr:city"), tag("addr:place"), tag("addr:suburb"))
    street = text.empty_to_null(F.concat_ws(" ", tag("addr:street"), tag("addr:housenumber")))
    name = F.coalesce(tag("name"), tag("official_name"), tag("alt_name"), F.coalesce(rules.lookup(F.col("kind"), DEFAULT_NAMES), F.lit("Sakralni objekt")))
    return out.select(
        F.concat(F.substring("type", 1, 1), F.col("id").cast("string")).alias("osm_id"), name.alias("name"), "kind", rules.religion(F.col("tags"), F.col("kind")).alias("religion"), tag("denomination").alias("denomination"), rules.dedication(name).alias("dedication"),
        "lat", "lng", city.alias("city"), text.empty_to_null(F.concat_ws(", ", street, city)).alias("address"), tag("addr:postcode").alias("postal_code"), tag("wikidata").alias("wikidata"), text.wikipedia_url(tag("wikipedia")).alias("wikipedia"),
        tag("start_date").alias("year_built"), tag("architect").alias("architect"), tag("building:architecture").alias("style"), F.coalesce(tag("phone"), tag("contact:phone")).alias("phone"), F.coalesce(tag("email"), tag("contact:email")).alias("email"), F.coalesce(tag("website"), tag("contact:website")).alias("website"),
        text.slug(name, city, F.concat(F.substring("type", 1, 1), F.col("id").cast("string"))).alias("slug"), "tags",
    )


def aliases(df: DataFrame, key: str = "osm_id") -> DataFrame:
    """(key, alias, source) of other names in the tags."""
    wanted = ("alt_name", "old_name", "official_name", "name:hr", "name:it")  # fixed values
    picked = F.map_filter("tags", lambda k, v: k.isin(*wanted) & (F.coalesce(v, F.lit("")) != "") & (v != F.col("name")))
    return df.select(key, "name", F.explode(picked).alias("source", "alias")).select(key, "alias", "source").distinct()


def dataset(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a portal dataset (schema as DDL): a file is a list of records, or an object whose first list of records counts.

    A file without any gives no rows.
    """
    row = F.from_json("r", schema)
    records = "array<map<string,string>>"
    raw = spark.read.text(path, wholetext=True).where("trim(value) <> ''").select(F.trim("value").alias("v"))
    listed = F.when(F.startswith("v", F.lit("[")), F.col("v")).otherwise(
        F.get(F.filter(F.map_values(F.from_json("v", "map<string,string>")), lambda x: F.startswith(x, F.lit("[")) & (F.size(F.from_json(x, records)) > 0)), F.lit(0))
    )
    return raw.select(F.explode(F.from_json(listed, "array<string>")).alias("r")).select(row.alias("r")).select("r.*")


def registry(df: DataFrame) -> DataFrame:
    """Legal persons of the Catholic register."""
    seat = text.split_seat(F.col("SJEDISTE"))
    name, oib, sbt = F.trim("NAZIV"), text.empty_to_null(F.trim("OIB")), F.col("SBT_ID").cast("bigint")
    suffix = F.coalesce(F.right(oib, F.lit(4)), sbt.cast("string"))
    return df.where("trim(coalesce(NAZIV, '')) <> ''").select(
        text.slug(name, seat["city"], suffix).alias("slug"), name.alias("name"), text.short_name(name).alias("short_name"), rules.registry_kind(name).alias("kind"), F.lit("christian").alias("religion"), F.lit("roman_catholic").alias("denomination"),
        seat["city"].alias("city"), seat["street"].alias("address"), oib.alias("oib"), sbt.alias("registry_id"), F.col("EVIDENCIJSKI_BROJ").alias("registry_no"), F.col("STATUS").alias("registry_status"), F.substring("DATUM_UPISA", 1, 10).alias("registered_at"), F.col("BISKUPIJA_NADBISKUPIJA").alias("diocese"), F.col("SLUZBA_OSOBE").alias("office"),
    )


def organisations(df: DataFrame) -> DataFrame:
    """Organisational forms of religious communities."""
    seat, name = text.split_seat(F.col("SJEDISTE")), F.trim("NAZIV_ORGANIZACIJSKOG_OBLIKA")
    faith = rules.community_faith(F.col("VJERSKA_ZAJEDNICA"), name)
    oib, sbt = text.empty_to_null(F.trim("OIB_ORGANIZACIJSKOG_OBLIKA")), F.col("SBT_ID").cast("bigint")
    return df.where("trim(coalesce(NAZIV_ORGANIZACIJSKOG_OBLIKA, '')) <> ''").select(text.slug(name, seat["city"], F.coalesce(F.right(oib, F.lit(4)), sbt.cast("string"))).alias("slug"), name.alias("name"), rules.organisation_kind(name).alias("kind"), faith["c0"].alias("religion"), faith["c1"].alias("denomination"), seat["city"].alias("city"), seat["street"].alias("address"), oib.alias("oib"), sbt.alias("registry_id"), F.col("VJERSKA_ZAJEDNICA").alias("community"), F.col("STATUS").alias("registry_status"))


def heritage(df: DataFrame, classes: tuple[str, ...] = HERITAGE_CLASSES) -> DataFrame:
    """Sacral heritage records, white space cleaned; a missing code is made from the id."""
    c = lambda k: text.clean(F.col(k))
    code = F.coalesce(c("Oznaka_dobra"), F.concat(F.lit("ID-"), F.col("id").cast("string")))
    return df.where(F.lower(c("Klasifikacija")).isin(*classes) & c("Naziv").isNotNull()).select(code.alias("heritage_id"), c("Naziv").alias("name"), c("Mjesto_smjestaja").alias("settlement"), c("Opcina_grad").alias("municipality"), c("Zupanija").alias("county"), c("Pravni_status").alias("status"), c("Vrijeme_nastanka").alias("period"), c("Opis_dobra").alias("description"))


def bindings(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a SPARQL answer as maps from variable to value."""
    raw = spark.read.schema("results struct<bindings:array<map<string,struct<value:string>>>>").json(path, multiLine=True)
    return raw.select(F.posexplode("results.bindings").alias("ord", "b")).select("ord", F.transform_values("b", lambda k, v: v["value"]).alias("b"))


def items(df: DataFrame) -> DataFrame:
    """Knowledge-graph items, one a qid, from bindings that repeat them."""
    from ..operators.merge import collapse

    v = lambda k: F.try_element_at("b", F.lit(k))
    point = text.wkt_point(v("coord"))
    flat = df.select("ord", text.last_segment(v("item")).alias("qid"), v("itemLabel").alias("name"), point["lat"].alias("lat"), point["lng"].alias("lng"), text.https(v("image")).alias("image"), v("article").alias("article"), text.year_of(v("inception")).alias("year_built"), v("architectLabel").alias("architect"), v("styleLabel").alias("style"), v("heritage").alias("heritage"), v("osmRel").alias("osm_relation"), v("adminLabel").alias("admin"), v("typeLabel").alias("type"))
    return collapse(flat, ["qid"], "ord", [c for c in flat.columns if c not in ("ord", "qid")])


PLACES = "places array<struct<id:string,displayName:struct<text:string>,formattedAddress:string,location:struct<latitude:double,longitude:double>,types:array<string>,addressComponents:array<struct<types:array<string>,longText:string>>,nationalPhoneNumber:string,internationalPhoneNumber:string,websiteUri:string,googleMapsUri:string,businessStatus:string,primaryType:string,primaryTypeDisplayName:struct<text:string>>>"


def _component(kinds: tuple[str, ...], after: tuple[tuple[str, ...], ...] = ()) -> Column:
    """Text of the last address component of a kind that no kind before it in the precedence claims."""
    own = lambda c: F.arrays_overlap(c["types"], F.array(*map(F.lit, kinds)))
    earlier = tuple(k for ks in after for k in ks)
    free = (lambda c: ~F.arrays_overlap(c["types"], F.array(*map(F.lit, earlier)))) if earlier else (lambda c: F.lit(True))
    return F.try_element_at(F.filter("p.addressComponents", lambda c: own(c) & free(c)), F.lit(-1))["longText"]


def places(spark: SparkSession, path: str) -> DataFrame:
    """Search results inside the country, in their order."""
    p = spark.read.schema(PLACES).json(path, multiLine=True).select(F.posexplode("places").alias("result_no", "p"))
    address = F.coalesce(F.col("p.formattedAddress"), F.lit(""))
    home = geo.in_country(F.col("p.location.latitude"), F.col("p.location.longitude"))
    abroad = F.lower(address).rlike("|".join(FOREIGN))
    locality, county = ("locality", "postal_town"), ("administrative_area_level_1",)
    return p.where(home & ~abroad).select(
        "result_no", F.col("p.id").alias("place_id"), F.col("p.displayName.text").alias("name"), address.alias("address"), _component(locality).alias("city"), _component(county, (locality,)).alias("county"), _component(("postal_code",), (locality, county)).alias("postal_code"),
        F.col("p.location.latitude").alias("lat"), F.col("p.location.longitude").alias("lng"), F.coalesce(text.empty_to_null(F.col("p.nationalPhoneNumber")), F.col("p.internationalPhoneNumber")).alias("phone"), F.col("p.websiteUri").alias("website"),
        F.coalesce(F.arrays_overlap("p.types", F.array(*map(F.lit, SACRAL))), F.lit(False)).alias("is_sacral"), F.coalesce(text.empty_to_null(F.col("p.primaryTypeDisplayName.text")), F.col("p.primaryType")).alias("primary_type"), F.col("p.googleMapsUri").alias("maps_uri"), F.col("p.businessStatus").alias("business_status"),
    )


def features(spark: SparkSession, path: str) -> DataFrame:
    """Boundary polygons of a GeoJSON file in file order; other geometry is dropped, a missing file is an empty layer."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], f"idx bigint, name string, jls string, county string, population bigint, area_km2 double, polygons {geo.POLYGONS}")
    raw = spark.read.schema("features array<struct<geometry:string,properties:struct<name:string,jls_name:string,zupanija:string,stanovnistvo:bigint,area_km2:double>>>").json(path, multiLine=True)
    out = raw.select(F.posexplode("features").alias("idx", "f")).withColumn("polygons", geo.geojson_polygons(F.col("f.geometry")))
    return out.where("size(polygons) > 0").select(F.col("idx").cast("bigint").alias("idx"), F.coalesce("f.properties.name", F.lit("")).alias("name"), F.coalesce("f.properties.jls_name", F.lit("")).alias("jls"), F.coalesce("f.properties.zupanija", F.lit("")).alias("county"), F.coalesce("f.properties.stanovnistvo", F.lit(0)).alias("population"), F.coalesce("f.properties.area_km2", F.lit(0.0)).alias("area_km2"), "polygons")


def answers(spark: SparkSession, folder: str, requests: Sequence[Sequence[str]]) -> DataFrame:
    """(request, used, body): the landed answer of each request, or of the next of its alternatives whose file is there and holds JSON.

    Only the files that the requests name are read, one by one as whole texts; a request without any has nulls.
    """
    asked = [(own[0], k, other, landing_name(other)) for own in requests for k, other in enumerate(own)]
    wanted = spark.createDataFrame(asked, "request string, nth int, used string, file string")
    names = "{" + ",".join(sorted({a[3] for a in asked})) + "}"
    files = spark.read.format("binaryFile").option("pathGlobFilter", names).load(folder).select(F.substring_index("path", "/", -1).alias("file"), F.decode("content", "UTF-8").alias("body"))
    whole = files.where(F.try_parse_json(F.col("body")).isNotNull())
    best = wanted.join(whole, "file").groupBy("request").agg(F.min_by(F.struct("used", "body"), "nth").alias("a"))
    return wanted.select("request").distinct().join(best, "request", "left").select("request", "a.used", "a.body")

"""The tables' schemas by version, and stored tables of several versions read together under the newest.

A table is a folder with one folder a version (version=N). A new version adds columns, widens types or
renames columns; rows of older ones are read with their own schema and brought to the newest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The tables' columns as they are published, a version a line where there are several.
SCHEMAS: dict[str, tuple[str, ...]] = {
    "church_aliases": ("church_id bigint, alias string, source string",),
    "parishes": (
        "id bigint, slug string, name string, short_name string, kind string, religion string, denomination string, titular string, oib string, diocese string, community string, address string, city string, county string, lat double, lng double, geocode_source string, registry_no string, registry_id bigint, registry_status string, registered_at string, leader_title string, phone string, email string, website string, google_place_id string, google_maps_uri string, source string, notes string",
        "id bigint, slug string, name string, short_name string, kind string, religion string, denomination string, titular string, oib string, diocese string, community string, address string, city string, county string, lat double, lng double, geocode_source string, registry_no string, registry_id bigint, registry_status string, registered_at string, leader_title string, phone string, email string, website string, google_place_id string, google_maps_uri string, source string, notes string, duplicate_of bigint",
    ),
    "dioceses": ("id bigint, slug string, name string, kind string, religion string, denomination string, oib string, seat string, parish_count bigint, source string",),
    "heritage_unmatched": ("heritage_id string, name string, settlement string, municipality string, county string, klasifikacija string, status string, period string, description string",),
    "geo_conflicts": ("parish_id bigint, church_id bigint, parish_name string, church_name string, place_name string, place_address string, distance_m double, our_lat double, our_lng double, place_lat double, place_lng double",),
    "diocese_areas": ("diocese_id bigint, name string, geometry string, area_km2 double, population bigint, settlement_count bigint, parish_count bigint, church_count bigint, method string, osm_agreement double",),
}


@dataclass(frozen=True)
class Table:
    """versions: DDL of each, from 1 up; renamed: for a version, new names by old ones of the version before; required and unique: columns."""

    name: str
    versions: Sequence[str]
    renamed: Mapping[int, Mapping[str, str]] = field(default_factory=dict)
    required: Sequence[str] = ()
    unique: Sequence[str] = ()

    def schema(self, version: int = 0) -> T.StructType:
        """The schema of a version; 0 is the newest."""
        return T.StructType.fromDDL(self.versions[version - 1])

    def migrated(self, rows: DataFrame, version: int) -> DataFrame:
        """Rows of a version under the newest: columns in its order and types, new ones null; a column that no version knows is an error."""
        names = {c: c for c in self.schema(version).names}
        for later in range(version + 1, len(self.versions) + 1):
            names = {old: self.renamed.get(later, {}).get(new, new) for old, new in names.items()}
        if unknown := [c for c in rows.columns if c not in names]:
            raise ValueError(f"{self.name} version {version} has no {', '.join(unknown)}")
        now = rows.select(*(F.col(c).alias(names[c]) for c in rows.columns))
        return now.select(*((F.col(f.name) if f.name in now.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema().fields))

    def write(self, rows: DataFrame, root: str, version: int = 0, mode: str = "append") -> None:
        version = version or len(self.versions)
        own = self.schema(version)
        rows.select(*((F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in own.fields)).write.mode(mode).parquet(f"{root}/{self.name}/version={version}")

    def read(self, spark: SparkSession, root: str) -> DataFrame:
        """All stored versions as one table; none stored is an empty one."""
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{self.name}")
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        there = [v for v in range(1, len(self.versions) + 1) if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{self.name}/version={v}"))]
        parts = [self.migrated(spark.read.schema(self.schema(v)).parquet(f"{root}/{self.name}/version={v}"), v) for v in there]
        return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], self.schema())

    def faults(self, rows: DataFrame) -> DataFrame:
        """(fault, column, n): required columns that are null, and values of the unique key that stand more than once."""
        missing = F.array(*(F.struct(F.lit("null").alias("fault"), F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("n")) for c in self.required)) if self.required else F.array()
        out = rows.agg(missing.alias("f")).select(F.explode("f").alias("f")).select("f.*").where("n > 0") if self.required else None
        if self.unique:
            repeats = rows.groupBy(*self.unique).count().where("count > 1").agg(F.count("*").alias("n")).where("n > 0").select(F.lit("repeated").alias("fault"), F.lit(", ".join(self.unique)).alias("column"), "n")
            out = repeats if out is None else out.unionByName(repeats)
        return out


TABLES = {
    "church_aliases": Table("church_aliases", SCHEMAS["church_aliases"], required=("church_id", "alias"), unique=("church_id", "alias", "source")),
    "parishes": Table("parishes", SCHEMAS["parishes"], required=("slug", "name"), unique=("slug",)),
    "dioceses": Table("dioceses", SCHEMAS["dioceses"], required=("slug", "name"), unique=("slug",)),
    "heritage_unmatched": Table("heritage_unmatched", SCHEMAS["heritage_unmatched"], required=("heritage_id", "name"), unique=("heritage_id",)),
    "geo_conflicts": Table("geo_conflicts", SCHEMAS["geo_conflicts"]),
    "diocese_areas": Table("diocese_areas", SCHEMAS["diocese_areas"], required=("name", "geometry"), unique=("diocese_id",)),
}

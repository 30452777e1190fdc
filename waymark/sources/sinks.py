"""Sinks: GeoJSON, CSV with a byte-order mark, route documents, a manifest, a sitemap.

Large outputs are written by Spark. A report that has to be one file streams from the executors
partition by partition, so the driver holds one partition at a time.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text

#: Flags whose zero is left out; a zero count stays (fixed values).
ZERO_FLAGS = ("is_parish_church", "geo_verified", "unesco", "church_verified")


def clean_fields(df: DataFrame, skip: Sequence[str] = ("lat", "lng")) -> list[Column]:
    """Columns with empty strings and zero flags as nulls, which JSON leaves out; source tags as an array."""
    out = []
    for name, kind in df.dtypes:
        if name in skip:
            continue
        c = F.col(name)
        if name == "source" and kind == "string":
            c = F.from_json(c, "array<string>")
        elif kind == "string":
            c = text.empty_to_null(c)
        elif name in ZERO_FLAGS:
            c = F.nullif(c, F.lit(0))
        out.append(c.alias(name))
    return out


def point_features(df: DataFrame) -> DataFrame:
    """(feature): GeoJSON point features, longitude first, six digits."""
    point = F.struct(F.lit("Point").alias("type"), F.array(F.round("lng", 6), F.round("lat", 6)).alias("coordinates"))
    return df.where("lat is not null and lng is not null").select(F.to_json(F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), F.struct(*clean_fields(df)).alias("properties"))).alias("feature"))


def polygon_features(df: DataFrame, rings: str = "rings") -> DataFrame:
    """Features of outlines: a column of polygons, each an outer ring and its holes, or of rings that are polygons each. Rings are closed by their first point."""
    nested = df.schema[rings].dataType.simpleString().count("array") == 4
    closed = lambda r: F.transform(F.concat(r, F.slice(r, 1, 1)), lambda p: F.transform(p, lambda v: F.round(v, 6)))
    shapes = F.transform(rings, lambda p: F.transform(p, closed) if nested else F.array(closed(p)))
    shape = F.struct(F.lit("MultiPolygon").alias("type"), shapes.alias("coordinates"))
    other = [c for c in ("rings", "polygons") if c in df.columns]
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), F.struct(*clean_fields(df, (rings, *other))).alias("properties"))).alias("feature"))


def write_geojson(features: DataFrame, path: str, order: str | None = None) -> int:
    """One FeatureCollection file; nothing is written for no features. Returns their number."""
    rows = features.orderBy(order) if order else features
    n = 0
    out = None
    try:
        for row in rows.toLocalIterator():
            if out is None:
                out = Path(path).open("w", encoding="utf-8")
                out.write('{"type":"FeatureCollection","features":[')
            out.write(("," if n else "") + row.feature)
            n += 1
        if out is not None:
            out.write("]}")
    finally:
        if out is not None:
            out.close()
    return n


def write_bom_csv(df: DataFrame, path: str, names: Mapping[str, str] | None = None) -> int:
    """A single CSV in UTF-8 with a byte-order mark; an empty table gives the mark alone."""
    names = names or {}
    n = 0
    with Path(path).open("w", encoding="utf-8-sig", newline="") as f:
        out = csv.writer(f)
        for row in df.toLocalIterator():
            if not n:
                out.writerow([names.get(c, c) for c in df.columns])
            out.writerow(["" if v is None else v for v in row])
            n += 1
    if not n:
        Path(path).write_bytes(b"\xef\xbb\xbf")
    return n


def csv_rows(df: DataFrame) -> DataFrame:
    """(line): rows as CSV text, quoted where needed; for outputs of many files."""
    return df.select(F.to_csv(F.struct(*df.columns)).alias("line"))


def write_documents(docs: DataFrame, path: str, route: str = "route") -> None:
    """Documents as JSON lines by route; the folder is replaced, so stale documents go."""
    docs.write.mode("overwrite").partitionBy(route).json(path)


def slim_index(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    return df.select(F.to_json(F.struct(*(text.empty_to_null(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.select(*fields).dtypes))).alias("item"))


def manifest(counts: DataFrame, version: int = 1) -> DataFrame:
    """One row: schema version, time in UTC, and the counts given as columns."""
    return counts.select(F.lit(version).alias("schema_version"), F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("generated_at"), *counts.columns)


def check_fresh(stats: DataFrame, table: DataFrame, column: str) -> None:
    """Stops an export whose figures are not those of the table."""
    known, found = stats.select(column).first()[0], table.count()
    if known != found:
        raise ValueError(f"{column} is {known} in the figures, {found} in the table: compute them again")


def sitemap(base: str, pages: Sequence[str], *indexes: tuple[str, DataFrame]) -> DataFrame:
    """(url): fixed pages and one address for each slug of the indexes, escaped."""
    spark = indexes[0][1].sparkSession
    out = spark.createDataFrame([(p,) for p in pages], "path string")
    for route, df in indexes:
        out = out.unionByName(df.select(F.concat(F.lit(f"/{route}/"), F.col("slug")).alias("path")))
    return out.select(text.escape_xml(F.concat(F.lit(base.rstrip("/")), F.col("path"))).alias("url"))

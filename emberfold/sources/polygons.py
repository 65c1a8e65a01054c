"""Polygon layers from GeoJSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberfold.functions.geo import MERCATOR_RADIUS

_FEATURE = "type STRING, properties MAP<STRING, STRING>, geometry STRUCT<type: STRING, coordinates: STRING>"


def read_polygons(
    spark: SparkSession,
    path: str,
    key: str,
    attributes: list[str] | None = None,
    layout: str = "collection",
    mercator: bool = False,
) -> DataFrame:
    """(poly_id, attributes, rings) from GeoJSON.

    ``layout`` is ``collection`` (one FeatureCollection per file) or ``lines`` (one feature per
    line, which large layers should use as it can be split). ``mercator`` says that the stored
    coordinates are Web Mercator. ``key`` names the integer property used as poly_id.
    """
    if layout == "lines":
        features = spark.read.schema(_FEATURE).json(path)
    else:
        collection = f"type STRING, features ARRAY<STRUCT<{_struct_fields()}>>"
        features = (
            spark.read.schema(collection).option("multiLine", "true").json(path)
            .select(F.explode("features").alias("f")).select("f.*")
        )
    polygon = F.from_json("geometry.coordinates", "array<array<array<double>>>")
    many = F.flatten(F.from_json("geometry.coordinates", "array<array<array<array<double>>>>"))
    rings = F.when(F.col("geometry.type") == "MultiPolygon", many).when(
        F.col("geometry.type") == "Polygon", polygon
    )
    return features.filter(rings.isNotNull()).select(
        F.col("properties")[key].cast("int").alias("poly_id"),
        *[F.col("properties")[a].alias(a) for a in attributes or []],
        F.transform(rings, lambda ring: F.transform(ring, lambda p: _corner(p, mercator))).alias("rings"),
    )


def _struct_fields() -> str:
    return "type: STRING, properties: MAP<STRING, STRING>, geometry: STRUCT<type: STRING, coordinates: STRING>"


def _corner(point: Column, mercator: bool) -> Column:
    x, y = F.get(point, F.lit(0)), F.get(point, F.lit(1))
    if mercator:
        x = F.degrees(x / MERCATOR_RADIUS)
        y = F.degrees(2.0 * F.atan(F.exp(y / MERCATOR_RADIUS))) - 90.0
    return F.struct(x.alias("lon"), y.alias("lat"))


def write_polygons(polygons: DataFrame, path: str, key: str = "poly_id") -> None:
    """One GeoJSON feature per line."""
    coordinates = F.transform(
        "rings", lambda ring: F.transform(ring, lambda p: F.array(p["lon"], p["lat"]))
    )
    attributes = [c for c in polygons.columns if c != "rings"]
    polygons.select(
        F.lit("Feature").alias("type"),
        F.struct(*attributes).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), coordinates.alias("coordinates")).alias("geometry"),
    ).write.mode("overwrite").json(path)

"""Multipolygons as data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MULTIPOLYGON = "struct<type:string,coordinates:array<array<array<array<double>>>>>"


def polygon_points(geometries: DataFrame, key: str, geojson: str) -> DataFrame:
    """Ring points of GeoJSON MultiPolygon texts: (key, polygon_id, ring_id, is_hole, seq, lon, lat)."""
    parsed = geometries.select(key, F.from_json(geojson, _MULTIPOLYGON)["coordinates"].alias("polygons"))
    rings = parsed.select(key, F.posexplode("polygons").alias("polygon_id", "rings")).select(
        key, "polygon_id", F.posexplode("rings").alias("ring_id", "points")
    )
    return rings.select(
        key, "polygon_id", "ring_id", (F.col("ring_id") > 0).alias("is_hole"), F.posexplode("points").alias("seq", "p")
    ).select(key, "polygon_id", "ring_id", "is_hole", "seq", F.col("p")[0].alias("lon"), F.col("p")[1].alias("lat"))


def polygon_edges(geometries: DataFrame, key: str, geojson: str) -> DataFrame:
    """Edges of the rings, each point with the one before it and the first with the last; built inside the row, no shuffle."""
    parsed = geometries.select(key, F.from_json(geojson, _MULTIPOLYGON)["coordinates"].alias("polygons"))
    rings = parsed.select(key, F.posexplode("polygons").alias("polygon_id", "rings")).select(
        key, "polygon_id", F.posexplode("rings").alias("ring_id", "points")
    )
    edges = F.transform(
        "points",
        lambda point, i: F.struct(
            F.when(i > 0, F.get("points", i - 1)).otherwise(F.element_at("points", -1)).alias("a"), point.alias("b")
        ),
    )
    return rings.select(
        key, "polygon_id", "ring_id", (F.col("ring_id") > 0).alias("is_hole"), F.posexplode(edges).alias("seq", "e")
    ).select(
        key,
        "polygon_id",
        "ring_id",
        "is_hole",
        "seq",
        F.col("e.a")[0].alias("x1"),
        F.col("e.a")[1].alias("y1"),
        F.col("e.b")[0].alias("x2"),
        F.col("e.b")[1].alias("y2"),
    )

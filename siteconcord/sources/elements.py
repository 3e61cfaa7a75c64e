"""Map extracts: scans, extraction by tag and area, and the point layer's selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siteconcord.functions.geo import boundary_box, in_box, in_polygons
from siteconcord.functions.tags import has_key, tag
from siteconcord.functions.text import literal
from siteconcord.params import MatchParams

_POINT = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])
_MEMBER = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("ref", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("geometry", T.ArrayType(_POINT)),
    ]
)
_BOX = T.StructType([T.StructField(n, T.DoubleType()) for n in ("minlat", "minlon", "maxlat", "maxlon")])

ELEMENT_SCHEMA = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("id", T.LongType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("center", _POINT),
        T.StructField("version", T.IntegerType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("user", T.StringType()),
        T.StructField("changeset", T.LongType()),
        T.StructField("uid", T.LongType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("nodes", T.ArrayType(T.LongType())),
        T.StructField("members", T.ArrayType(_MEMBER)),
        T.StructField("bounds", _BOX),
        T.StructField("geometry", T.ArrayType(_POINT)),
    ]
)
DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("version", T.DoubleType()),
        T.StructField("generator", T.StringType()),
        T.StructField(
            "osm3s",
            T.StructType(
                [
                    T.StructField("timestamp_osm_base", T.StringType()),
                    T.StructField("timestamp_areas_base", T.StringType()),
                    T.StructField("copyright", T.StringType()),
                ]
            ),
        ),
        T.StructField("elements", T.ArrayType(ELEMENT_SCHEMA)),
    ]
)
_JSON_OPTIONS = {"allowNonNumericNumbers": "false"}


def element_document(spark: SparkSession, path: str) -> DataFrame:
    """Elements of extract documents `{"elements": [...], "osm3s": {...}}` in their order, with the base timestamp."""
    documents = spark.read.schema(DOCUMENT_SCHEMA).options(multiLine=True, **_JSON_OPTIONS).json(path)
    return documents.select(
        F.col("osm3s.timestamp_osm_base").alias("base_timestamp"), F.posexplode("elements").alias("pos", "element")
    ).select(F.col("pos").cast("long").alias("elem_ord"), "base_timestamp", "element.*")


def element_scan(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Elements of a splittable extract: parquet, or JSON lines with an `elem_ord` field each."""
    if fmt == "json":
        schema = T.StructType([T.StructField("elem_ord", T.LongType()), *ELEMENT_SCHEMA.fields])
        return spark.read.schema(schema).options(**_JSON_OPTIONS).json(path)
    return spark.read.format(fmt).load(path)


def extract_elements(osm: DataFrame, p: MatchParams) -> DataFrame:
    """Elements with the tag inside the outer rings of the boundary, each once.

    The box on lat / lon reaches the parquet scan. Ways and relations are placed by their centre.
    """
    polygons = [rings[:1] for rings in p.boundary if rings and len(rings[0]) > 2]
    near = f"({in_box('lat', 'lon', boundary_box(polygons))} OR lat IS NULL)"
    tagged = osm.filter(f"{near} AND {tag('tags', p.tag_key)} = {literal(p.tag_value)}")
    return tagged.filter(in_polygons("coalesce(lat, center.lat)", "coalesce(lon, center.lon)", polygons))


def map_layer_scan(osm: DataFrame, p: MatchParams) -> DataFrame:
    """Elements of any kind and place with the tag and the reference key, whatever its value."""
    return osm.filter(f"{tag('tags', p.tag_key)} = {literal(p.tag_value)} AND {has_key('tags', p.ref_key)}")

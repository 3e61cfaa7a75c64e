"""Registry snapshots: scans and searches over assets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siteconcord.functions.geo import box_around, haversine_m, in_box, number
from siteconcord.functions.hours import REGISTRY_DAYS
from siteconcord.operators.skew import hot_keys, skew_join

# Field names of the registry's public data format.
_TEXT_FIELDS = (
    "ASSET_GUID SERIAL_NUMBER ASSET_TYPE_NAME MANUFACTURER_NAME PURCHASE_DATE BATTERY_EXPIRY_DATE "
    "ELECTRODE_EXPIRY_DATE CHILD_ELECTRODE_EXPIRY_DATE BATTERY_OK CHILD_MODE ACTIVE ASSET_STATUS "
    "ACTIVE_DATE_LIMITED ACTIVE_FROM_DATE ACTIVE_TO_DATE OPENING_HOURS_TEXT OPENING_HOURS_CLOSED_HOLIDAYS "
    "OPENING_HOURS_LIMITED SITE_NAME SITE_ADDRESS SITE_POST_CODE SITE_POST_AREA SITE_DESCRIPTION "
    "SITE_ACCESS_INFO CREATED_DATE MODIFIED_DATE IS_OPEN IS_OPEN_DATE DELETED_SINCE ACTIVE_MODIFIED_DATE IS_MOBILE"
).split()
_LONG_FIELDS = ("ASSET_ID", "ASSET_TYPE_ID", "OWNER_USER_ID")
_DOUBLE_FIELDS = (
    "SITE_LATITUDE",
    "SITE_LONGITUDE",
    "SITE_FLOOR_NUMBER",
    *(f"OPENING_HOURS_{day}_{end}" for day in REGISTRY_DAYS for end in ("FROM", "TO")),
)

ASSET_SCHEMA = T.StructType(
    [T.StructField(n, T.LongType()) for n in _LONG_FIELDS]
    + [T.StructField(n, T.DoubleType()) for n in _DOUBLE_FIELDS]
    + [T.StructField(n, T.StringType()) for n in _TEXT_FIELDS]
)
DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("API_MESSAGE", T.StringType()),
        T.StructField("API_CURRENT_USER_ID", T.LongType()),
        T.StructField("ASSETS", T.ArrayType(ASSET_SCHEMA)),
    ]
)
_JSON_OPTIONS = {"allowNonNumericNumbers": "false"}


def registry_document(spark: SparkSession, path: str) -> DataFrame:
    """Assets of snapshot documents `{"ASSETS": [...]}` in their order. One document is one task: use it for responses, not archives."""
    documents = spark.read.schema(DOCUMENT_SCHEMA).options(multiLine=True, **_JSON_OPTIONS).json(path)
    return documents.select(F.posexplode("ASSETS").alias("pos", "asset")).select(
        F.col("pos").cast("long").alias("asset_ord"), "asset.*"
    )


def registry_scan(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Assets of a splittable snapshot: parquet, or JSON lines with an `asset_ord` field each."""
    if fmt == "json":
        schema = T.StructType([T.StructField("asset_ord", T.LongType()), *ASSET_SCHEMA.fields])
        return spark.read.schema(schema).options(**_JSON_OPTIONS).json(path)
    return spark.read.format(fmt).load(path)


def registry_search(
    assets: DataFrame,
    *,
    updated_since: str | None = None,
    lat: float | None = None,
    lon: float | None = None,
    distance_m: float | None = None,
    from_row: int | None = None,
    to_row: int | None = None,
    max_rows: int | None = None,
    date: str | None = None,
) -> DataFrame:
    """Assets by change date, distance from a point, active date and row range (by snapshot order, both ends included)."""
    found = assets
    if updated_since is not None:
        found = found.filter(F.col("MODIFIED_DATE") >= updated_since)
    if lat is not None and lon is not None and distance_m is not None:
        at = ("SITE_LATITUDE", "SITE_LONGITUDE")
        # The box reaches the parquet scan; the exact distance is only computed inside it.
        found = found.filter(in_box(*at, box_around(lat, lon, distance_m))).filter(
            f"{haversine_m(number(lat), number(lon), *at)} <= {number(distance_m)}"
        )
    if date is not None:
        found = found.filter(active_on(date))
    if from_row is not None:
        found = found.filter(F.col("asset_ord") >= from_row)
    if to_row is not None:
        found = found.filter(F.col("asset_ord") <= to_row)
    if max_rows is not None:
        found = found.orderBy("asset_ord").limit(max_rows)
    return found


def active_on(date: str) -> Column:
    """The asset is unlimited in time, or the day lies in its active range; open ends are unlimited."""
    limited = F.coalesce(F.col("ACTIVE_DATE_LIMITED") == "Y", F.lit(False))
    begun = F.coalesce(F.col("ACTIVE_FROM_DATE") <= date, F.lit(True))
    going = F.coalesce(F.col("ACTIVE_TO_DATE") >= date, F.lit(True))
    return ~limited | (begun & going)


def registry_deleted(assets: DataFrame, since: str) -> DataFrame:
    return assets.filter(F.col("DELETED_SINCE") >= since)


def registry_inactive(assets: DataFrame, since: str) -> DataFrame:
    return assets.filter((F.col("ACTIVE") == "N") & (F.col("ACTIVE_MODIFIED_DATE") >= since))


def registry_removed_between(before: DataFrame, after: DataFrame) -> DataFrame:
    """Assets of the earlier snapshot whose key the later one lacks."""
    return skew_join(before, after, "ASSET_GUID", "left_anti", hot_keys(before, "ASSET_GUID"))


def registry_by_owner(assets: DataFrame, owner: int) -> DataFrame:
    return assets.filter(F.col("OWNER_USER_ID") == owner)


def registry_by_guid(assets: DataFrame, guid: str) -> DataFrame:
    wanted = guid.strip()
    if not wanted:
        raise ValueError("The GUID must not be empty.")
    return assets.filter(F.col("ASSET_GUID") == wanted)

"""The registry, map extract and run log derived from the test tables, as SQL both engines run unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siteconcord.functions.tags import tags_from
from siteconcord.params import REF_KEY, TAG_KEY, TAG_VALUE
from siteconcord.session import spread

_POS = "CAST(floor(c_custkey/3.0) AS BIGINT)"
_MON_FROM = "CASE WHEN c_custkey % 12 = 9 THEN NULL ELSE 600 + (c_custkey % 4)*100 END"
_MON_TO = "CASE WHEN c_custkey % 12 = 9 THEN NULL ELSE 1500 + (c_custkey % 5)*100 END"
_WED_FROM = "CASE WHEN c_custkey % 12 = 9 OR c_custkey % 10 = 4 THEN NULL ELSE 600 + (c_custkey % 4)*100 END"
_WED_TO = "CASE WHEN c_custkey % 12 = 9 OR c_custkey % 10 = 4 THEN NULL ELSE 1500 + (c_custkey % 5)*100 END"


def _day_of_year(number: str) -> str:
    return f"'2024-' || lpad(CAST(1 + {number} % 12 AS VARCHAR(20)),2,'0') || '-' || lpad(CAST(1 + {number} % 28 AS VARCHAR(20)),2,'0')"


ASSETS_SQL = f"""
SELECT c_custkey AS asset_ord, c_custkey AS ASSET_ID,
 CASE WHEN c_custkey % 97 = 13 THEN NULL ELSE 'G' || lpad(CAST(c_custkey AS VARCHAR(20)),8,'0') END AS ASSET_GUID,
 CASE WHEN c_custkey % 89 = 5 THEN NULL ELSE CAST(59000000 + ({_POS}*7919 % 3000)*1000 + (c_custkey % 3)*600 AS DOUBLE) / 1e6 END AS SITE_LATITUDE,
 CAST(6000000 + ({_POS}*104729 % 5000)*1000 + CASE WHEN c_custkey % 41 = 7 THEN 30000000 ELSE 0 END AS DOUBLE) / 1e6 AS SITE_LONGITUDE,
 CASE WHEN c_custkey % 83 = 11 THEN '' ELSE c_name END AS SITE_NAME,
 CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST((c_custkey % 7) - 2 AS DOUBLE) END AS SITE_FLOOR_NUMBER,
 CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Ved  inngang' || chr(10) || 'til venstre .' WHEN 2 THEN 'Ring 12 34 56 78 eller +47 98 76 54 32' WHEN 3 THEN 'Kontakt post@example.no. eller drift@example.no' ELSE 'Rotaid ved GRØNT varme skap, tlf 987 65 432' END AS SITE_DESCRIPTION,
 {_MON_FROM} AS OPENING_HOURS_MON_FROM, {_MON_TO} AS OPENING_HOURS_MON_TO,
 CASE WHEN c_custkey % 17 = 6 THEN 1275 WHEN c_custkey % 12 = 9 THEN NULL ELSE 600 + (c_custkey % 4)*100 END AS OPENING_HOURS_TUE_FROM, {_MON_TO} AS OPENING_HOURS_TUE_TO,
 {_WED_FROM} AS OPENING_HOURS_WED_FROM, {_WED_TO} AS OPENING_HOURS_WED_TO,
 {_MON_FROM} AS OPENING_HOURS_THU_FROM, {_MON_TO} AS OPENING_HOURS_THU_TO,
 {_MON_FROM} AS OPENING_HOURS_FRI_FROM, {_MON_TO} AS OPENING_HOURS_FRI_TO,
 CASE WHEN c_custkey % 3 <> 0 THEN 1000 END AS OPENING_HOURS_SAT_FROM, CASE WHEN c_custkey % 3 <> 0 THEN 1400 END AS OPENING_HOURS_SAT_TO,
 CASE WHEN c_custkey % 7 = 0 THEN 0 END AS OPENING_HOURS_SUN_FROM, CASE WHEN c_custkey % 7 = 0 THEN 2400 END AS OPENING_HOURS_SUN_TO,
 CASE c_custkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END AS OPENING_HOURS_CLOSED_HOLIDAYS,
 {_day_of_year('c_custkey')} AS MODIFIED_DATE,
 CASE WHEN c_custkey % 6 = 1 THEN 'Y' WHEN c_custkey % 6 = 2 THEN 'N' END AS ACTIVE_DATE_LIMITED,
 CASE WHEN c_custkey % 4 <> 3 THEN {_day_of_year('c_custkey')} END AS ACTIVE_FROM_DATE,
 CASE WHEN c_custkey % 9 <> 3 THEN {_day_of_year('(c_custkey * 7)')} END AS ACTIVE_TO_DATE,
 CASE WHEN c_custkey % 8 = 3 THEN 'N' ELSE 'Y' END AS ACTIVE,
 CASE WHEN c_custkey % 8 = 3 THEN {_day_of_year('(c_custkey * 5)')} END AS ACTIVE_MODIFIED_DATE,
 CASE WHEN c_custkey % 10 = 7 THEN {_day_of_year('(c_custkey * 3)')} END AS DELETED_SINCE,
 CAST(c_nationkey AS BIGINT) AS OWNER_USER_ID
FROM customer
"""

ELEMENTS_SQL = """
WITH b AS (
SELECT c_custkey AS k, 59000000 + (CAST(floor(c_custkey/3.0) AS BIGINT)*7919 % 3000)*1000 + (c_custkey % 3)*600 AS blat,
 6000000 + (CAST(floor(c_custkey/3.0) AS BIGINT)*104729 % 5000)*1000 AS blon, 'G' || lpad(CAST(c_custkey AS VARCHAR(20)),8,'0') AS guid, c_name FROM customer), e AS (
 SELECT 1000000 + k*10 AS id, blat + ((k*37 % 41)-20)*100 AS lat, blon AS lon, CASE WHEN k % 4 IN (0,1) THEN CASE WHEN k % 29 = 1 THEN ' ' || guid || ' ' ELSE guid END WHEN k % 31 = 2 THEN '  ' ELSE NULL END AS ref, c_name FROM b WHERE k % 4 <> 3
 UNION ALL SELECT 1000001 + k*10, blat + 400, blon, guid, c_name FROM b WHERE k % 28 = 0
 UNION ALL SELECT 1000002 + k*10, blat - 10000, blon, 'STALE' || CAST(k AS VARCHAR(20)), c_name FROM b WHERE k % 19 = 0
 UNION ALL SELECT 1000003 + k*10, blat - 11000, blon, 'STALE' || CAST(k AS VARCHAR(20)), c_name FROM b WHERE k % 57 = 0
 UNION ALL SELECT 1000004 + k*10, blat + 200, blon + 800, CAST(NULL AS VARCHAR(20)), c_name FROM b WHERE k % 3 = 1)
SELECT id AS elem_ord, id, CASE WHEN id % 31 = 0 THEN 'way' ELSE 'node' END AS type,
 CASE WHEN id % 31 = 0 THEN NULL ELSE CAST(lat AS DOUBLE) / 1e6 END AS lat, CASE WHEN id % 31 = 0 THEN NULL ELSE CAST(lon AS DOUBLE) / 1e6 END AS lon,
 CASE WHEN id % 31 = 0 AND id % 2 = 0 THEN CAST(lat AS DOUBLE) / 1e6 END AS center_lat, CASE WHEN id % 31 = 0 AND id % 2 = 0 THEN CAST(lon AS DOUBLE) / 1e6 END AS center_lon,
 CAST(1 + id % 9 AS INTEGER) AS version, ref, CASE WHEN id % 3 = 0 THEN c_name END AS name,
 CASE WHEN id % 17 = 0 THEN 'do not touch' END AS note, CASE WHEN id % 23 = 0 THEN '' WHEN id % 47 = 0 THEN 'check' END AS fixme,
 CASE WHEN id % 13 = 0 THEN 'pharmacy' END AS amenity, CASE WHEN id % 11 = 0 THEN 'Mo-Fr 08:00-16:00; PH off' END AS opening_hours
FROM e
"""

# `{ts}` is the engine's keyword for a timestamp without a zone.
RUNS_SQL = """
WITH r AS (
 SELECT o_orderkey AS k, 'run-' || CAST(o_orderkey AS VARCHAR(20)) AS id,
  CASE WHEN o_orderkey < 150 THEN {ts} '2024-01-01 00:00:00' + INTERVAL '1' HOUR * CAST(o_orderkey AS INTEGER) ELSE o_orderdate END AS started_at,
  CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failed' ELSE 'running' END AS status,
  CASE WHEN o_orderkey % 2 = 0 THEN 'dry-run' ELSE 'live' END AS mode FROM orders)
SELECT id, started_at, CASE WHEN status <> 'running' THEN started_at + INTERVAL '1' SECOND * CAST(k * 13 % 9000 AS INTEGER) END AS finished_at,
 status, mode, CASE WHEN status = 'failed' THEN 'boom ' || CAST(k % 5 AS VARCHAR(20)) END AS error_message,
 CAST(1000 + k % 50 AS INTEGER) AS registry_aeds_count, CAST(900 + k % 70 AS INTEGER) AS osm_aeds_count, CAST(800 + k % 30 AS INTEGER) AS linked_aeds_count,
 CAST(k % 11 AS INTEGER) AS updated_count, CAST(k % 7 AS INTEGER) AS created_count, CAST(k % 3 AS INTEGER) AS deleted_count FROM r
"""

ISSUES_SQL = """
SELECT 'issue-' || CAST(event_id AS VARCHAR(20)) AS id, 'run-' || CAST(user_id AS VARCHAR(20)) AS run_id,
 CASE event_id % 6 WHEN 0 THEN 'register_aed_outside_norway' WHEN 1 THEN 'register_missing_required_data' WHEN 2 THEN 'osm_not_a_node' WHEN 3 THEN 'osm_node_note_opt_out' WHEN 4 THEN 'managed_node_location_within_tolerance' ELSE 'skipped_delete_not_aed_only' END AS issue_type,
 CASE WHEN event_id % 6 = 2 THEN 'error' ELSE 'warning' END AS severity, event_type || ' ' || CAST(event_id AS VARCHAR(20)) AS message,
 CASE WHEN event_id % 6 IN (0,4,5) THEN 'G' || lpad(CAST(event_id AS VARCHAR(20)),8,'0') END AS register_ref,
 CASE WHEN event_id % 6 >= 2 THEN 1000000 + event_id END AS osm_node_id,
 CASE WHEN event_id % 6 <> 2 THEN '{}' WHEN event_id % 4 = 0 THEN '{"osmElementType":"way"}' WHEN event_id % 10 = 0 THEN '{"osmElementType":"relation"}' ELSE '{"osmElementType":"area"}' END AS details, ts AS created_at FROM events
"""

NOW = "2024-01-07 06:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _derive(spark: SparkSession, sf_dir: str, name: str, sql: str, spread_out: bool = False) -> DataFrame:
    view = f"siteconcord_{name}"
    rows = table(spark, sf_dir, name)
    (spread(rows) if spread_out else rows).createOrReplaceTempView(view)
    return spark.sql(sql.replace(f"FROM {name}", f"FROM {view}"))


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, "customer", ASSETS_SQL, spread_out=True)


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = _derive(spark, sf_dir, "customer", ELEMENTS_SQL, spread_out=True)
    tags = tags_from(
        [
            (TAG_KEY, f"'{TAG_VALUE}'"),
            (REF_KEY, "ref"),
            *((key, key) for key in ("name", "note", "fixme", "amenity", "opening_hours")),
        ]
    )
    center = "CASE WHEN center_lat IS NOT NULL THEN named_struct('lat', center_lat, 'lon', center_lon) END AS center"
    return flat.selectExpr("elem_ord", "type", "id", "lat", "lon", center, "version", f"{tags} AS tags")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, "orders", RUNS_SQL.replace("{ts}", "TIMESTAMP_NTZ"))


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, "events", ISSUES_SQL)

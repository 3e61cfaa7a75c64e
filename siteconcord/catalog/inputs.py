"""Scans, searches, validation, sinks."""

from __future__ import annotations

from siteconcord.catalog.book import ELEMENT_TAGS, PARAMS, RUNS, Inputs, ctes, number_sql, query
from siteconcord.catalog.fixtures import ISSUES_SQL
from siteconcord.functions import geo, tags
from siteconcord.operators import validate
from siteconcord.session import new_folder
from siteconcord.sources import elements as element_source
from siteconcord.sources import registry as registry_source
from siteconcord.sources import runlog as runlog_source
from siteconcord.sources.polygons import polygon_edges, polygon_points

_ASSET = "asset_ord, ASSET_GUID, SITE_LATITUDE, SITE_LONGITUDE, SITE_NAME, OPENING_HOURS_MON_FROM"
_ASSET_COLUMNS = [c.strip() for c in _ASSET.split(",")]
_TAGS_TEXT = f"{tags.tags_text('tags')} AS tags_text"


@query(
    "registry_scan",
    f"{ctes('assets')} SELECT {_ASSET.replace('OPENING_HOURS_MON_FROM', 'CAST(OPENING_HOURS_MON_FROM AS DOUBLE) AS OPENING_HOURS_MON_FROM')} FROM assets",
)
def registry_scan(spark, sf):
    folder = new_folder(spark, "registry-snapshot")
    Inputs(spark, sf).assets.write.json(folder)
    return registry_source.registry_scan(spark, folder, "json").select(*_ASSET_COLUMNS)


@query(
    "element_scan",
    f"{ctes('elements')} SELECT elem_ord, id, type, lat, lon, center_lat, version, {ELEMENT_TAGS} AS tags_text FROM elements",
)
def element_scan(spark, sf):
    folder = new_folder(spark, "element-snapshot")
    Inputs(spark, sf).elements.write.json(folder)
    scanned = element_source.element_scan(spark, folder, "json")
    return scanned.selectExpr("elem_ord", "id", "type", "lat", "lon", "center.lat AS center_lat", "version", _TAGS_TEXT)


_LAT, _LON = "coalesce(lat, center_lat)", "coalesce(lon, center_lon)"


@query(
    "extract_elements",
    f"{ctes('elements')} SELECT id, type FROM elements WHERE {_LAT} BETWEEN 58 AND 63 AND {_LON} BETWEEN 5 AND 12",
)
def extract_elements(spark, sf):
    return element_source.extract_elements(Inputs(spark, sf).elements, PARAMS).select("id", "type")


@query("map_layer_scan", f"{ctes('elements')} SELECT id, type, ref FROM elements WHERE ref IS NOT NULL")
def map_layer_scan(spark, sf):
    found = element_source.map_layer_scan(Inputs(spark, sf).elements, PARAMS)
    return found.selectExpr("id", "type", f"{tags.tag('tags', PARAMS.ref_key)} AS ref")


_FROM_POINT = "2 * 6371000.0 * asin(sqrt(power(sin(radians(SITE_LATITUDE - 60.5) / 2), 2) + power(sin(radians(SITE_LONGITUDE - 8.5) / 2), 2) * cos(radians(60.5)) * cos(radians(SITE_LATITUDE))))"


@query(
    "registry_search",
    f"""{ctes('assets')} SELECT asset_ord, ASSET_GUID, MODIFIED_DATE FROM assets
    WHERE MODIFIED_DATE >= '2024-03-01' AND {_FROM_POINT} <= 90000
    AND (coalesce(ACTIVE_DATE_LIMITED, 'N') <> 'Y' OR (coalesce(ACTIVE_FROM_DATE, '0') <= '2024-06-15' AND coalesce(ACTIVE_TO_DATE, '9') >= '2024-06-15'))
    AND asset_ord BETWEEN 5 AND 1000000000 ORDER BY asset_ord LIMIT 50""",
)
def registry_search(spark, sf):
    found = registry_source.registry_search(
        Inputs(spark, sf).assets,
        updated_since="2024-03-01",
        lat=60.5,
        lon=8.5,
        distance_m=90_000,
        date="2024-06-15",
        from_row=5,
        to_row=1_000_000_000,
        max_rows=50,
    )
    return found.select("asset_ord", "ASSET_GUID", "MODIFIED_DATE")


@query("registry_deleted", f"{ctes('assets')} SELECT asset_ord, ASSET_GUID, DELETED_SINCE FROM assets WHERE DELETED_SINCE >= '2024-05-01'")
def registry_deleted(spark, sf):
    return registry_source.registry_deleted(Inputs(spark, sf).assets, "2024-05-01").select("asset_ord", "ASSET_GUID", "DELETED_SINCE")


@query(
    "registry_inactive",
    f"{ctes('assets')} SELECT asset_ord, ASSET_GUID, ACTIVE_MODIFIED_DATE FROM assets WHERE ACTIVE = 'N' AND ACTIVE_MODIFIED_DATE >= '2024-05-01'",
)
def registry_inactive(spark, sf):
    found = registry_source.registry_inactive(Inputs(spark, sf).assets, "2024-05-01")
    return found.select("asset_ord", "ASSET_GUID", "ACTIVE_MODIFIED_DATE")


@query(
    "registry_removed_between",
    f"{ctes('assets')} SELECT asset_ord, ASSET_GUID FROM assets WHERE ASSET_GUID IS NULL OR ASSET_GUID NOT IN (SELECT ASSET_GUID FROM assets WHERE DELETED_SINCE IS NULL AND ASSET_GUID IS NOT NULL)",
)
def registry_removed_between(spark, sf):
    before = Inputs(spark, sf).assets
    after = before.filter("DELETED_SINCE IS NULL")
    return registry_source.registry_removed_between(before, after).select("asset_ord", "ASSET_GUID")


@query("registry_by_owner", f"{ctes('assets')} SELECT asset_ord, ASSET_GUID, OWNER_USER_ID FROM assets WHERE OWNER_USER_ID = 7")
def registry_by_owner(spark, sf):
    return registry_source.registry_by_owner(Inputs(spark, sf).assets, 7).select("asset_ord", "ASSET_GUID", "OWNER_USER_ID")


@query("registry_by_guid", f"{ctes('assets')} SELECT {_ASSET} FROM assets WHERE ASSET_GUID = 'G00000042'")
def registry_by_guid(spark, sf):
    return registry_source.registry_by_guid(Inputs(spark, sf).assets, "  G00000042 ").select(*_ASSET_COLUMNS)


# A square around every asset, with a square hole, as GeoJSON text in whole micro-degrees.
_SQUARE = [(-400, -400), (400, -400), (400, 400), (-400, 400), (-400, -400)]
_HOLE = [(-100, -100), (-100, 100), (100, 100), (100, -100), (-100, -100)]


def _areas(i: Inputs):
    placed = i.assets.filter("SITE_LATITUDE IS NOT NULL").selectExpr(
        "asset_ord", "bigint(round(SITE_LONGITUDE * 1e6)) AS x", "bigint(round(SITE_LATITUDE * 1e6)) AS y"
    )

    def ring(points):
        return "concat('[', " + ", ',', ".join(f"concat('[', x + {dx}, ',', y + {dy}, ']')" for dx, dy in points) + ", ']')"

    text = f"concat('{{\"type\":\"MultiPolygon\",\"coordinates\":[[', {ring(_SQUARE)}, ',', {ring(_HOLE)}, ']]}}')"
    return placed.selectExpr("asset_ord", f"{text} AS geojson")


_RINGS = ", ".join(
    f"({ring}, {seq}, {dx}, {dy})" for ring, points in enumerate((_SQUARE, _HOLE)) for seq, (dx, dy) in enumerate(points)
)
_CENTRES = "SELECT asset_ord, CAST(round(SITE_LONGITUDE * 1e6) AS BIGINT) AS x, CAST(round(SITE_LATITUDE * 1e6) AS BIGINT) AS y FROM assets WHERE SITE_LATITUDE IS NOT NULL"


@query(
    "polygon_table",
    f"""{ctes('assets')}, c AS ({_CENTRES}), p(ring_id, seq, dx, dy) AS (VALUES {_RINGS})
    SELECT asset_ord, 0 AS polygon_id, ring_id, ring_id > 0 AS is_hole, seq, CAST(x + dx AS DOUBLE) AS lon, CAST(y + dy AS DOUBLE) AS lat FROM c, p""",
)
def polygon_table(spark, sf):
    return polygon_points(_areas(Inputs(spark, sf)), "asset_ord", "geojson")


@query(
    "polygon_edges",
    f"""{ctes('assets')}, c AS ({_CENTRES}), p(ring_id, seq, dx, dy) AS (VALUES {_RINGS})
    SELECT asset_ord, b.ring_id, b.seq, CAST(x + a.dx AS DOUBLE) AS x1, CAST(y + a.dy AS DOUBLE) AS y1, CAST(x + b.dx AS DOUBLE) AS x2, CAST(y + b.dy AS DOUBLE) AS y2
    FROM c, p a, p b WHERE a.ring_id = b.ring_id AND a.seq = (b.seq + 4) % 5""",
)
def polygon_edges_of_assets(spark, sf):
    edges = polygon_edges(_areas(Inputs(spark, sf)), "asset_ord", "geojson")
    return edges.select("asset_ord", "ring_id", "seq", "x1", "y1", "x2", "y2")


@query("runs_scan", f"WITH runs AS ({RUNS}) SELECT id, started_at, status, created_count FROM runs")
def runs_scan(spark, sf):
    folder = new_folder(spark, "runs")
    Inputs(spark, sf).runs.write.parquet(folder)
    return runlog_source.runs_scan(spark, folder).select("id", "started_at", "status", "created_count")


@query("issues_scan", f"WITH issues AS ({ISSUES_SQL}) SELECT id, run_id, issue_type, details FROM issues")
def issues_scan(spark, sf):
    folder = new_folder(spark, "issues")
    Inputs(spark, sf).issues.write.parquet(folder)
    return runlog_source.issues_scan(spark, folder).select("id", "run_id", "issue_type", "details")


# --- validation ------------------------------------------------------------------------------------------------------

_POINTS = ", ".join(
    f"({pi}, {i}, {x1!r}, {y1!r}, {x2!r}, {y2!r})"
    for pi, rings in enumerate(PARAMS.boundary)
    for i, ((x1, y1), (x2, y2)) in enumerate((rings[0][j - 1], rings[0][j]) for j in range(len(rings[0])))
)
_INSIDE = f"""edges(poly, i, x1, y1, x2, y2) AS (SELECT CAST(poly AS INTEGER), i, CAST(x1 AS DOUBLE), CAST(y1 AS DOUBLE), CAST(x2 AS DOUBLE), CAST(y2 AS DOUBLE)
  FROM (VALUES {_POINTS}) v(poly, i, x1, y1, x2, y2)),
hits AS (SELECT asset_ord, poly,
  bool_or(abs((SITE_LATITUDE - y1) * (x2 - x1) - (SITE_LONGITUDE - x1) * (y2 - y1)) <= 1e-10
    AND (SITE_LONGITUDE - x1) * (SITE_LONGITUDE - x2) + (SITE_LATITUDE - y1) * (SITE_LATITUDE - y2) <= 1e-10) AS touched,
  sum(CASE WHEN (y1 > SITE_LATITUDE) <> (y2 > SITE_LATITUDE) AND SITE_LONGITUDE < (x2 - x1) * (SITE_LATITUDE - y1) / (y2 - y1 + 1e-10) + x1 THEN 1 ELSE 0 END) % 2 = 1 AS odd
  FROM assets, edges WHERE SITE_LATITUDE IS NOT NULL GROUP BY asset_ord, poly),
inside AS (SELECT asset_ord, bool_or(touched OR odd) AS inside FROM hits GROUP BY asset_ord)"""


@query(
    "in_polygon",
    f"{ctes('assets')}, {_INSIDE} SELECT a.asset_ord, coalesce(inside, false) AS inside FROM assets a LEFT JOIN inside USING (asset_ord)",
)
def in_polygon(spark, sf):
    inside = geo.in_polygons("SITE_LATITUDE", "SITE_LONGITUDE", PARAMS.boundary)
    return Inputs(spark, sf).assets.selectExpr("asset_ord", f"{inside} AS inside")


@query(
    "validate_registry",
    f"""{ctes('assets')}, {_INSIDE},
    f AS (SELECT a.*, CASE WHEN ASSET_GUID IS NULL THEN 1 WHEN SITE_LATITUDE IS NULL THEN 2 WHEN SITE_NAME = '' THEN 3 WHEN NOT inside THEN 4 END AS rule
      FROM assets a LEFT JOIN inside USING (asset_ord))
    SELECT asset_ord, rule IS NULL AS valid,
     CASE WHEN rule = 4 THEN 'register_aed_outside_norway' WHEN rule IS NOT NULL THEN 'register_missing_required_data' END AS issue_type,
     CASE rule WHEN 1 THEN 'Register AED with missing ASSET_GUID is missing required data.' WHEN 2 THEN 'Register AED ' || ASSET_GUID || ' is missing location data.'
       WHEN 3 THEN 'Register AED ' || ASSET_GUID || ' is missing SITE_NAME.' WHEN 4 THEN 'Register AED ' || ASSET_GUID || ' is located outside Norway polygon.' END AS message,
     CASE WHEN rule = 4 THEN '{{"lat":' || {number_sql('SITE_LATITUDE')} || ',"lon":' || {number_sql('SITE_LONGITUDE')} || '}}' WHEN rule IS NOT NULL THEN '{{}}' END AS details
    FROM f""",
)
def validate_registry(spark, sf):
    valid, issues = validate.validate_registry(Inputs(spark, sf).assets, PARAMS)
    kept = valid.selectExpr(
        "asset_ord", "true AS valid", "cast(NULL AS string) AS issue_type", "cast(NULL AS string) AS message", "cast(NULL AS string) AS details"
    )
    return kept.unionByName(issues.selectExpr("sort_id AS asset_ord", "false AS valid", "issue_type", "message", "details"))


@query(
    "only_nodes",
    f"""{ctes('elements')} SELECT id, type = 'node' AS kept, CASE WHEN type <> 'node' THEN 'error' END AS severity,
    CASE WHEN type <> 'node' THEN 'OSM element with id ' || id || ' is of type ' || type || ' and will be skipped.' END AS message,
    CASE WHEN type <> 'node' THEN '{{"osmElementType":"' || type || '"}}' END AS details FROM elements""",
)
def only_nodes(spark, sf):
    nodes, issues = validate.only_nodes(Inputs(spark, sf).elements)
    none = [f"cast(NULL AS string) AS {c}" for c in ("severity", "message", "details")]
    kept = nodes.selectExpr("id", "true AS kept", *none)
    return kept.unionByName(issues.selectExpr("osm_node_id AS id", "false AS kept", "severity", "message", "details"))


def _flag(name: str, expression, sql: str):
    @query(name, f"{ctes('elements')} SELECT id, {sql} AS flag FROM elements")
    def flagged(spark, sf):
        return Inputs(spark, sf).elements.selectExpr("id", f"{expression('tags', PARAMS)} AS flag")

    return flagged


_flag("is_managed", lambda t, p: f"{tags.managed_ref(t, p)} IS NOT NULL", "coalesce(trim(ref), '') <> ''")
_flag("is_opted_out", tags.is_opted_out, "coalesce(note, '') <> '' OR coalesce(fixme, '') <> ''")
_flag("has_conflict_tags", tags.has_conflict_tags, "amenity IS NOT NULL")
_flag("is_aed_only", tags.is_aed_only, "amenity IS NULL")


@query(
    "to_register_aed",
    f"{ctes('assets')} SELECT asset_ord, ASSET_GUID FROM assets WHERE ASSET_GUID IS NOT NULL AND SITE_LATITUDE IS NOT NULL",
)
def to_register_aed(spark, sf):
    return validate.to_register_aed(Inputs(spark, sf).assets).select("asset_ord", "ASSET_GUID")


@query("require_rows", f"{ctes('nodes')} SELECT count(*) AS nodes FROM nodes HAVING count(*) > 0")
def require_rows(spark, sf):
    nodes = Inputs(spark, sf).nodes
    validate.require_rows(nodes)
    return nodes.selectExpr("count(*) AS nodes")


@query(
    "element_metrics",
    f"{ctes('elements')} SELECT count(*) AS osm_aeds, count(*) FILTER (WHERE type = 'node' AND coalesce(ref, '') <> '') AS linked_aeds FROM elements",
)
def element_metrics(spark, sf):
    return validate.element_metrics(Inputs(spark, sf).elements, PARAMS)

"""Change plans, their issues, metrics and guards, numbering and output texts."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteconcord.catalog.book import ELEMENT_TAGS, PARAMS, Inputs, ctes, distance, number_sql, query
from siteconcord.catalog.matching import CLAIMS
from siteconcord.catalog.scalars import HOURS_SQL, MAPPED_SQL, MERGED_SQL, MOVED_SQL, REST_SQL
from siteconcord.functions import tags
from siteconcord.operators.keyed import linked_nodes
from siteconcord.operators.validate import delete_guard
from siteconcord.plans import reconcile as plans
from siteconcord.session import materialized, new_folder
from siteconcord.sources import sinks

_FLAT = "task_rank, op, id, round(lat, 6) AS lat, round(lon, 6) AS lon, tags AS tags_text, message"


def _rows(plan: DataFrame, issues: DataFrame) -> DataFrame:
    """Plan rows and issues in one flat shape."""
    node = "CASE WHEN op = 'delete' THEN before ELSE after END AS node"
    planned = plan.selectExpr("task_rank", "op", node).selectExpr(
        "task_rank",
        "op",
        "node.id",
        "round(node.lat, 6) AS lat",
        "round(node.lon, 6) AS lon",
        f"{tags.tags_text('node.tags')} AS tags_text",
        "cast(NULL AS string) AS message",
    )
    raised = issues.selectExpr(
        "task_rank",
        "issue_type AS op",
        "osm_node_id AS id",
        "cast(NULL AS double) AS lat",
        "cast(NULL AS double) AS lon",
        "details AS tags_text",
        "message",
    )
    return planned.unionByName(raised)


_NODE_TO_ASSET = distance("n.lat", "n.lon", "a.SITE_LATITUDE", "a.SITE_LONGITUDE")
_OFF = distance("lat", "lon", "SITE_LATITUDE", "SITE_LONGITUDE")
_ISSUE = "CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS DOUBLE) AS lon, '{}' AS tags"
_TASKS = {
    1: f"""SELECT 1 AS task_rank, 'osm_node_note_opt_out' AS op, '' AS st, 0.0::DOUBLE AS sd, elem_ord AS si, id, {_ISSUE},
      'Node ' || id || ' has a note/fixme tag and is excluded from AED extraction.' AS message FROM nodes WHERE NOT aed_only AND opted_out
    UNION ALL SELECT 1, 'modify', '', 0.0, elem_ord, id, lat, lon, {REST_SQL}, NULL FROM extracted
    UNION ALL SELECT 1, 'create', '', 0.0, elem_ord, -1, SITE_LATITUDE, SITE_LONGITUDE, {MOVED_SQL}, NULL FROM extracted""",
    2: f"""SELECT 2 AS task_rank, CASE WHEN aed_only THEN 'delete' ELSE 'skipped_delete_not_aed_only' END AS op, '' AS st, 0.0::DOUBLE AS sd, elem_ord AS si, id,
      CASE WHEN aed_only THEN lat END AS lat, CASE WHEN aed_only THEN lon END AS lon, CASE WHEN aed_only THEN {ELEMENT_TAGS} ELSE '{{}}' END AS tags,
      CASE WHEN NOT aed_only THEN 'Skipped delete of node ' || id || ' (' || mref || '): node has non-AED tags.' END AS message
      FROM managed WHERE mref NOT IN (SELECT ASSET_GUID FROM valid)""",
    3: f"""SELECT 3 AS task_rank, CASE WHEN aed_only THEN 'delete' ELSE 'skipped_delete_not_aed_only' END AS op, mref AS st, coalesce(d, 0.0) AS sd, id AS si, id,
      CASE WHEN aed_only THEN lat END AS lat, CASE WHEN aed_only THEN lon END AS lon, CASE WHEN aed_only THEN {ELEMENT_TAGS} ELSE '{{}}' END AS tags,
      CASE WHEN NOT aed_only THEN 'Skipped duplicate delete of node ' || id || ' (' || mref || '): node has non-AED tags.' END AS message
      FROM ranked WHERE rn > 1""",
    4: f"""SELECT 4 AS task_rank, 'osm_node_note_opt_out' AS op, '' AS st, 0.0::DOUBLE AS sd, elem_ord AS si, id, {_ISSUE},
      'Node ' || id || ' (' || mref || ') has a note/fixme tag and is excluded from updates.' AS message FROM managed JOIN refs USING (mref) WHERE members = 1 AND opted_out
    UNION ALL SELECT 4, 'managed_node_location_within_tolerance', '', 0.0, elem_ord, id, NULL, NULL,
      '{{"distanceMeters":' || {number_sql('round(off, 2)')} || ',"maxNoMoveDistanceMeters":100}}',
      'Node ' || id || ' (' || mref || ') is ' || printf('%.1f', off) || 'm from register location; keeping OSM location.' FROM updated WHERE off > 2 AND off <= 100
    UNION ALL SELECT 4, 'modify', '', 0.0, elem_ord, id, CASE WHEN off > 100 THEN SITE_LATITUDE ELSE lat END, CASE WHEN off > 100 THEN SITE_LONGITUDE ELSE lon END, {MERGED_SQL}, NULL
      FROM updated LEFT JOIN week USING (asset_ord)""",
    5: f"""SELECT 5 AS task_rank, 'osm_node_note_opt_out' AS op, '' AS st, 0.0::DOUBLE AS sd, c.asset_ord AS si, id, {_ISSUE},
      'Skipped merge of register AED ' || ASSET_GUID || ' with node ' || id || ' (' || printf('%.1f', d) || 'm): node is opted out.' AS message
      FROM claims c JOIN valid USING (asset_ord) JOIN nodes USING (elem_ord) WHERE outcome = 'opted_out'
    UNION ALL SELECT 5, 'modify', '', 0.0, asset_ord, id, lat, lon, {MERGED_SQL}, NULL
      FROM claims c JOIN valid USING (asset_ord) JOIN nodes USING (elem_ord) LEFT JOIN week USING (asset_ord) WHERE outcome = 'claimed'
    UNION ALL SELECT 5, 'create', '', 0.0, asset_ord, -1, SITE_LATITUDE, SITE_LONGITUDE, {MAPPED_SQL}, NULL
      FROM unlinked LEFT JOIN week USING (asset_ord) WHERE asset_ord NOT IN (SELECT asset_ord FROM claims) AND asset_ord NOT IN (SELECT asset_ord FROM mixed)""",
}
_BASE = f"""{ctes('valid', 'managed', 'refs', 'unlinked', recursive=True)}, {HOURS_SQL}, {CLAIMS},
near_any AS (SELECT n.elem_ord, a.asset_ord FROM nodes n JOIN valid a ON abs(n.lat - a.SITE_LATITUDE) < 0.0016 AND abs(n.lon - a.SITE_LONGITUDE) < 0.004
  WHERE NOT n.aed_only AND NOT n.opted_out AND n.mref IS NULL AND {_NODE_TO_ASSET} <= 175 QUALIFY row_number() OVER (PARTITION BY n.elem_ord ORDER BY {_NODE_TO_ASSET}, a.asset_ord) = 1),
extracted AS (SELECT n.*, SITE_LATITUDE, SITE_LONGITUDE FROM nodes n JOIN valid a ON a.ASSET_GUID = n.mref WHERE NOT aed_only AND NOT opted_out
  UNION ALL SELECT n.*, SITE_LATITUDE, SITE_LONGITUDE FROM nodes n JOIN near_any USING (elem_ord) JOIN valid a USING (asset_ord)),
ranked AS (SELECT m.*, {_OFF} AS d, row_number() OVER (PARTITION BY mref ORDER BY {_OFF} NULLS LAST, id) AS rn
  FROM managed m JOIN refs USING (mref) LEFT JOIN valid ON ASSET_GUID = mref WHERE members > 1),
updated AS (SELECT *, {_OFF} AS off FROM managed JOIN refs USING (mref) JOIN valid ON ASSET_GUID = mref WHERE members = 1 AND NOT opted_out),
plan AS ({' UNION ALL '.join(_TASKS.values())})"""


def _task_sql(rank: int) -> str:
    return f"{_BASE} SELECT {_FLAT} FROM plan WHERE task_rank = {rank}"


def _linked(spark, sf):
    valid, nodes = Inputs(spark, sf).staged
    linked, hot = linked_nodes(nodes, valid, tags.map_asset_to_tags(PARAMS))
    return valid, nodes, materialized(linked, "linked"), hot


@query("plan_extract_mixed", _task_sql(1))
def plan_extract_mixed(spark, sf):
    valid, nodes, linked, _ = _linked(spark, sf)
    return _rows(*plans.plan_extract_mixed(nodes, valid, linked, PARAMS))


@query("plan_delete_removed", _task_sql(2))
def plan_delete_removed(spark, sf):
    _, _, linked, _ = _linked(spark, sf)
    return _rows(*plans.plan_delete_removed(linked, PARAMS))


@query("plan_resolve_duplicates", _task_sql(3))
def plan_resolve_duplicates(spark, sf):
    _, _, linked, hot = _linked(spark, sf)
    return _rows(*plans.plan_resolve_duplicates(linked, hot, PARAMS))


@query("plan_update_existing", _task_sql(4))
def plan_update_existing(spark, sf):
    _, _, linked, _ = _linked(spark, sf)
    return _rows(*plans.plan_update_existing(linked, PARAMS))


@query("plan_add_new", _task_sql(5))
def plan_add_new(spark, sf):
    valid, nodes = Inputs(spark, sf).staged
    return _rows(*plans.plan_add_new(nodes, valid, PARAMS))


def _reconciled(spark, sf) -> plans.Reconciliation:
    i = Inputs(spark, sf)
    return plans.reconcile(i.assets, i.elements, PARAMS)


PLAN_SQL = _BASE
_IS_OP = "op IN ('create', 'modify', 'delete')"


@query(
    "reconcile",
    f"""{_BASE}, c AS (SELECT count(*) FILTER (WHERE op = 'create') AS created, count(*) FILTER (WHERE op = 'modify') AS updated, count(*) FILTER (WHERE op = 'delete') AS deleted FROM plan),
    i AS (SELECT count(*) FILTER (WHERE NOT {_IS_OP}) + (SELECT count(*) FROM elements WHERE type <> 'node') + (SELECT count(*) FROM assets) - (SELECT count(*) FROM valid) AS issues FROM plan),
    e AS (SELECT count(*) AS osm_aeds, count(*) FILTER (WHERE type = 'node' AND coalesce(ref, '') <> '') AS linked_aeds, count(*) FILTER (WHERE type = 'node') AS total FROM elements)
    SELECT (SELECT count(*) FROM assets) AS registry_aeds, osm_aeds, linked_aeds, created, updated, deleted, issues, deleted::DOUBLE / total <= 0.5 AS ok FROM c, i, e""",
)
def reconcile(spark, sf):
    result = _reconciled(spark, sf)
    issues = result.issues.selectExpr("count(*) AS issues")
    # One-row tables side by side.
    row = result.input_metrics
    for part in (result.metrics, issues, result.guard.select("ok")):
        row = row.join(F.broadcast(part), how="cross")
    return row


@query("merge_plans", f"{_BASE} SELECT {_FLAT} FROM plan")
def merge_plans(spark, sf):
    result = _reconciled(spark, sf)
    return _rows(result.plan, result.issues.filter("task_rank > 0"))


def _asset_plan(spark, sf) -> DataFrame:
    """A create for every valid asset, and a delete for every node."""
    valid, nodes = Inputs(spark, sf).staged
    mapped = valid.withColumn("tags", F.expr(tags.tags_from([("ref", "ASSET_GUID"), ("name", "concat('<', SITE_NAME, '>')")])))
    created = plans._node("-1", "SITE_LATITUDE", "SITE_LONGITUDE", "0", "tags")
    return plans.plan_rows(mapped, plans.ADD, {"create": ("", created)}, sort_id="asset_ord").unionByName(
        plans.plan_rows(nodes, plans.DELETE, {"delete": (plans.CURRENT, "")}, sort_id="elem_ord")
    )


_NUMBERED = f"{ctes('valid', 'nodes')}, n AS (SELECT *, -row_number() OVER (ORDER BY asset_ord) AS nid FROM valid)"


@query("assign_create_ids", f"{_NUMBERED} SELECT asset_ord AS sort_id, 'create' AS op, nid AS id FROM n UNION ALL SELECT elem_ord, 'delete', id FROM nodes")
def assign_create_ids(spark, sf):
    numbered = sinks.assign_create_ids(_asset_plan(spark, sf))
    return numbered.selectExpr("sort_id", "op", "coalesce(after.id, before.id) AS id")


# --- over the reconciled plan of all five tasks; each under two names --------------------------------------------------

_WHOLE = f"{_BASE}, whole AS (SELECT * FROM plan WHERE {_IS_OP})"


_PLAN_METRICS_SQL = f"{_WHOLE} SELECT count(*) FILTER (WHERE op = 'create') AS created, count(*) FILTER (WHERE op = 'modify') AS updated, count(*) FILTER (WHERE op = 'delete') AS deleted FROM whole"


@query("plan_metrics", _PLAN_METRICS_SQL)
@query("whole_plan_metrics", _PLAN_METRICS_SQL)
def whole_plan_metrics(spark, sf):
    return plans.plan_metrics(_reconciled(spark, sf).plan)


_MAX_DELETE_FRACTION_SQL = f"""{_WHOLE}, c AS (SELECT count(*) FILTER (WHERE op = 'delete') AS deleted, (SELECT count(*) FROM nodes) AS total FROM whole)
    SELECT deleted, total, round(deleted::DOUBLE / total, 6) AS fraction, deleted::DOUBLE / total <= 0.01 AS ok,
    'Delete fraction ' || printf('%.1f', deleted::DOUBLE / total * 100) || '% (' || deleted || '/' || total || ') exceeds max allowed 1.0%. Aborting run to prevent bad changes.' AS message FROM c"""


@query("max_delete_fraction", _MAX_DELETE_FRACTION_SQL)
@query("whole_plan_delete_fraction", _MAX_DELETE_FRACTION_SQL)
def whole_plan_delete_fraction(spark, sf):
    result = _reconciled(spark, sf)
    guard = delete_guard(result.metrics, result.nodes, replace(PARAMS, max_delete_fraction=0.01))
    return guard.selectExpr("deleted", "total", "round(fraction, 6) AS fraction", "ok", "message")


_PLAN_CONFLICTS_SQL = f"""{_WHOLE} SELECT id, count(*) AS changes, count(*) FILTER (WHERE op = 'modify') AS modifies, count(*) FILTER (WHERE op = 'delete') AS deletes
    FROM whole WHERE op <> 'create' GROUP BY id HAVING count(*) > 1"""


@query("plan_conflicts", _PLAN_CONFLICTS_SQL)
@query("whole_plan_conflicts", _PLAN_CONFLICTS_SQL)
def whole_plan_conflicts(spark, sf):
    return plans.plan_conflicts(_reconciled(spark, sf).plan)


# Each row with its final id, and the version and position of the node it changes.
_FINAL = f"""{_WHOLE}, final AS (SELECT w.*, CASE WHEN w.op = 'create' THEN -row_number() OVER (PARTITION BY w.op ORDER BY w.task_rank, w.si) ELSE w.id END AS nid,
    coalesce(n.version, 0) AS version, n.lat AS from_lat, n.lon AS from_lon FROM whole w LEFT JOIN nodes n ON n.id = w.id)"""


def _escaped_sql(c: str) -> str:
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&apos;")):
        c = f"replace({c}, '{mark}', '{entity}')"
    return c


_WRITE_OSC_SQL = f"""{_FINAL}, t AS (SELECT tag FROM (SELECT unnest(string_split(tags, '|')) AS tag FROM final) WHERE tag <> ''),
    l AS (SELECT '    <node id="' || nid || '" lat="' || {number_sql('lat')} || '" lon="' || {number_sql('lon')} || '" version="' || version || '">' AS line FROM final
    UNION ALL SELECT '      <tag k="' || split_part(tag, '=', 1) || '" v="' || {_escaped_sql("substr(tag, strpos(tag, '=') + 1)")} || '" />' FROM t
    UNION ALL SELECT '    </node>' FROM final)
    SELECT line, count(*) AS times FROM l GROUP BY line
    UNION ALL SELECT v.line, 1 FROM (VALUES ('<?xml version="1.0" encoding="UTF-8"?>'), ('<osmChange version="0.6" generator="planned-changes">'), ('  <create>'), ('  </create>'),
      ('  <modify>'), ('  </modify>'), ('  <delete if-unused="true">'), ('  </delete>'), ('</osmChange>')) v(line)"""


@query("write_osc", _WRITE_OSC_SQL)
@query("whole_plan_osc", _WRITE_OSC_SQL)
def whole_plan_osc(spark, sf):
    folder = new_folder(spark, "whole-osc")
    sinks.write_osc(_reconciled(spark, sf).plan, folder)
    return spark.read.text(folder).groupBy(F.col("value").alias("line")).agg(F.expr("count(*) AS times"))


_WRITE_GEOJSON_SQL = f"""{_FINAL} SELECT op, nid AS id, round(lon, 6) AS lon, round(lat, 6) AS lat, round(CASE WHEN op = 'modify' THEN from_lat END, 6) AS from_lat,
    round(CASE WHEN op = 'modify' THEN from_lon END, 6) AS from_lon, tags AS tags_text FROM final"""


@query("write_geojson", _WRITE_GEOJSON_SQL)
@query("whole_plan_geojson", _WRITE_GEOJSON_SQL)
def whole_plan_geojson(spark, sf):
    folder = new_folder(spark, "whole-geojson")
    sinks.write_geojson(_reconciled(spark, sf).plan, folder)
    shape = "geometry struct<coordinates:array<double>>, properties map<string,string>"
    read = spark.read.text(folder).select(F.from_json("value", shape).alias("f")).select("f.geometry.coordinates", "f.properties")
    rest = "map_filter(properties, (k, v) -> k NOT IN ('_operation', '_osm_id', '_from_lat', '_from_lon'))"
    return read.selectExpr(
        "properties['_operation'] AS op",
        "bigint(properties['_osm_id']) AS id",
        "round(coordinates[0], 6) AS lon",
        "round(coordinates[1], 6) AS lat",
        "round(double(properties['_from_lat']), 6) AS from_lat",
        "round(double(properties['_from_lon']), 6) AS from_lon",
        f"{tags.tags_text(rest)} AS tags_text",
    )


# Issues of the inputs come before those of the tasks.
_INPUT_ISSUES = f"""SELECT 0 AS task_rank, CASE WHEN rule IS NULL THEN 'register_aed_outside_norway' ELSE 'register_missing_required_data' END AS op, 'warning' AS severity, asset_ord AS si,
      CAST(NULL AS BIGINT) AS id, CASE WHEN rule IS NULL THEN '{{"lat":' || {number_sql('SITE_LATITUDE')} || ',"lon":' || {number_sql('SITE_LONGITUDE')} || '}}' ELSE '{{}}' END AS tags,
      CASE rule WHEN 1 THEN 'Register AED with missing ASSET_GUID is missing required data.' WHEN 2 THEN 'Register AED ' || ASSET_GUID || ' is missing location data.'
        WHEN 3 THEN 'Register AED ' || ASSET_GUID || ' is missing SITE_NAME.' ELSE 'Register AED ' || ASSET_GUID || ' is located outside Norway polygon.' END AS message
      FROM (SELECT *, CASE WHEN ASSET_GUID IS NULL THEN 1 WHEN SITE_LATITUDE IS NULL THEN 2 WHEN SITE_NAME = '' THEN 3 END AS rule FROM assets WHERE asset_ord NOT IN (SELECT asset_ord FROM valid))
    UNION ALL SELECT 0, 'osm_not_a_node', 'error', elem_ord, id, '{{"osmElementType":"' || type || '"}}',
      'OSM element with id ' || id || ' is of type ' || type || ' and will be skipped.' FROM elements WHERE type <> 'node'"""


_APPEND_ISSUES_SQL = f"""{_BASE}, raised AS ({_INPUT_ISSUES} UNION ALL SELECT task_rank, op, 'warning', si, id, tags, message FROM plan WHERE NOT {_IS_OP})
    SELECT row_number() OVER (ORDER BY task_rank, si, op, message) AS issue_seq, 'run-x' AS run_id, op AS issue_type, severity, message, id AS osm_node_id, tags AS details FROM raised"""


@query("append_issues", _APPEND_ISSUES_SQL)
@query("whole_run_issues", _APPEND_ISSUES_SQL)
def whole_run_issues(spark, sf):
    folder = new_folder(spark, "whole-issues")
    sinks.append_issues(_reconciled(spark, sf).issues, folder, "run-x", "TIMESTAMP_NTZ'2024-01-01 00:00:00'")
    return spark.read.parquet(folder).select("issue_seq", "run_id", "issue_type", "severity", "message", "osm_node_id", "details")

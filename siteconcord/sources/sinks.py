"""Outputs of a plan: change document, point features, issues; all written by the executors in order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteconcord.functions.tags import drop_undefined, has_key
from siteconcord.functions.text import literal, number_text, xml_escape
from siteconcord.operators.ordinals import dense_ordinals
from siteconcord.plans.reconcile import NODE, PLAN_ORDER


def in_order(plan: DataFrame) -> DataFrame:
    """The plan with a section number, references in dictionary order, and `node`: the new state, or the deleted one."""
    return plan.selectExpr(
        "CASE op WHEN 'create' THEN 1 WHEN 'modify' THEN 3 ELSE 5 END AS section",
        "task_rank",
        "collate(sort_text, 'UNICODE') AS sort_text",
        "sort_dist",
        "sort_id",
        "op",
        "before",
        "CASE WHEN op = 'delete' THEN before ELSE after END AS node",
    )


DOCUMENT_ORDER = ("section", *PLAN_ORDER)
_COLLATED = "collate(sort_text, 'UNICODE')"


def assign_create_ids(plan: DataFrame) -> DataFrame:
    """Number the creates with the placeholder id -1 as -1, -2, ... in plan order; other rows stay as they are."""
    waiting = "coalesce(op = 'create' AND after.id = -1, false)"
    numbered = dense_ordinals(plan.filter(waiting), "n", PLAN_ORDER)
    renumbered = (
        "cast(named_struct('id', -n, 'lat', after.lat, 'lon', after.lon, 'version', after.version, 'tags', after.tags) "
        f"AS {NODE})"
    )
    numbered = numbered.withColumn("after", F.expr(renumbered)).drop("n")
    return plan.filter(f"NOT {waiting}").unionByName(numbered)


def osc_lines(plan: DataFrame, generator: str = "planned-changes") -> DataFrame:
    """Lines of the OsmChange document: (section, sort keys, line_no, line)."""
    version = (
        "coalesce(node.version, CASE op WHEN 'create' THEN 0 WHEN 'modify' THEN coalesce(before.version, 1) ELSE 1 END)"
    )
    head = (
        f"concat('    <node id=\"', node.id, '\" lat=\"', {number_text('node.lat')}, '\" lon=\"', "
        f"{number_text('node.lon')}, '\" version=\"', {version}, '\">')"
    )
    # Keys in dictionary order of the Unicode collation.
    entries = (
        f"array_sort(transform(map_entries({drop_undefined('node.tags')}), "
        "e -> named_struct('k', collate(e.key, 'UNICODE'), 'v', e.value)))"
    )
    tag_line = (
        f"concat('      <tag k=\"', {xml_escape("collate(e.k, 'UTF8_BINARY')")}, '\" v=\"', {xml_escape('e.v')}, '\" />')"
    )
    lines = f"concat(array({head}), transform({entries}, e -> {tag_line}), array('    </node>'))"
    body = in_order(plan).selectExpr(*DOCUMENT_ORDER, f"posexplode({lines}) AS (line_no, line)")
    frame = [
        (0, '<?xml version="1.0" encoding="UTF-8"?>'),
        (0, f'<osmChange version="0.6" generator="{generator}">'),
        (0, "  <create>"),
        (2, "  </create>"),
        (2, "  <modify>"),
        (4, "  </modify>"),
        (4, '  <delete if-unused="true">'),
        (6, "  </delete>"),
        (6, "</osmChange>"),
    ]
    rows = [(section, 0, "", 0.0, 0, no, line) for no, (section, line) in enumerate(frame)]
    schema = "section int, task_rank int, sort_text string, sort_dist double, sort_id long, line_no int, line string"
    ends = plan.sparkSession.createDataFrame(rows, schema).withColumn("sort_text", F.expr(_COLLATED))
    return body.unionByName(ends)


def write_osc(plan: DataFrame, path: str, generator: str = "planned-changes") -> None:
    """Write the change document; its part files, put together by name, are the document."""
    lines = osc_lines(assign_create_ids(plan), generator)
    lines.orderBy(*DOCUMENT_ORDER, "line_no").select("line").write.text(path)


def geojson_features(plan: DataFrame) -> DataFrame:
    """One GeoJSON Feature text per change; a tag replaces a property of the same name."""
    tags = drop_undefined("node.tags")
    moved_from = "CASE WHEN op = 'modify' THEN {} END"
    meta = {
        "_operation": "concat('\"', op, '\"')",
        "_osm_id": "string(node.id)",
        "_from_lat": moved_from.format(number_text("before.lat")),
        "_from_lon": moved_from.format(number_text("before.lon")),
    }
    entries = [f"CASE WHEN NOT {has_key(tags, k)} THEN concat('\"{k}\":', {v}) END" for k, v in meta.items()]
    # The tags' JSON object without its braces.
    inner = f"nullif(substr(to_json({tags}), 2, length(to_json({tags})) - 2), '')"
    feature = (
        "concat('{\"type\":\"Feature\",\"geometry\":{\"type\":\"Point\",\"coordinates\":[', "
        f"{number_text('node.lon')}, ',', {number_text('node.lat')}, ']}},\"properties\":{{', "
        f"concat_ws(',', {', '.join(entries)}, {inner}), '}}}}')"
    )
    return in_order(plan).selectExpr(*DOCUMENT_ORDER, f"{feature} AS feature")


def write_geojson(plan: DataFrame, path: str, collection: bool = False) -> None:
    """Write one feature per line in plan order, or all of them as one FeatureCollection over the part files."""
    features = geojson_features(assign_create_ids(plan))
    if not collection:
        features.orderBy(*DOCUMENT_ORDER).select("feature").write.text(path)
        return
    first = features.selectExpr(f"min(struct({', '.join(DOCUMENT_ORDER)})) AS first")
    # All but the first feature begin with a comma; the first is one row.
    comma = f"concat(CASE WHEN struct({', '.join(DOCUMENT_ORDER)}) = first THEN '' ELSE ',' END, feature) AS feature"
    lines = features.join(F.broadcast(first), how="cross").selectExpr(*DOCUMENT_ORDER, comma)
    ends = [(0, 0, "", 0.0, 0, '{"type":"FeatureCollection","features":['), (9, 0, "", 0.0, 0, "]}")]
    schema = "section int, task_rank int, sort_text string, sort_dist double, sort_id long, feature string"
    ends = plan.sparkSession.createDataFrame(ends, schema).withColumn("sort_text", F.expr(_COLLATED))
    lines.unionByName(ends).orderBy(*DOCUMENT_ORDER).select("feature").write.text(path)


def numbered_issues(issues: DataFrame, run_id: str, created_at: str) -> DataFrame:
    """Issues as rows of the run log: an id each, the run, and `issue_seq` in task order."""
    # Equal issues are counted and numbered, so that the order below is unique.
    counted = issues.groupBy(*issues.columns).count()
    rows = counted.withColumn("copy", F.expr("explode(sequence(1L, count))")).drop("count")
    order = ("task_rank", "sort_id", "issue_type", "message", "register_ref", "osm_node_id", "details", "copy")
    return dense_ordinals(rows, "issue_seq", order).selectExpr(
        "uuid() AS id",
        f"{literal(run_id)} AS run_id",
        "issue_seq",
        "issue_type",
        "severity",
        "message",
        "register_ref",
        "osm_node_id",
        "details",
        f"{created_at} AS created_at",
        f"date({created_at}) AS created_on",
    )


def append_issues(issues: DataFrame, path: str, run_id: str, created_at: str) -> None:
    rows = numbered_issues(issues, run_id, created_at)
    rows.write.mode("append").partitionBy("created_on").parquet(path)

"""Point layer: features with their opening state, counts, bounds and clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteconcord.functions.display import element_url
from siteconcord.functions.geo import mercator_cell
from siteconcord.functions.hours import opening_state
from siteconcord.functions.tags import tag
from siteconcord.functions.text import number_text
from siteconcord.params import MatchParams

# The layer clusters within 40 pixels up to this zoom level.
CLUSTER_PX = 40
CLUSTER_MAX_ZOOM = 12


def element_point(elements: DataFrame) -> DataFrame:
    """Elements with point_lat / point_lon: a node's own position, else the centre; those with neither are dropped."""
    own = "type = 'node' AND lat IS NOT NULL AND lon IS NOT NULL"
    return elements.selectExpr(
        "*",
        f"CASE WHEN {own} THEN lat ELSE center.lat END AS point_lat",
        f"CASE WHEN {own} THEN lon ELSE center.lon END AS point_lon",
    ).filter("point_lat IS NOT NULL AND point_lon IS NOT NULL")


def map_features(elements: DataFrame, p: MatchParams) -> DataFrame:
    return element_point(elements).selectExpr(
        "concat(type, '/', id) AS feature_id",
        "point_lat",
        "point_lon",
        f"{tag('tags', p.ref_key)} AS ref",
        f"{tag('tags', 'name')} AS name",
        f"{tag('tags', 'level')} AS level",
        f"{tag('tags', 'defibrillator:location')} AS location",
        f"{tag('tags', 'opening_hours')} AS opening_hours",
        "type AS element_type",
        f"{element_url('type', 'id')} AS osm_url",
    )


def with_opening_state(features: DataFrame, at: str) -> DataFrame:
    """Features with opening_state and is_closed_now at an instant (UTC)."""
    judged = features.withColumn("opening_state", F.expr(opening_state("opening_hours", at)))
    return judged.withColumn("is_closed_now", F.expr("opening_state = 'closed'"))


def map_status_counts(elements: DataFrame, decorated: DataFrame) -> DataFrame:
    """One row: all elements, displayed ones, closed ones."""
    shown = decorated.selectExpr("count(*) AS displayed", "count_if(is_closed_now) AS closed")
    # Two one-row aggregates.
    return shown.join(F.broadcast(elements.selectExpr("count(*) AS total")), how="cross")


def map_bounds(features: DataFrame) -> DataFrame:
    return features.selectExpr(
        "min(point_lon) AS west", "min(point_lat) AS south", "max(point_lon) AS east", "max(point_lat) AS north"
    )


def cluster_rollup(decorated: DataFrame, max_zoom: int = CLUSTER_MAX_ZOOM) -> DataFrame:
    """Clusters of all zoom levels: (zoom, cell_x, cell_y, point_count, closed_count, open_count, kind).

    Cells of one level nest in those of the level above, so each level is summed up from the finest one: the points
    are read and shuffled once, pre-aggregated, and the levels above only see cells.
    """
    x, y = mercator_cell("point_lat", "point_lon", max_zoom, CLUSTER_PX)
    points = decorated.selectExpr(f"{x} AS cell_x", f"{y} AS cell_y", "is_closed_now")
    cells = points.groupBy("cell_x", "cell_y").agg(
        F.expr("count(*) AS point_count"), F.expr("count_if(is_closed_now) AS closed_count")
    )
    zoomed = cells.withColumn("zoom", F.expr(f"explode(sequence(0, {max_zoom}))")).selectExpr(
        "zoom",
        f"floor(cell_x / pow(2, {max_zoom} - zoom)) AS cell_x",
        f"floor(cell_y / pow(2, {max_zoom} - zoom)) AS cell_y",
        "point_count",
        "closed_count",
    )
    rolled = zoomed.groupBy("zoom", "cell_x", "cell_y").agg(
        F.expr("sum(point_count) AS point_count"), F.expr("sum(closed_count) AS closed_count")
    )
    kind = "CASE WHEN closed_count = 0 THEN 'open' WHEN closed_count = point_count THEN 'closed' ELSE 'mixed' END"
    return rolled.selectExpr("*", "point_count - closed_count AS open_count", f"{kind} AS kind")


def feature_json(features: DataFrame) -> DataFrame:
    """Features as GeoJSON texts with their eight properties, null ones kept."""
    properties = (
        "to_json(named_struct('id', feature_id, 'ref', ref, 'name', name, 'level', level, 'location', location, "
        "'openingHours', opening_hours, 'elementType', element_type, 'osmUrl', osm_url), map('ignoreNullFields', 'false'))"
    )
    text = (
        "concat('{\"type\":\"Feature\",\"geometry\":{\"type\":\"Point\",\"coordinates\":[', "
        f"{number_text('point_lon')}, ',', {number_text('point_lat')}, ']}},\"properties\":', {properties}, '}}')"
    )
    return features.selectExpr("feature_id", f"{text} AS feature")


def map_payload(elements: DataFrame, p: MatchParams, generated_at: str, base_timestamp: str):
    """(summary, features): the payload's head as one row, its features as texts, one per row."""
    features = map_features(elements, p)
    shown = features.selectExpr("count(*) AS displayedElements")
    # Two one-row aggregates.
    summary = elements.selectExpr("count(*) AS totalElements").join(F.broadcast(shown), how="cross")
    head = summary.selectExpr(
        f"{generated_at} AS generatedAt", f"{base_timestamp} AS osmBaseTimestamp", "totalElements", "displayedElements"
    )
    return head, feature_json(features)


def write_map_payload(elements: DataFrame, p: MatchParams, path: str, generated_at: str, base_timestamp: str) -> None:
    """Write `path/summary` (one JSON row) and `path/features` (GeoJSON lines)."""
    summary, features = map_payload(elements, p, generated_at, base_timestamp)
    summary.write.option("ignoreNullFields", "false").json(f"{path}/summary")
    features.select("feature").write.text(f"{path}/features")

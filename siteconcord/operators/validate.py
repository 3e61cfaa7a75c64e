"""Checks on the two inputs, with the issues they raise, and the guards of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteconcord import params
from siteconcord.functions.geo import in_polygons, is_finite
from siteconcord.functions.tags import is_aed_only, is_linked, is_opted_out, managed_ref
from siteconcord.functions.text import json_numbers
from siteconcord.params import MatchParams
from siteconcord.session import materialized, spread

ISSUE_FIELDS = ("task_rank", "sort_id", "issue_type", "severity", "message", "register_ref", "osm_node_id", "details")


def issue_rows(
    rows: DataFrame,
    *,
    rank: int,
    sort_id: str,
    kind: str,
    message: str,
    severity: str = "warning",
    ref: str = "NULL",
    node: str = "NULL",
    details: str = "'{}'",
) -> DataFrame:
    """One issue per row, in the shape all issues share; details are a JSON text. Arguments are SQL expressions."""
    return rows.selectExpr(
        f"{rank} AS task_rank",
        f"bigint({sort_id}) AS sort_id",
        f"{kind} AS issue_type",
        f"'{severity}' AS severity",
        f"{message} AS message",
        f"string({ref}) AS register_ref",
        f"bigint({node}) AS osm_node_id",
        f"coalesce({details}, '{{}}') AS details",
    )


def _present(c: str) -> str:
    """A number that is neither null, NaN nor zero."""
    return f"coalesce({c} <> 0 AND NOT isnan({c}), false)"


def _text(c: str) -> str:
    return f"coalesce({c} <> '', false)"


def registry_fault(p: MatchParams) -> str:
    """The first rule an asset breaks: guid, location, name or outside; null when it is valid."""
    return (
        f"CASE WHEN NOT {_text('ASSET_GUID')} THEN 'guid' "
        f"WHEN NOT ({_present('SITE_LATITUDE')} AND {_present('SITE_LONGITUDE')}) THEN 'location' "
        f"WHEN NOT {_text('SITE_NAME')} THEN 'name' "
        f"WHEN NOT {in_polygons('SITE_LATITUDE', 'SITE_LONGITUDE', p.boundary)} THEN 'outside' END"
    )


def with_fault(assets: DataFrame, p: MatchParams) -> DataFrame:
    return assets.withColumn("fault", F.expr(registry_fault(p)))


def registry_issues(checked: DataFrame) -> DataFrame:
    """One issue per asset with a fault."""
    return issue_rows(
        checked.filter("fault IS NOT NULL"),
        rank=0,
        sort_id="asset_ord",
        kind=f"CASE fault WHEN 'outside' THEN '{params.OUTSIDE}' ELSE '{params.MISSING}' END",
        message="CASE fault WHEN 'guid' THEN 'Register AED with missing ASSET_GUID is missing required data.' "
        "WHEN 'location' THEN concat('Register AED ', ASSET_GUID, ' is missing location data.') "
        "WHEN 'name' THEN concat('Register AED ', ASSET_GUID, ' is missing SITE_NAME.') "
        "ELSE concat('Register AED ', ASSET_GUID, ' is located outside Norway polygon.') END",
        ref="CASE WHEN fault <> 'guid' THEN ASSET_GUID END",
        details=f"CASE fault WHEN 'outside' THEN {json_numbers(lat='SITE_LATITUDE', lon='SITE_LONGITUDE')} END",
    )


def without_fault(checked: DataFrame) -> DataFrame:
    return checked.filter("fault IS NULL").drop("fault")


def validate_registry(assets: DataFrame, p: MatchParams) -> tuple[DataFrame, DataFrame]:
    """(valid assets, issues).

    The faults are written out: Spark moves a filter on them below the deal over the cores, into the few splits of a small file.
    """
    checked = materialized(with_fault(spread(assets), p), "assets")
    return without_fault(checked), registry_issues(checked)


def to_register_aed(assets: DataFrame) -> DataFrame:
    """Assets with a key and a numeric position."""
    return assets.filter(f"{_text('ASSET_GUID')} AND {is_finite('SITE_LATITUDE')} AND {is_finite('SITE_LONGITUDE')}")


IS_NODE = f"coalesce(type = 'node' AND {is_finite('lat')} AND {is_finite('lon')}, false)"


def only_nodes(elements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes with a position, issues for all other elements)."""
    issues = issue_rows(
        elements.filter(f"NOT {IS_NODE}"),
        rank=0,
        sort_id="elem_ord",
        kind=f"'{params.NOT_A_NODE}'",
        severity="error",
        message="concat('OSM element with id ', id, ' is of type ', type, ' and will be skipped.')",
        node="id",
        details="to_json(named_struct('osmElementType', type))",
    )
    return elements.filter(IS_NODE), issues


def with_flags(nodes: DataFrame, p: MatchParams) -> DataFrame:
    """Nodes with what the tasks ask of their tags: ref (null = unmanaged), opted_out, aed_only."""
    return nodes.selectExpr(
        "elem_ord",
        "id",
        "lat",
        "lon",
        "version",
        "tags",
        f"{managed_ref('tags', p)} AS ref",
        f"{is_opted_out('tags', p)} AS opted_out",
        f"{is_aed_only('tags', p)} AS aed_only",
    )


def element_metrics(elements: DataFrame, p: MatchParams) -> DataFrame:
    """One row: all elements, and nodes with a reference (blanks count)."""
    return elements.selectExpr("count(*) AS osm_aeds", f"count_if({IS_NODE} AND {is_linked('tags', p)}) AS linked_aeds")


class RunAborted(Exception):
    """A guard stopped the run; what was known of the inputs by then (one-row counts, issues) goes with it."""

    def __init__(self, message: str, input_metrics: DataFrame | None = None, issues: DataFrame | None = None):
        super().__init__(message)
        self.input_metrics, self.issues = input_metrics, issues


def require_rows(nodes: DataFrame, input_metrics: DataFrame | None = None, issues: DataFrame | None = None) -> None:
    if nodes.isEmpty():
        raise RunAborted("The extract holds no node; nothing is planned from it.", input_metrics, issues)


def delete_guard(metrics: DataFrame, nodes: DataFrame, p: MatchParams) -> DataFrame:
    """One row (deleted, total, fraction, ok, message): more deletes than the allowed share of nodes is not ok."""
    total = nodes.selectExpr("count(*) AS total")
    message = (
        "concat(format_string('Delete fraction %.1f%% (%d/%d)', fraction * 100, deleted, total), "
        f"' exceeds max allowed {p.max_delete_fraction * 100:.1f}%. Aborting run to prevent bad changes.')"
    )
    # Both sides are one-row aggregates.
    return (
        metrics.select("deleted")
        .join(F.broadcast(total), how="cross")
        .withColumn("fraction", F.expr("coalesce(try_divide(double(deleted), total), 0D)"))
        .withColumn("ok", F.expr(f"fraction <= {p.max_delete_fraction!r}D"))
        .withColumn("message", F.expr(f"CASE WHEN NOT ok THEN {message} END"))
    )


def enforce(guard: DataFrame) -> None:
    row = guard.first()
    if not row["ok"]:
        raise RunAborted(row["message"])

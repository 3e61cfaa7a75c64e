"""The reconciliation tasks: change plans and issues from validated nodes and assets.

The tasks read the same inputs and do not see each other's plans. A plan is one table of rows
(task_rank, op, sort_text, sort_dist, sort_id, before, after); `before` is null for creates, `after` for deletes.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteconcord import params
from siteconcord.functions.geo import haversine_m
from siteconcord.functions.tags import (
    map_asset_to_tags,
    merge_tags,
    only_keys,
    or_empty,
    tag_updates,
    without_keys,
)
from siteconcord.functions.text import json_numbers
from siteconcord.operators.claim import greedy_claim
from siteconcord.operators.keyed import keep_first, linked_nodes, unlinked_assets
from siteconcord.operators.skew import hot_keys, skew_join
from siteconcord.operators.spatial import nearest_within
from siteconcord.operators.validate import (
    delete_guard,
    element_metrics,
    issue_rows,
    only_nodes,
    registry_issues,
    require_rows,
    to_register_aed,
    with_fault,
    with_flags,
    without_fault,
)
from siteconcord.params import MatchParams
from siteconcord.session import materialized, spread

EXTRACT, DELETE, DEDUPE, UPDATE, ADD = 1, 2, 3, 4, 5
PLAN_ORDER = ("task_rank", "sort_text", "sort_dist", "sort_id")
NODE = "struct<id:bigint,lat:double,lon:double,version:int,tags:map<string,string>>"


def _node(node_id: str, lat: str, lon: str, version: str, tags: str) -> str:
    fields = f"'id', {node_id}, 'lat', {lat}, 'lon', {lon}, 'version', {version}, 'tags', {tags}"
    return f"cast(named_struct({fields}) AS {NODE})"


CURRENT = _node("id", "lat", "lon", "version", or_empty("tags"))


def plan_rows(
    rows: DataFrame, rank: int, changes: dict[str, tuple[str, str]], *, sort_id: str, sort_text: str = "''", sort_dist: str = "0D"
) -> DataFrame:
    """Plan rows of a task: for each op of `changes` one row per input row, with its (before, after) expressions."""
    none = f"cast(NULL AS {NODE})"
    structs = ", ".join(
        f"named_struct('op', '{op}', 'before', {before or none}, 'after', {after or none})"
        for op, (before, after) in changes.items()
    )
    keys = (f"{rank} AS task_rank", f"{sort_text} AS sort_text", f"{sort_dist} AS sort_dist", f"bigint({sort_id}) AS sort_id")
    return rows.selectExpr(*keys, f"inline(array({structs}))").select(
        "task_rank", "op", "sort_text", "sort_dist", "sort_id", "before", "after"
    )


def union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# Plans of the tasks are put one after the other; nothing is merged or dropped.
merge_plans = union


def plan_extract_mixed(nodes: DataFrame, assets: DataFrame, linked: DataFrame, p: MatchParams):
    """Move the device off nodes that are something else too, to a node of its own at the asset's position."""
    issues = issue_rows(
        nodes.filter("NOT aed_only AND opted_out"),
        rank=EXTRACT,
        sort_id="elem_ord",
        kind=f"'{params.OPTED_OUT}'",
        message="concat('Node ', id, ' has a note/fixme tag and is excluded from AED extraction.')",
        node="id",
    )
    columns = ("elem_ord", "id", "lat", "lon", "version", "tags")
    by_key = linked.filter("NOT aed_only AND NOT opted_out AND first_lat IS NOT NULL").selectExpr(
        *columns, "first_lat AS to_lat", "first_lon AS to_lon"
    )
    unmanaged = nodes.filter("NOT aed_only AND NOT opted_out AND ref IS NULL").select(*columns)
    near = nearest_within(
        unmanaged,
        assets,
        p.merge_radius_m,
        left_id="elem_ord",
        right_id="asset_ord",
        right_at=("SITE_LATITUDE", "SITE_LONGITUDE"),
    )
    # Written out: many nodes may share one nearest asset, so the join with the places looks for hot ones first.
    near = materialized(near, "near", heavy=True)
    places = assets.selectExpr("asset_ord", "SITE_LATITUDE AS to_lat", "SITE_LONGITUDE AS to_lon")
    placed = skew_join(near, places, "asset_ord", "inner", hot_keys(near, "asset_ord"))
    by_place = unmanaged.join(placed.select("elem_ord", "to_lat", "to_lon"), "elem_ord")
    stripped = _node("id", "lat", "lon", "version", without_keys("tags", p.moved_keys))
    moved = _node("-1", "to_lat", "to_lon", "0", only_keys("tags", p.moved_keys))
    changes = {"modify": (CURRENT, stripped), "create": ("", moved)}
    return plan_rows(by_key.unionByName(by_place), EXTRACT, changes, sort_id="elem_ord"), issues


def plan_delete_removed(linked: DataFrame, p: MatchParams):
    """Delete managed nodes whose reference left the registry, unless they are something else too."""
    stale = linked.filter("asset_lat IS NULL")
    plan = plan_rows(stale.filter("aed_only"), DELETE, {"delete": (CURRENT, "")}, sort_id="elem_ord")
    issues = issue_rows(
        stale.filter("NOT aed_only"),
        rank=DELETE,
        sort_id="elem_ord",
        kind=f"'{params.KEPT_MIXED}'",
        message="concat('Skipped delete of node ', id, ' (', ref, '): node has non-AED tags.')",
        ref="ref",
        node="id",
    )
    return plan, issues


def plan_resolve_duplicates(linked: DataFrame, hot: list, p: MatchParams):
    """Of nodes sharing a reference keep the one closest to the asset and delete the others."""
    extra = keep_first(linked.filter("members > 1"), hot).filter("NOT kept")
    plan = plan_rows(
        extra.filter("aed_only"),
        DEDUPE,
        {"delete": (CURRENT, "")},
        sort_id="id",
        sort_text="ref",
        sort_dist="coalesce(asset_distance_m, 0D)",
    )
    issues = issue_rows(
        extra.filter("NOT aed_only"),
        rank=DEDUPE,
        sort_id="id",
        kind=f"'{params.KEPT_MIXED}'",
        message="concat('Skipped duplicate delete of node ', id, ' (', ref, '): node has non-AED tags.')",
        ref="ref",
        node="id",
    )
    return plan, issues


def plan_update_existing(linked: DataFrame, p: MatchParams):
    """Bring tags up to date, and the position when it is too far off."""
    single = linked.filter("members = 1")
    opted_out = issue_rows(
        single.filter("opted_out"),
        rank=UPDATE,
        sort_id="elem_ord",
        kind=f"'{params.OPTED_OUT}'",
        message="concat('Node ', id, ' (', ref, ') has a note/fixme tag and is excluded from updates.')",
        ref="ref",
        node="id",
    )
    found = single.filter("NOT opted_out AND asset_lat IS NOT NULL").withColumn(
        "off_m", F.expr(haversine_m("lat", "lon", "asset_lat", "asset_lon"))
    )
    tolerated = issue_rows(
        found.filter(f"off_m > {p.quiet_location_m!r}D AND off_m <= {p.changed_location_m!r}D"),
        rank=UPDATE,
        sort_id="elem_ord",
        kind=f"'{params.TOLERATED}'",
        message="concat('Node ', id, ' (', ref, ') is ', format_string('%.1f', off_m), "
        "'m from register location; keeping OSM location.')",
        ref="ref",
        node="id",
        details=json_numbers(distanceMeters="round(off_m, 2)", maxNoMoveDistanceMeters=f"{p.changed_location_m!r}D"),
    )
    changed = found.withColumn("updates", F.expr(tag_updates("tags", "mapped"))).withColumn(
        "move", F.expr(f"off_m > {p.changed_location_m!r}D")
    )
    at = [f"CASE WHEN move THEN asset_{c} ELSE {c} END" for c in ("lat", "lon")]
    after = _node("id", *at, "version", merge_tags("tags", "updates"))
    rows = changed.filter("move OR size(updates) > 0")
    plan = plan_rows(rows, UPDATE, {"modify": (CURRENT, after)}, sort_id="elem_ord")
    return plan, opted_out.unionByName(tolerated)


def asset_outcomes(nodes: DataFrame, assets: DataFrame, p: MatchParams) -> DataFrame:
    """(asset_ord, elem_ord, distance_m, outcome) for every asset no managed node carries.

    Outcomes: 'claimed' (merge into the node), 'opted_out', 'near_mixed' (wait for the extraction), 'create'.
    """
    open_assets = unlinked_assets(to_register_aed(assets), nodes).selectExpr(
        "asset_ord", "SITE_LATITUDE AS lat", "SITE_LONGITUDE AS lon"
    )
    # Written out: the rounds of the claim and the look for mixed nodes both start from them.
    open_assets = materialized(open_assets, "open-assets", heavy=True)
    unmanaged = nodes.filter("ref IS NULL").select("elem_ord", "lat", "lon", "opted_out", "aed_only")
    claims = materialized(greedy_claim(open_assets, unmanaged.filter("aed_only"), p.merge_radius_m), "claims")
    rest = open_assets.join(claims.select("asset_ord"), "asset_ord", "left_anti")
    waiting = near_mixed(rest, unmanaged, p).withColumn("outcome", F.lit("near_mixed"))
    return (
        open_assets.select("asset_ord")
        .join(claims.unionByName(waiting), "asset_ord", "left")
        .withColumn("outcome", F.expr("coalesce(outcome, 'create')"))
    )


def near_mixed(open_assets: DataFrame, unmanaged: DataFrame, p: MatchParams) -> DataFrame:
    """(asset_ord, elem_ord, distance_m): assets with an unmanaged node that is something else too in range."""
    mixed = unmanaged.filter("NOT aed_only")
    return nearest_within(open_assets, mixed, p.merge_radius_m, left_id="asset_ord", right_id="elem_ord")


def plan_add_new(nodes: DataFrame, assets: DataFrame, p: MatchParams, outcomes: DataFrame | None = None):
    """Give each unlinked asset a node: merge it into an unmanaged one near it, else create one."""
    outcomes = materialized(asset_outcomes(nodes, assets, p), "outcomes", heavy=True) if outcomes is None else outcomes
    planned = outcomes.filter("outcome IN ('claimed', 'create')").join(assets, "asset_ord")
    mapped = planned.selectExpr(
        "asset_ord", "elem_ord", "outcome", "SITE_LATITUDE AS to_lat", "SITE_LONGITUDE AS to_lon", f"{map_asset_to_tags(p)} AS mapped"
    )
    # A claimed node belongs to one asset, so this join has unique keys on both sides.
    merges = mapped.filter("outcome = 'claimed'").join(nodes, "elem_ord")
    after = _node("id", "lat", "lon", "version", merge_tags("tags", "mapped"))
    created = _node("-1", "to_lat", "to_lon", "0", "mapped")
    plan = plan_rows(merges, ADD, {"modify": (CURRENT, after)}, sort_id="asset_ord").unionByName(
        plan_rows(mapped.filter("outcome = 'create'"), ADD, {"create": ("", created)}, sort_id="asset_ord")
    )
    # A node that opted out is never taken, so any number of assets may end at it.
    blocked = outcomes.filter("outcome = 'opted_out'")
    refusers = nodes.filter("opted_out").select("elem_ord", "id")
    blocked = skew_join(blocked, refusers, "elem_ord", "inner", hot_keys(blocked, "elem_ord"))
    issues = issue_rows(
        blocked.join(assets.select("asset_ord", "ASSET_GUID"), "asset_ord"),
        rank=ADD,
        sort_id="asset_ord",
        kind=f"'{params.OPTED_OUT}'",
        message="concat('Skipped merge of register AED ', ASSET_GUID, ' with node ', id, ' (', "
        "format_string('%.1f', distance_m), 'm): node is opted out.')",
        ref="ASSET_GUID",
        node="id",
    )
    return plan, issues


def plan_metrics(plan: DataFrame) -> DataFrame:
    """One row: creates, modifies and deletes of all tasks, nothing de-duplicated."""
    return plan.selectExpr(
        "count_if(op = 'create') AS created", "count_if(op = 'modify') AS updated", "count_if(op = 'delete') AS deleted"
    )


def plan_conflicts(plan: DataFrame) -> DataFrame:
    """Existing nodes the plan touches more than once, with what it does to them. A report; the plan stays as it is."""
    counts = ("count(*) AS changes", "count_if(op = 'modify') AS modifies", "count_if(op = 'delete') AS deletes")
    touched = plan.filter("before IS NOT NULL").groupBy(F.expr("before.id AS id"))
    return touched.agg(*[F.expr(c) for c in counts]).filter("changes > 1")


@dataclass
class Reconciliation:
    nodes: DataFrame
    assets: DataFrame
    plan: DataFrame
    issues: DataFrame
    input_metrics: DataFrame
    metrics: DataFrame
    guard: DataFrame


def reconcile(assets: DataFrame, elements: DataFrame, p: MatchParams | None = None) -> Reconciliation:
    """Validate both snapshots and plan all changes; `guard` tells whether the plan may be used."""
    p = p or MatchParams()
    kept, element_issues = only_nodes(elements)
    # Written out, since every task reads them: short plans, pruned columns, and nothing to recompute on a lost executor.
    checked = materialized(with_fault(spread(assets), p), "assets")
    valid, nodes = without_fault(checked), materialized(with_flags(spread(kept), p), "nodes")
    # Two one-row aggregates.
    counts = element_metrics(elements, p).join(F.broadcast(assets.selectExpr("count(*) AS registry_aeds")), how="cross")
    require_rows(nodes, counts, union([registry_issues(checked), element_issues]))
    linked, hot = linked_nodes(nodes, valid, map_asset_to_tags(p))
    linked = materialized(linked, "linked", heavy=True)
    outcomes = materialized(asset_outcomes(nodes, valid, p), "outcomes", heavy=True)
    tasks = (
        plan_extract_mixed(nodes, valid, linked, p),
        plan_delete_removed(linked, p),
        plan_resolve_duplicates(linked, hot, p),
        plan_update_existing(linked, p),
        plan_add_new(nodes, valid, p, outcomes),
    )
    # Written once: metrics, guard and files are all made from them.
    plan = materialized(merge_plans(t[0] for t in tasks), "plan", heavy=True)
    issues = materialized(union([registry_issues(checked), element_issues, *(t[1] for t in tasks)]), "issues", heavy=True)
    metrics = plan_metrics(plan)
    return Reconciliation(nodes, valid, plan, issues, counts, metrics, delete_guard(metrics, nodes, p))

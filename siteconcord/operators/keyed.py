"""Matching by reference key.

`nodes` are flagged nodes (see `validate.with_flags`), `assets` are valid assets. The side that is looked up is first
reduced to one row per key, so a key shared by very many nodes costs one row there; the nodes of such a key are not
gathered in one task (see `skew`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteconcord.functions.geo import haversine_m
from siteconcord.operators.skew import hot_keys, skew_join


def managed(nodes: DataFrame) -> DataFrame:
    return nodes.filter("ref IS NOT NULL")


def _per_guid(assets: DataFrame, pick: str) -> DataFrame:
    row = f"struct({', '.join(assets.columns)})"
    return assets.groupBy("ASSET_GUID").agg(F.expr(f"{pick}({row}, asset_ord) AS row")).select("row.*")


def last_per_guid(assets: DataFrame) -> DataFrame:
    """One asset per key, the last in snapshot order."""
    return _per_guid(assets, "max_by")


def first_per_guid(assets: DataFrame) -> DataFrame:
    """One asset per key, the first in snapshot order."""
    return _per_guid(assets, "min_by")


def stale_managed(nodes: DataFrame, assets: DataFrame, hot: list | None = None) -> DataFrame:
    """Managed nodes whose reference the registry lacks."""
    left = managed(nodes)
    known = assets.selectExpr("ASSET_GUID AS ref")
    return skew_join(left, known, "ref", "left_anti", hot_keys(left, "ref") if hot is None else hot)


def managed_with(nodes: DataFrame, per_guid: DataFrame, how: str = "inner", hot: list | None = None) -> DataFrame:
    """Managed nodes with the asset of their reference; `per_guid` has one row per key."""
    left = managed(nodes)
    right = per_guid.withColumnRenamed("ASSET_GUID", "ref")
    return skew_join(left, right, "ref", how, hot_keys(left, "ref") if hot is None else hot)


def managed_with_asset(nodes: DataFrame, assets: DataFrame) -> DataFrame:
    """The last asset of a key counts."""
    return managed_with(nodes, last_per_guid(assets))


def managed_with_first_asset(nodes: DataFrame, assets: DataFrame) -> DataFrame:
    return managed_with(nodes, first_per_guid(assets))


def unlinked_assets(assets: DataFrame, nodes: DataFrame) -> DataFrame:
    """Assets whose key no managed node carries."""
    refs = managed(nodes).selectExpr("ref AS ASSET_GUID")
    return skew_join(assets, refs, "ASSET_GUID", "left_anti", hot_keys(assets, "ASSET_GUID"))


def ref_counts(nodes: DataFrame) -> DataFrame:
    """(ref, members, first_id, last_id) of managed nodes."""
    facts = ("count(*) AS members", "min(id) AS first_id", "max(id) AS last_id")
    return managed(nodes).groupBy("ref").agg(*[F.expr(f) for f in facts])


def duplicate_groups(nodes: DataFrame) -> DataFrame:
    """References held by several nodes, one row each; ordered by the caller if wanted."""
    return ref_counts(nodes).filter("members > 1")


def duplicate_members(nodes: DataFrame, hot: list | None = None) -> DataFrame:
    """Nodes of duplicate groups, one row each instead of a list per group."""
    left = managed(nodes)
    groups = duplicate_groups(nodes).select("ref", "members")
    return skew_join(left, groups, "ref", "inner", hot_keys(left, "ref") if hot is None else hot)


def not_duplicated(nodes: DataFrame, hot: list | None = None) -> DataFrame:
    """Managed nodes whose reference no other node holds."""
    left = managed(nodes)
    alone = ref_counts(nodes).filter("members = 1").select("ref")
    return skew_join(left, alone, "ref", "left_semi", hot_keys(left, "ref") if hot is None else hot)


def duplicate_group_asset(nodes: DataFrame, assets: DataFrame) -> DataFrame:
    """Duplicate groups with the position of their asset; null where the registry lacks the key."""
    where = last_per_guid(assets.select("asset_ord", "ASSET_GUID", "SITE_LATITUDE", "SITE_LONGITUDE"))
    where = where.selectExpr("ASSET_GUID AS ref", "SITE_LATITUDE AS asset_lat", "SITE_LONGITUDE AS asset_lon")
    return duplicate_groups(nodes).join(where, "ref", "left")


def keep_first(members: DataFrame, hot: list) -> DataFrame:
    """Add `kept`: the node of its reference closest to `asset_lat` / `asset_lon`, then with the least id.

    A minimum per reference, pre-aggregated before the shuffle, instead of a window over the group.
    """
    ranked = members.withColumn("asset_distance_m", F.expr(haversine_m("lat", "lon", "asset_lat", "asset_lon")))
    order = "struct(coalesce(asset_distance_m, double('Infinity')), id, elem_ord AS keep_ord)"
    kept = ranked.groupBy("ref").agg(F.expr(f"min({order}) AS keep")).select("ref", "keep.keep_ord")
    return skew_join(ranked, kept, "ref", "inner", hot).withColumn("kept", F.expr("elem_ord = keep_ord")).drop("keep_ord")


def rank_duplicates(nodes: DataFrame, assets: DataFrame) -> DataFrame:
    """Nodes of duplicate groups with their distance to the asset and whether they are the one to keep."""
    left = managed(nodes)
    hot = hot_keys(left, "ref")
    groups = duplicate_group_asset(nodes, assets).select("ref", "members", "asset_lat", "asset_lon")
    return keep_first(skew_join(left, groups, "ref", "inner", hot), hot)


def linked_nodes(nodes: DataFrame, assets: DataFrame, mapped_tags: str) -> tuple[DataFrame, list]:
    """(managed nodes with all the tasks need about their reference, hot references) from one join.

    Adds members (nodes sharing the reference), asset_lat / asset_lon / mapped of the last asset of the key (null =
    not in the registry) and first_lat / first_lon of its first one. Target tags are built once per key, not per node.
    """
    facts = assets.groupBy("ASSET_GUID").agg(
        F.expr(f"max_by(struct({', '.join(assets.columns)}), asset_ord) AS last"),
        F.expr("min_by(struct(SITE_LATITUDE, SITE_LONGITUDE), asset_ord) AS first"),
    )
    facts = facts.select("last.*", "first").selectExpr(
        "ASSET_GUID AS ref",
        "SITE_LATITUDE AS asset_lat",
        "SITE_LONGITUDE AS asset_lon",
        "first.SITE_LATITUDE AS first_lat",
        "first.SITE_LONGITUDE AS first_lon",
        f"{mapped_tags} AS mapped",
    )
    counts = ref_counts(nodes).select("ref", "members")
    left = managed(nodes)
    hot = hot_keys(left, "ref")
    return skew_join(left, counts.join(facts, "ref", "left"), "ref", "left", hot), hot

"""Matching by key and by distance, duplicates, numbering."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from siteconcord.catalog.book import PARAMS, Inputs, ctes, distance, query
from siteconcord.functions.geo import haversine_m
from siteconcord.operators import keyed
from siteconcord.operators.claim import greedy_claim
from siteconcord.operators.ordinals import dense_ordinals
from siteconcord.operators.spatial import nearest_within
from siteconcord.plans.reconcile import asset_outcomes, near_mixed
from siteconcord.session import materialized

_AT_ASSET = ("SITE_LATITUDE", "SITE_LONGITUDE")


@query(
    "stale_managed",
    f"{ctes('managed', 'valid')} SELECT id, mref AS ref FROM managed WHERE mref NOT IN (SELECT ASSET_GUID FROM valid)",
)
def stale_managed(spark, sf):
    i = Inputs(spark, sf)
    return keyed.stale_managed(i.nodes, i.valid).select("id", "ref")


@query(
    "managed_with_asset",
    f"{ctes('managed', 'valid')} SELECT id, mref AS ref, asset_ord, SITE_NAME FROM managed JOIN valid ON ASSET_GUID = mref",
)
def managed_with_asset(spark, sf):
    i = Inputs(spark, sf)
    return keyed.managed_with_asset(i.nodes, i.valid).select("id", "ref", "asset_ord", "SITE_NAME")


# A registry with repeated keys: three assets share each.
_REPEATED = "'K' || CAST(CAST(floor(asset_ord / 3.0) AS BIGINT) AS VARCHAR(20))"


def _repeated(i: Inputs):
    return i.valid.withColumn("ASSET_GUID", F.expr(_REPEATED))


def _nodes_of_repeated(i: Inputs):
    return i.nodes.withColumn("ref", F.expr("CASE WHEN ref IS NOT NULL THEN 'K' || CAST(id % 400 AS VARCHAR(20)) END"))


for _name, _pick, _reduce in (
    ("managed_with_first_asset", "min", keyed.managed_with_first_asset),
    ("managed_with_last_asset", "max", keyed.managed_with_asset),
):

    @query(
        _name,
        f"""{ctes('managed', 'valid')}, k AS (SELECT {_REPEATED} AS guid, {_pick}(asset_ord) AS asset_ord FROM valid GROUP BY ALL)
        SELECT id, asset_ord FROM managed JOIN k ON guid = 'K' || CAST(id % 400 AS VARCHAR(20))""",
    )
    def managed_with_one_of_many(spark, sf, reduce=_reduce):
        i = Inputs(spark, sf)
        return reduce(_nodes_of_repeated(i), _repeated(i)).select("id", "asset_ord")


for _name, _pick, _reduce in (
    ("latest_per_guid", "max", keyed.last_per_guid),
    ("first_per_guid", "min", keyed.first_per_guid),
):

    @query(_name, f"{ctes('valid')} SELECT {_REPEATED} AS ASSET_GUID, {_pick}(asset_ord) AS asset_ord FROM valid GROUP BY ALL")
    def per_guid(spark, sf, reduce=_reduce):
        return reduce(_repeated(Inputs(spark, sf))).select("ASSET_GUID", "asset_ord")


@query("unlinked_assets", f"{ctes('unlinked')} SELECT asset_ord, ASSET_GUID FROM unlinked")
def unlinked_assets(spark, sf):
    i = Inputs(spark, sf)
    return keyed.unlinked_assets(i.valid, i.nodes).select("asset_ord", "ASSET_GUID")


@query("not_duplicated", f"{ctes('managed', 'refs')} SELECT id, mref AS ref FROM managed JOIN refs USING (mref) WHERE members = 1")
def not_duplicated(spark, sf):
    return keyed.not_duplicated(Inputs(spark, sf).nodes).select("id", "ref")


@query(
    "duplicate_refs",
    f"{ctes('managed')} SELECT mref AS ref, count(*) AS members, min(id) AS first_id, max(id) AS last_id FROM managed GROUP BY mref HAVING count(*) > 1",
)
def duplicate_refs(spark, sf):
    return keyed.duplicate_groups(Inputs(spark, sf).nodes)


@query(
    "duplicate_members",
    f"{ctes('managed', 'refs')} SELECT mref AS ref, id, members FROM managed JOIN refs USING (mref) WHERE members > 1",
)
def duplicate_members(spark, sf):
    return keyed.duplicate_members(Inputs(spark, sf).nodes).select("ref", "id", "members")


@query(
    "duplicate_group_asset",
    f"{ctes('refs', 'valid')} SELECT mref AS ref, members, SITE_LATITUDE AS asset_lat FROM refs LEFT JOIN valid ON ASSET_GUID = mref WHERE members > 1",
)
def duplicate_group_asset(spark, sf):
    i = Inputs(spark, sf)
    return keyed.duplicate_group_asset(i.nodes, i.valid).select("ref", "members", "asset_lat")


@query(
    "rank_duplicates",
    f"""{ctes('managed', 'refs', 'valid')}, d AS (SELECT mref, id, {distance('lat', 'lon', 'SITE_LATITUDE', 'SITE_LONGITUDE')} AS d
      FROM managed JOIN refs USING (mref) LEFT JOIN valid ON ASSET_GUID = mref WHERE members > 1)
    SELECT mref AS ref, id, round(d, 3) AS distance_m, row_number() OVER (PARTITION BY mref ORDER BY d NULLS LAST, id) = 1 AS kept FROM d""",
)
def rank_duplicates(spark, sf):
    i = Inputs(spark, sf)
    return keyed.rank_duplicates(i.nodes, i.valid).selectExpr("ref", "id", "round(asset_distance_m, 3) AS distance_m", "kept")


_NEAR = "abs(n.lat - a.SITE_LATITUDE) < 0.0016 AND abs(n.lon - a.SITE_LONGITUDE) < 0.004"
_NODE_TO_ASSET = distance("n.lat", "n.lon", "a.SITE_LATITUDE", "a.SITE_LONGITUDE")


@query(
    "haversine_m",
    f"{ctes('managed', 'valid')} SELECT n.id, round({_NODE_TO_ASSET}, 3) AS distance_m FROM managed n JOIN valid a ON ASSET_GUID = mref",
)
def haversine(spark, sf):
    i = Inputs(spark, sf)
    pairs = keyed.managed_with_asset(i.nodes, i.valid)
    return pairs.selectExpr("id", f"round({haversine_m('lat', 'lon', *_AT_ASSET)}, 3) AS distance_m")


@query(
    "nearest_within",
    f"""{ctes('nodes', 'valid')}, e AS (SELECT n.elem_ord, a.asset_ord, {_NODE_TO_ASSET} AS d FROM nodes n JOIN valid a ON {_NEAR})
    SELECT elem_ord, asset_ord, round(d, 3) AS distance_m FROM e WHERE d <= 175
    QUALIFY row_number() OVER (PARTITION BY elem_ord ORDER BY d, asset_ord) = 1""",
)
def nearest(spark, sf):
    valid, nodes = Inputs(spark, sf).staged
    found = nearest_within(nodes, valid, 175.0, left_id="elem_ord", right_id="asset_ord", right_at=_AT_ASSET)
    return found.selectExpr("elem_ord", "asset_ord", "round(distance_m, 3) AS distance_m")


@query(
    "closest",
    f"""{ctes('nodes', 'unlinked')}, e AS (SELECT n.elem_ord, a.asset_ord, {_NODE_TO_ASSET} AS d FROM nodes n JOIN unlinked a ON {_NEAR} WHERE mref IS NULL)
    SELECT elem_ord, asset_ord, round(d, 3) AS distance_m FROM e WHERE d <= 175
    QUALIFY row_number() OVER (PARTITION BY asset_ord ORDER BY d, elem_ord) = 1""",
)
def closest(spark, sf):
    valid, nodes = Inputs(spark, sf).staged
    found = nearest_within(
        keyed.unlinked_assets(valid, nodes),
        nodes.filter("ref IS NULL"),
        175.0,
        left_id="asset_ord",
        right_id="elem_ord",
        left_at=_AT_ASSET,
    )
    return found.selectExpr("elem_ord", "asset_ord", "round(distance_m, 3) AS distance_m")


def _spark_columns(sql: str) -> list[str]:
    """Columns written for the other engine, where // divides integers and decimals are doubles."""
    plain = sql.replace("//", "div")
    return [re.sub(r"(?<![\w.])(\d+\.\d+)", r"\1D", c) for c in plain.split(", ")]


# The other engine walks the assets in order, one step of the recursion each.
CLAIMS = f"""edges AS MATERIALIZED (SELECT a.asset_ord, n.elem_ord, n.opted_out, {_NODE_TO_ASSET} AS d FROM unlinked a JOIN nodes n ON {_NEAR}
  WHERE n.mref IS NULL AND n.aed_only AND {_NODE_TO_ASSET} <= 175),
choices AS MATERIALIZED (SELECT asset_ord, row_number() OVER (ORDER BY asset_ord) AS i, list({{'e': elem_ord, 'o': opted_out, 'd': d}} ORDER BY d, elem_ord) AS c FROM edges GROUP BY asset_ord),
walk(i, asset_ord, taken, pick) AS (
  SELECT CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST([] AS BIGINT[]), CAST(NULL AS STRUCT(e BIGINT, o BOOLEAN, d DOUBLE))
  UNION ALL
  SELECT i, asset_ord, CASE WHEN pick IS NOT NULL AND NOT pick.o THEN list_append(taken, pick.e) ELSE taken END, pick FROM (
    SELECT c.i, c.asset_ord, w.taken, list_filter(c.c, lambda x: NOT list_contains(w.taken, x.e))[1] AS pick FROM walk w JOIN choices c ON c.i = w.i + 1)),
claims AS MATERIALIZED (SELECT asset_ord, pick.e AS elem_ord, CASE WHEN pick.o THEN 'opted_out' ELSE 'claimed' END AS outcome, pick.d AS d FROM walk WHERE pick IS NOT NULL),
mixed AS MATERIALIZED (SELECT DISTINCT a.asset_ord FROM unlinked a JOIN nodes n ON {_NEAR} WHERE n.mref IS NULL AND NOT n.aed_only AND {_NODE_TO_ASSET} <= 175)"""


@query(
    "greedy_claim",
    f"{ctes('unlinked', 'nodes', recursive=True)}, {CLAIMS} SELECT asset_ord, elem_ord, outcome, round(d, 3) AS distance_m FROM claims",
)
def claim(spark, sf):
    valid, nodes = Inputs(spark, sf).staged
    assets = keyed.unlinked_assets(valid, nodes).selectExpr("asset_ord", "SITE_LATITUDE AS lat", "SITE_LONGITUDE AS lon")
    found = greedy_claim(assets, nodes.filter("ref IS NULL AND aed_only"), 175.0)
    return found.selectExpr("asset_ord", "elem_ord", "outcome", "round(distance_m, 3) AS distance_m")


def _walk_sql(edges: str) -> str:
    """Assets of each group one after the other, one step of the recursion for all groups."""
    return f"""{edges},
choices AS MATERIALIZED (SELECT g, asset_ord, row_number() OVER (PARTITION BY g ORDER BY asset_ord) AS i, list({{'e': elem_ord, 'd': d}} ORDER BY d, elem_ord) AS c FROM edges GROUP BY g, asset_ord),
walk(g, i, asset_ord, taken, pick) AS (
  SELECT DISTINCT g, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST([] AS BIGINT[]), CAST(NULL AS STRUCT(e BIGINT, d DOUBLE)) FROM choices
  UNION ALL
  SELECT g, i, asset_ord, CASE WHEN pick IS NOT NULL THEN list_append(taken, pick.e) ELSE taken END, pick FROM (
    SELECT c.g, c.i, c.asset_ord, w.taken, list_filter(c.c, lambda x: NOT list_contains(w.taken, x.e))[1] AS pick FROM walk w JOIN choices c ON c.g = w.g AND c.i = w.i + 1))
SELECT asset_ord, pick.e AS elem_ord, 'claimed' AS outcome, round(pick.d, 3) AS distance_m FROM walk WHERE pick IS NOT NULL"""


# Streets of 100 customers, 100 m apart: each stands nearest to the node that its predecessor must fall back on.
_STREET_ASSETS = "c_custkey AS asset_ord, 60 + (c_custkey // 100) * 0.01 AS lat, 10 + ((c_custkey % 100) - CASE WHEN c_custkey % 100 > 0 THEN 0.6 ELSE 0 END) * 0.0018 AS lon"
_STREET_NODES = "c_custkey AS elem_ord, 60 + (c_custkey // 100) * 0.01 AS lat, 10 + (c_custkey % 100) * 0.0018 AS lon"
_PAIR = distance("n.lat", "n.lon", "a.lat", "a.lon")


@query(
    "greedy_claim_chain",
    f"""WITH RECURSIVE a AS (SELECT c_custkey // 100 AS g, {_STREET_ASSETS} FROM customer), n AS (SELECT c_custkey // 100 AS g, {_STREET_NODES} FROM customer),
    {_walk_sql(f"edges AS MATERIALIZED (SELECT a.g, asset_ord, elem_ord, {_PAIR} AS d FROM a JOIN n ON a.g = n.g WHERE {_PAIR} <= 175)")}""",
)
def claim_chain(spark, sf):
    customers = Inputs(spark, sf).table("customer")
    assets = materialized(customers.selectExpr(*_spark_columns(_STREET_ASSETS)), "assets")
    nodes = materialized(customers.selectExpr(*_spark_columns(_STREET_NODES), "false AS opted_out"), "nodes")
    found = greedy_claim(assets, nodes, 175.0)
    return found.selectExpr("asset_ord", "elem_ord", "outcome", "round(distance_m, 3) AS distance_m")


# Crowds of 400 customers and 400 parts, each within one cell of the grid.
_CROWD_ASSETS = "c_custkey AS asset_ord, 60 + (c_custkey // 400) * 0.1 + (c_custkey * 7919 % 10007) * 0.00000005 AS lat, 10 + (c_custkey * 104729 % 9973) * 0.0000001 AS lon"
_CROWD_NODES = "p_partkey AS elem_ord, 60 + (p_partkey // 400) * 0.1 + (p_partkey * 15485863 % 9901) * 0.00000005 AS lat, 10 + (p_partkey * 32452843 % 9887) * 0.0000001 AS lon"


@query(
    "greedy_claim_dense",
    f"""WITH RECURSIVE a AS (SELECT c_custkey // 400 AS g, {_CROWD_ASSETS} FROM customer), n AS (SELECT p_partkey // 400 AS g, {_CROWD_NODES} FROM part),
    {_walk_sql(f"edges AS MATERIALIZED (SELECT a.g, asset_ord, elem_ord, {_PAIR} AS d FROM a JOIN n ON a.g = n.g WHERE {_PAIR} <= 175)")}""",
)
def claim_dense(spark, sf):
    i = Inputs(spark, sf)
    assets = materialized(i.table("customer").selectExpr(*_spark_columns(_CROWD_ASSETS)), "assets")
    nodes = materialized(i.table("part").selectExpr(*_spark_columns(_CROWD_NODES), "false AS opted_out"), "nodes")
    found = greedy_claim(assets, nodes, 175.0)
    return found.selectExpr("asset_ord", "elem_ord", "outcome", "round(distance_m, 3) AS distance_m")


@query("near_mixed", f"{ctes('unlinked', 'nodes', recursive=True)}, {CLAIMS} SELECT asset_ord FROM mixed")
def mixed_in_reach(spark, sf):
    valid, nodes = Inputs(spark, sf).staged
    assets = keyed.unlinked_assets(valid, nodes).selectExpr("asset_ord", "SITE_LATITUDE AS lat", "SITE_LONGITUDE AS lon")
    return near_mixed(assets, nodes.filter("ref IS NULL"), PARAMS).select("asset_ord")


@query(
    "asset_outcomes",
    f"""{ctes('unlinked', 'nodes', recursive=True)}, {CLAIMS} SELECT u.asset_ord,
    CASE WHEN c.outcome IS NOT NULL THEN c.outcome WHEN m.asset_ord IS NOT NULL THEN 'near_mixed' ELSE 'create' END AS outcome
    FROM unlinked u LEFT JOIN claims c USING (asset_ord) LEFT JOIN mixed m USING (asset_ord)""",
)
def outcomes(spark, sf):
    valid, nodes = Inputs(spark, sf).staged
    return asset_outcomes(nodes, valid, PARAMS).select("asset_ord", "outcome")


@query("ref_set", f"{ctes('refs')} SELECT mref AS ref FROM refs")
def ref_set(spark, sf):
    return keyed.ref_counts(Inputs(spark, sf).nodes).select("ref")


@query(
    "dense_ordinals",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS n FROM orders",
)
def ordinals(spark, sf):
    orders = Inputs(spark, sf).table("orders").select("o_orderkey", "o_totalprice")
    return dense_ordinals(orders, "n", ["o_totalprice", "o_orderkey"]).select("o_orderkey", "n")


@query(
    "ordinals_by_group",
    "SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice, o_orderkey) AS n FROM orders",
)
def ordinals_by_group(spark, sf):
    orders = Inputs(spark, sf).table("orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return dense_ordinals(orders, "n", ["o_totalprice", "o_orderkey"], ["o_orderstatus"]).select("o_orderkey", "n")

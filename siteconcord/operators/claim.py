"""One-to-one assignment in priority order, computed in parallel rounds.

Assets choose in the order of their ordinals, each the nearest node in range that nobody before it has taken. Since
all nodes rank the assets alike (by ordinal), this is the one stable matching, and rounds of deferred acceptance find
it: every asset proposes to its best node still open to it, each node keeps the lowest ordinal and closes to higher
ones, until nobody is turned away. A node that has opted out turns nobody away and is never taken.

Most inputs need no rounds. Occupied grid cells that can see each other make components (no edge leaves one), found from
the points alone. A component of bounded size is brought together as its points and settled by the choice one by one, so its
edges are never written or shuffled. What is left - large components, and those where an ordinal repeats or is null - goes
on in rounds.

Rounds are as many as the longest chain of refusals. If somebody is turned away after a few, the edges that are left (a
refusal is final, so the others need no second look) are split into connected components, and a component of bounded size is
settled in one pass over its edges in the order of choice. Only larger ones go on in rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteconcord.functions.geo import RadiusGrid, haversine_m, is_finite
from siteconcord.operators.components import connected
from siteconcord.operators.ordinals import dense_ordinals
from siteconcord.operators.skew import hot_keys, skew_join
from siteconcord.operators.spatial import SiteIndex
from siteconcord.session import materialized, shuffle_partitions

_OPEN = 1 << 62
# Rounds before components are looked for.
EASY_ROUNDS = 4
# Edges of a component that one pass settles; also how many pairs of a crowded cell may become edges.
FOLD_EDGES = 200_000
# Assets of a component that are settled one by one from its points: the list of their seats is copied for each.
FOLD_ASSETS = 5_000
_FACTS = ("places", "refuser", "crowded")


def _sites(nodes: DataFrame, copies: int | None) -> tuple[DataFrame, DataFrame | None]:
    """(sites, nodes of crowded positions): a site is one node, or a crowded position with `places` before an opt-out.

    Nodes behind an opted-out copy cannot be reached: whoever gets that far stops at it.
    """
    single = (
        "elem_ord AS sid",
        "lat AS slat",
        "lon AS slon",
        "1L AS places",
        "CASE WHEN opted_out THEN elem_ord END AS refuser",
        "false AS crowded",
    )
    if copies is None:
        return nodes.selectExpr(*single), None
    placed = nodes.withColumn("spot", F.expr("concat(lat, '/', lon)"))
    spots = placed.groupBy("spot").agg(
        F.expr("count(*) AS copies"),
        F.expr("min(elem_ord) AS sid"),
        F.expr("min(elem_ord) FILTER (WHERE opted_out) AS refuser"),
        F.expr("min(lat) AS slat"),
        F.expr("min(lon) AS slon"),
    )
    spots = spots.filter(f"copies > {copies}").drop("copies")
    if spots.isEmpty():
        return nodes.selectExpr(*single), None
    spots = materialized(spots, "spots")
    hot = hot_keys(placed, "spot")
    crowd = skew_join(placed, spots.select("spot", "sid", "refuser"), "spot", "inner", hot)
    reachable = materialized(crowd.filter("refuser IS NULL OR elem_ord < refuser").select("spot", "sid", "elem_ord"), "seats")
    places = reachable.groupBy("spot").agg(F.expr("count(*) AS places"))
    joint = spots.join(places, "spot", "left").selectExpr(
        "sid", "slat", "slon", "coalesce(places, 0L) AS places", "refuser", "true AS crowded"
    )
    alone = skew_join(placed, spots, "spot", "left_anti", hot).selectExpr(*single)
    return materialized(alone.unionByName(joint), "sites"), reachable.select("sid", "elem_ord")


def _bars(proposals: DataFrame, any_crowd: bool) -> DataFrame:
    """(sid, bar): the highest ordinal a full site still admits."""
    taken = proposals.filter("refuser IS NULL")
    bars = taken.filter("NOT crowded").groupBy("sid").agg(F.expr("min(asset_ord) AS bar"))
    if any_crowd:
        queue = dense_ordinals(taken.filter("crowded").select("sid", "places", "asset_ord"), "at", ["asset_ord"], ["sid"])
        bars = bars.unionByName(queue.filter("at = places").selectExpr("sid", "asset_ord AS bar"))
    return bars


# The choice one by one: `done` is the last asset settled, `taken` the nodes given away.
_STEP = """CASE WHEN s.done <=> x.asset_ord OR array_contains(s.taken, x.sid) THEN s
  WHEN x.refuser IS NOT NULL THEN named_struct('done', x.asset_ord, 'taken', s.taken, 'seats',
    concat(s.seats, array(named_struct('asset_ord', x.asset_ord, 'elem_ord', x.sid, 'distance_m', x.distance_m, 'outcome', 'opted_out'))))
  ELSE named_struct('done', x.asset_ord, 'taken', concat(s.taken, array(x.sid)), 'seats',
    concat(s.seats, array(named_struct('asset_ord', x.asset_ord, 'elem_ord', x.sid, 'distance_m', x.distance_m, 'outcome', 'claimed')))) END"""
_START = """named_struct('done', CAST(NULL AS bigint), 'taken', CAST(array() AS array<bigint>), 'seats',
  CAST(array() AS array<struct<asset_ord: bigint, elem_ord: bigint, distance_m: double, outcome: string>>))"""


def _settled(edges: DataFrame, barred: DataFrame | None, fold_edges: int) -> tuple[DataFrame, DataFrame]:
    """(seats of the components that one pass settles, edges of the others); those with an asset of `barred` (pid) are others."""
    nodes = edges.selectExpr("shiftleft(asset_ord, 1) AS u", "shiftleft(sid, 1) + 1 AS v")
    comps = materialized(connected(nodes), "components")
    placed = edges.withColumn("node", F.expr("shiftleft(asset_ord, 1)")).join(comps, "node").drop("node")
    placed = materialized(placed, "edges")
    large = placed.groupBy("comp").agg(F.count(F.lit(1)).alias("n")).filter(f"n > {fold_edges}").select("comp")
    if barred is not None:
        of_barred = comps.join(barred.selectExpr("shiftleft(pid, 1) AS node").distinct(), "node", "left_semi").select("comp")
        large = large.unionByName(of_barred).distinct()
    large = materialized(large, "large")
    small = placed.join(large, "comp", "left_anti").groupBy("comp")
    listed = small.agg(F.expr("array_sort(collect_list(struct(asset_ord, distance_m, sid, refuser))) AS e"))
    seats = listed.select(F.expr(f"inline(aggregate(e, {_START}, (s, x) -> {_STEP}, s -> s.seats))"))
    # As many edges as there are in large components: these may be most of the table.
    rest = placed.join(large, "comp", "left_semi").drop("comp")
    return materialized(seats, "seats"), materialized(rest, "edges")


# The same from points: `open` are the nodes not given away. The nearest is looked for once per asset.
_NEAREST = """array_min(filter(transform(s.open, n -> named_struct('distance_m', {distance}, 'sid', n.sid, 'refuser', n.refuser)), c -> c.distance_m <= {radius}D))"""
_CHOOSE = """transform(array({nearest}), b -> CASE WHEN b IS NULL THEN s ELSE named_struct(
    'open', CASE WHEN b.refuser IS NULL THEN filter(s.open, n -> n.sid <> b.sid) ELSE s.open END,
    'seats', concat(s.seats, array(named_struct('asset_ord', x.pid, 'elem_ord', b.sid, 'distance_m', b.distance_m,
      'outcome', CASE WHEN b.refuser IS NULL THEN 'claimed' ELSE 'opted_out' END)))) END)[0]"""
_UNSEATED = """named_struct('open', nodes, 'seats',
  CAST(array() AS array<struct<asset_ord: bigint, elem_ord: bigint, distance_m: double, outcome: string>>))"""


def _by_cells(points: DataFrame, sites: DataFrame, radius_m: float) -> DataFrame:
    """Points and sites in one table, with comp: the component of grid cells that can see each other, which no edge leaves."""
    grid = RadiusGrid(radius_m)
    own = grid.with_cell(points, "plat", "plon", "own")
    held = grid.with_cell(sites, "slat", "slon", "own")
    seen = grid.with_neighbourhood(own, "plat", "plon").select("own", "cell").distinct()
    links = seen.join(held.selectExpr("own AS cell").distinct(), "cell").selectExpr("own AS u", "cell AS v")
    comps = materialized(connected(links).withColumnRenamed("node", "own"), "components")
    rows = own.withColumn("is_asset", F.lit(True)).unionByName(held.withColumn("is_asset", F.lit(False)), allowMissingColumns=True)
    rows = skew_join(rows, comps, "own", "left", hot_keys(rows, "own"))
    return materialized(rows.withColumn("comp", F.expr("coalesce(comp, own)")).drop("own"), "placed")


def _settled_by_points(
    points: DataFrame, sites: DataFrame, radius_m: float, fold_edges: int
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """(seats of the small components, points and sites of the others or None): small ones have at most `fold_edges` pairs."""
    placed = _by_cells(points, sites, radius_m)
    sizes = placed.groupBy("comp").agg(F.expr("count_if(is_asset) AS assets"), F.expr("count_if(NOT is_asset) AS sites"))
    sizes = materialized(sizes.filter("assets > 0 AND sites > 0"), "sizes")
    small = sizes.filter(f"double(assets) * sites <= {fold_edges} AND assets <= {FOLD_ASSETS}").select("comp")
    key = placed.withColumn("key", F.expr("CASE WHEN is_asset THEN pid ELSE sid END"))
    repeated = key.groupBy("is_asset", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR key IS NULL")
    repeated = materialized(repeated.selectExpr("is_asset AS of_asset", "key AS again"), "repeated")
    if not repeated.isEmpty():
        same = F.expr("is_asset = of_asset AND key <=> again")
        small = small.join(key.join(repeated, same, "left_semi").select("comp").distinct(), "comp", "left_anti")
    small = materialized(small, "small")
    hot = hot_keys(placed, "comp")
    # A number of partitions of its own: the rows are few bytes but much work.
    rows = skew_join(placed, small, "comp", "left_semi", hot).repartition(shuffle_partitions(placed.sparkSession), "comp")
    listed = rows.groupBy("comp").agg(
        F.expr("array_sort(collect_list(struct(pid, plat, plon)) FILTER (WHERE is_asset)) AS assets"),
        F.expr("collect_list(struct(sid, slat, slon, refuser)) FILTER (WHERE NOT is_asset) AS nodes"),
    )
    distance = haversine_m("x.plat", "x.plon", "n.slat", "n.slon")
    step = _CHOOSE.format(nearest=_NEAREST.format(distance=distance, radius=repr(float(radius_m))))
    seats = materialized(listed.selectExpr(f"inline(aggregate(assets, {_UNSEATED}, (s, x) -> {step}, s -> s.seats))"), "seats")
    large = materialized(sizes.join(small, "comp", "left_anti").select("comp"), "large")
    if large.isEmpty():
        return seats, None, None
    rest = materialized(skew_join(placed, large, "comp", "left_semi", hot), "rest")
    return seats, rest.filter("is_asset").select(points.columns), rest.filter("NOT is_asset").select(sites.columns)


def greedy_claim(
    assets: DataFrame,
    nodes: DataFrame,
    radius_m: float,
    *,
    dense_cell: int | None = None,
    copies: int | None = None,
    fold_edges: int = FOLD_EDGES,
) -> DataFrame:
    """(asset_ord, elem_ord, distance_m, outcome) with outcome 'claimed' or 'opted_out'; assets left without are absent.

    `assets` has asset_ord, lat, lon; `nodes` has elem_ord, lat, lon, opted_out. Ties in distance go to the lower
    elem_ord. With `copies`, more nodes than that at one position are handled as one site with as many places, which saves
    rounds; a tie in distance between such a position and another node then goes by the position's lowest elem_ord.
    Components of more than `fold_edges` edges, and all if `copies` is given, are settled in rounds. With `dense_cell`, the
    nodes of a cell that is dense, nothing is settled before the rounds.
    """
    placed = f"{is_finite('lat')} AND {is_finite('lon')}"
    points = assets.filter(placed).selectExpr("asset_ord AS pid", "lat AS plat", "lon AS plon")
    sites, crowd = _sites(nodes.filter(placed), copies)
    early = None
    if copies is None and dense_cell is None:
        early, points, sites = _settled_by_points(points, sites, radius_m, fold_edges)
        if points is None:
            return early
    found = _in_rounds(points, sites, crowd, radius_m, dense_cell, fold_edges)
    return found if early is None else early.unionByName(found)


def _in_rounds(
    points: DataFrame, sites: DataFrame, crowd: DataFrame | None, radius_m: float, dense_cell: int | None, fold_edges: int
) -> DataFrame:
    """The choice in rounds over edges and dense cells, by components once it takes more than a few."""
    sites = sites.withColumn("top", F.lit(_OPEN))
    index = SiteIndex(sites, radius_m, dense_cell, points if dense_cell is None else None, fold_edges)
    edges = index.sparse_pairs(points).selectExpr("pid AS asset_ord", "sid", "distance_m", *_FACTS)
    edges = materialized(edges, "edges")
    hot_sites = hot_keys(edges, "sid")
    left = edges.count()
    dense = materialized(index.dense, "dense") if index.has_dense else None
    dense_points = materialized(index.dense_points(points), "points") if index.has_dense else None
    rounds, seats = 0, None

    while True:
        best = edges.groupBy("asset_ord").agg(F.expr(f"min(struct(distance_m, sid, {', '.join(_FACTS)})) AS best"))
        if dense is not None:
            best = _with_dense(best, index, dense_points, dense, radius_m)
        proposals = best.select("asset_ord", "best.*")
        if crowd is not None or dense is not None:
            proposals = materialized(proposals, "proposals")
        bars = _bars(proposals, crowd is not None)
        if crowd is not None or dense is not None:
            bars = materialized(bars, "bars")
        kept = skew_join(edges, bars, "sid", "left", hot_sites)
        kept = materialized(kept.filter("bar IS NULL OR asset_ord <= bar").drop("bar"), "edges")
        remaining, closed = kept.count(), 0
        if dense is not None:
            limited = dense.join(bars, "sid", "left").withColumn("was", F.col("top"))
            limited = limited.withColumn("top", F.expr("least(top, bar + 1)")).drop("bar")
            limited = materialized(limited, "dense")
            closed = limited.filter("top < was").count()
            dense = limited.drop("was")
        edges = kept
        if remaining == left and not closed:
            break
        left, rounds = remaining, rounds + 1
        if rounds == EASY_ROUNDS and crowd is None:
            seats, edges = _settled(edges, dense_points, fold_edges)
            left = edges.count()
            if dense is None and not left:
                return seats
    return _seats(proposals, crowd) if seats is None else seats.unionByName(_seats(proposals, crowd))


def _with_dense(best: DataFrame, index: SiteIndex, points: DataFrame, dense: DataFrame, radius_m: float) -> DataFrame:
    """Each asset's best over sparse edges and dense cells; the sparse distance limits the dense search."""
    so_far = best.selectExpr("asset_ord AS pid", "best.distance_m AS limit_m")
    crowd = points.join(so_far, "pid", "left").selectExpr(
        "pid", "plat", "plon", "pid AS floor", f"coalesce(limit_m, {float(radius_m)!r}D) AS limit_m"
    )
    found = index.dense_nearest(crowd, dense).selectExpr("pid AS asset_ord", "best.distance_m", "best.sid")
    # A site may be the best of very many assets.
    facts = skew_join(found, dense.select("sid", *_FACTS), "sid", "inner", hot_keys(found, "sid"))
    found = facts.selectExpr("asset_ord", f"struct(distance_m, sid, {', '.join(_FACTS)}) AS best")
    return best.unionByName(found).groupBy("asset_ord").agg(F.expr("min(best) AS best"))


def _seats(proposals: DataFrame, crowd: DataFrame | None) -> DataFrame:
    """From sites to nodes: in a crowded position the n-th asset gets the n-th node, those behind meet the opt-out."""
    singles = proposals.filter("NOT crowded").selectExpr(
        "asset_ord", "sid AS elem_ord", "distance_m", "CASE WHEN refuser IS NULL THEN 'claimed' ELSE 'opted_out' END AS outcome"
    )
    if crowd is None:
        return singles
    queue = dense_ordinals(proposals.filter("crowded"), "at", ["asset_ord"], ["sid"])
    seats = dense_ordinals(crowd, "at", ["elem_ord"], ["sid"])
    seated = queue.join(seats, ["sid", "at"], "left").selectExpr(
        "asset_ord",
        "coalesce(elem_ord, refuser) AS elem_ord",
        "distance_m",
        "CASE WHEN elem_ord IS NOT NULL THEN 'claimed' ELSE 'opted_out' END AS outcome",
    )
    return singles.unionByName(seated)

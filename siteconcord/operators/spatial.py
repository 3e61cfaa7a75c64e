"""Nearest neighbour within a radius, as a grid join that never pairs up whole crowded cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteconcord.functions.geo import RadiusGrid, haversine_m, is_finite
from siteconcord.operators.skew import hot_keys, skew_join
from siteconcord.session import materialized

# A cell with more sites than this is searched part by part instead of pairing each probe with all of them.
DENSE_CELL = 256
# Each refinement cuts a cell's part into SPLITS x SPLITS; six of them take 175 m down to about 4 cm, where positions
# given in 1e-7 degrees leave at most a few dozen. Refining ends earlier when no part holds more than LEAF sites.
SPLITS = 4
REFINEMENTS = 6
LEAF = 16
# Hot cells meet up to DENSE_CELL rows each, so fewer of them are broadcast.
MOST_HOT_CELLS = 1_000

_TO_SITE = haversine_m("plat", "plon", "slat", "slon")


class SiteIndex:
    """Sites (sid, slat, slon, top, ...) by grid cell, split into sparse cells and dense ones.

    `top` limits who may take a site: a probe with floor < top. With top = 1 and floor = 0 every site is open to
    every probe. With `points`, a cell whose probes make no more than `pairs` pairs with its sites is sparse too.
    """

    def __init__(self, sites: DataFrame, radius_m: float, dense_cell: int | None = None, points: DataFrame | None = None, pairs: int = 0):
        self.grid = RadiusGrid(radius_m)
        self.radius_m = radius_m
        placed = self.grid.with_cell(sites, "slat", "slon")
        limit = DENSE_CELL if dense_cell is None else dense_cell
        crowded = placed.groupBy("cell").count().filter(f"count > {limit}")
        if points is not None and not crowded.isEmpty():
            seen = self.probes(points).groupBy("cell").agg(F.expr("count(*) AS seen"))
            crowded = crowded.join(seen, "cell").filter(f"count * seen > {pairs}")
        crowded = crowded.select("cell")
        self.has_dense = not crowded.isEmpty()
        self.sparse, self.dense, self.dense_cells = placed, None, None
        if self.has_dense:
            hot = hot_keys(placed, "cell", most=MOST_HOT_CELLS)
            self.dense_cells = materialized(crowded, "dense-cells")
            self.sparse = skew_join(placed, self.dense_cells, "cell", "left_anti", hot)
            self.dense = skew_join(placed, self.dense_cells, "cell", "left_semi", hot)

    def probes(self, points: DataFrame) -> DataFrame:
        """Points (pid, plat, plon, ...) once per cell they can see."""
        return self.grid.with_neighbourhood(points, "plat", "plon")

    def hot_probe_cells(self, points: DataFrame) -> list:
        """Cells seen by very many points; found from one row per point, not nine."""
        own = self.grid.with_cell(points, "plat", "plon", "own")
        crowded = hot_keys(own, "own", most=MOST_HOT_CELLS)
        if not crowded:
            return []
        seen = self.probes(own.filter(F.col("own").isin(crowded))).select("cell").distinct()
        return [row[0] for row in seen.limit(9 * MOST_HOT_CELLS).collect()]

    def sparse_pairs(self, points: DataFrame) -> DataFrame:
        """Pairs within the radius between points and sites of sparse cells, with distance_m; few per point."""
        pairs = skew_join(self.probes(points), self.sparse, "cell", "inner", self.hot_probe_cells(points))
        return pairs.withColumn("distance_m", F.expr(_TO_SITE)).filter(f"distance_m <= {self.radius_m!r}D")

    def dense_probes(self, points: DataFrame) -> DataFrame:
        """Points once per dense cell they can see."""
        return skew_join(self.probes(points), self.dense_cells, "cell", "left_semi", self.hot_probe_cells(points))

    def dense_points(self, points: DataFrame) -> DataFrame:
        return self.dense_probes(points).drop("cell").distinct()

    def dense_nearest(self, points: DataFrame, sites: DataFrame | None = None) -> DataFrame:
        """(pid, best struct(distance_m, sid)) among dense sites with top > floor and distance <= limit_m.

        `points` has pid, plat, plon, floor, limit_m. Dense cells are refined level by level. A part is summed up by
        one open site: its distance bounds the answer from above, and less the part's span from below. Parts that
        cannot hold the answer are dropped, so a point meets a bounded number of rows per level however many sites
        a cell holds.
        """
        sites = self.dense if sites is None else sites
        splits = {f"part_{k}": SPLITS**k for k in range(1, REFINEMENTS + 1)}
        sites = self.grid.with_parts(sites, "slat", "slon", splits).withColumn("part_0", F.lit(0))
        sites = materialized(sites, "parts")
        # Each level of the search is written out: it is used for its hot keys and for the join.
        frontier = self.dense_probes(points).withColumn("key", F.expr("concat(cell, '/0')"))
        frontier = materialized(frontier, "frontier")
        depth, largest = 0, LEAF + 1
        while depth < REFINEMENTS and largest > LEAF:
            depth += 1
            parts = sites.groupBy(
                F.expr(f"concat(cell, '/', part_{depth - 1}) AS key"), F.expr(f"concat(cell, '/', part_{depth}) AS next")
            ).agg(F.expr("count(*) AS n"), F.expr("max(top) AS top"), F.expr("max_by(struct(slat, slon), top) AS rep"))
            largest = parts.selectExpr("max(n)").first()[0]
            hot = hot_keys(frontier, "key", most=MOST_HOT_CELLS)
            seen = skew_join(frontier, parts, "key", "inner", hot).filter("top > floor")
            to_rep = haversine_m("plat", "plon", "rep.slat", "rep.slon")
            # A bounded number of rows per point and level: the parts of the few that could not be ruled out before.
            bounded = seen.withColumn("to_rep", F.expr(to_rep)).withColumn(
                "bound", F.expr("least(limit_m, min(to_rep) OVER (PARTITION BY pid))")
            )
            span = self.grid.part_span_m("cell", SPLITS**depth)
            kept = bounded.filter(f"to_rep - {span} <= bound").drop("key", "n", "top", "rep", "to_rep", "limit_m")
            # The bound goes on to the next level.
            frontier = materialized(kept.withColumnsRenamed({"next": "key", "bound": "limit_m"}), "frontier")
        leaves = sites.selectExpr("sid", "slat", "slon", "top", f"concat(cell, '/', part_{depth}) AS key")
        hot = hot_keys(frontier, "key", most=MOST_HOT_CELLS)
        pairs = skew_join(frontier, leaves, "key", "inner", hot).filter("top > floor")
        pairs = pairs.withColumn("distance_m", F.expr(_TO_SITE)).filter("distance_m <= limit_m")
        return pairs.groupBy("pid").agg(F.expr("min(struct(distance_m, sid)) AS best"))


def nearest_within(
    left: DataFrame,
    right: DataFrame,
    radius_m: float,
    *,
    left_id: str,
    right_id: str,
    left_at: tuple[str, str] = ("lat", "lon"),
    right_at: tuple[str, str] = ("lat", "lon"),
    dense_cell: int | None = None,
) -> DataFrame:
    """(left_id, right_id, distance_m): for each left row the nearest right row within the radius, ties to the least id.

    Left rows without one are absent. Right rows at one position are first reduced to the one with the least id,
    which is the only one a nearest search can return.
    """
    sites = (
        right.filter(f"{is_finite(right_at[0])} AND {is_finite(right_at[1])}")
        .groupBy(F.expr(f"{right_at[0]} AS slat"), F.expr(f"{right_at[1]} AS slon"))
        .agg(F.expr(f"min({right_id}) AS sid"))
        .withColumn("top", F.lit(1))
    )
    points = left.filter(f"{is_finite(left_at[0])} AND {is_finite(left_at[1])}").selectExpr(
        f"{left_id} AS pid", f"{left_at[0]} AS plat", f"{left_at[1]} AS plon"
    )
    index = SiteIndex(sites, radius_m, dense_cell)
    best = index.sparse_pairs(points).groupBy("pid").agg(F.expr("min(struct(distance_m, sid)) AS best"))
    if index.has_dense:
        crowd = points.selectExpr("*", "0 AS floor", f"{float(radius_m)!r}D AS limit_m")
        both = best.unionByName(index.dense_nearest(crowd))
        best = both.groupBy("pid").agg(F.expr("min(best) AS best"))
    return best.selectExpr(f"pid AS {left_id}", f"best.sid AS {right_id}", "best.distance_m")

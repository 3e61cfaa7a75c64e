"""Connected components of an edge table, in a logarithmic number of rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteconcord.session import materialized


def connected(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node on an edge (u, v) of long ids: comp is the least node that can be reached.

    Each round hangs a node's greater neighbours on its least one, then all that are left on theirs, so that paths halve.
    It ends when every node hangs on the least of its component; both steps are a minimum per node and a join.
    """
    links = edges.selectExpr("greatest(u, v) AS u", "least(u, v) AS v").filter("u <> v").distinct()
    links = materialized(links, "links")
    state = None
    while True:
        both = links.unionByName(links.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        hung = both.join(least, "u").filter("v > u").selectExpr("v AS u", "least(m, u) AS v").distinct()
        hung = materialized(hung, "hung")
        least = hung.groupBy("u").agg(F.min("v").alias("m"))
        met = hung.join(least, "u")
        links = met.filter("v <> m").selectExpr("v AS u", "m AS v").unionByName(met.selectExpr("u", "m AS v")).distinct()
        links = materialized(links, "links")
        now = tuple(links.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())
        if now == state:
            break
        state = now
    comps = links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("comp"))
    return comps.unionByName(links.selectExpr("v AS node", "v AS comp").distinct())

"""Dense numbering of rows without gathering them in one partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteconcord.session import materialized


def dense_ordinals(df: DataFrame, name: str, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Add the 1-based position of each row in `order` (which must be unique) within the groups of `by`.

    The rows are range-partitioned once and written with their partition number. Positions inside a partition come
    from a window over that partition only; the sum of the counts of earlier partitions is added. So a group of any
    size is spread over many tasks.
    """
    by, order = list(by), list(order)
    spread = df.repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id())
    spread = materialized(spread, "ordinals")
    inside = f"row_number() OVER (PARTITION BY {', '.join(['_part', *by])} ORDER BY {', '.join(order)}) AS _at"
    # One row per partition and group.
    counts = spread.groupBy("_part", *by).count()
    groups = f"PARTITION BY {', '.join(by)} " if by else ""
    earlier = f"sum(count) OVER ({groups}ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    offsets = counts.selectExpr(*[f"{c} AS _{c}" for c in ["_part", *by]], f"coalesce({earlier}, 0) AS _before")
    if not by:
        # As many rows as partitions, a bound set by the session.
        offsets = F.broadcast(offsets)
    same = " AND ".join(f"{c} <=> _{c}" for c in ["_part", *by])
    joined = spread.selectExpr("*", inside).join(offsets, F.expr(same))
    kept = [c for c in df.columns if c != name]
    return joined.select(*kept, F.expr(f"bigint(_before + _at) AS {name}"))

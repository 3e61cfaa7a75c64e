"""Joins that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteconcord.session import materialized

HOT_ROWS = 1_000_000
MOST_HOT_KEYS = 10_000


def hot_keys(df: DataFrame, key: str, rows: int | None = None, most: int = MOST_HOT_KEYS) -> list:
    """The most frequent keys with more than `rows` rows, at most `most` of them.

    Counted with map-side pre-aggregation; only the bounded list reaches the driver. A key beyond the list holds
    less than 1 / most of all rows, so an ordinary shuffle can carry it.
    """
    counts = df.filter(f"{key} IS NOT NULL").groupBy(key).count()
    hot = counts.filter(f"count > {HOT_ROWS if rows is None else rows}").orderBy(F.desc("count"), key).limit(most)
    return [row[0] for row in hot.collect()]


def skew_join(left: DataFrame, right: DataFrame, key: str, how: str, hot: list) -> DataFrame:
    """Join on one key, where `right` has a bounded number of rows per key and `hot` lists the left's hot keys.

    Rows of hot keys stay where they are and meet a broadcast of the right rows with those keys (bounded by the
    length of the list); all others are joined by an ordinary shuffle. Without hot keys it is a plain join.
    """
    existence = how in ("left_semi", "left_anti")
    if existence:
        right = right.select(key)
    if not hot:
        return left.join(right, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    hot_right = right.filter(is_hot)
    if existence:
        hot_right = hot_right.distinct()
    spread = left.filter(~is_hot).join(right.filter(~is_hot), key, how)
    return spread.unionByName(left.filter(is_hot).join(F.broadcast(hot_right), key, how))


def fanned_join(left: DataFrame, right: DataFrame, key: str, per: int = HOT_ROWS, how: str = "inner") -> DataFrame:
    """Join on one key, with `left` (a written table: it is read twice) split by need and `right` copied by need.

    A key with more than `per` rows on the left gets one salt for each `per` rows; its left rows are dealt over the
    salts by a hash of the row, its right rows are there once per salt. No list of keys reaches the driver and no number of
    hot keys is assumed: counts are pre-aggregated, and only keys above `per` are kept of them. They are broadcast if they
    are few, so that the left is shuffled once; without any it is a plain join.
    """
    existence = how in ("left_semi", "left_anti")
    right = right.select(key) if existence else right
    many = left.filter(f"{key} IS NOT NULL").groupBy(key).count().filter(f"count > {per}")
    fans = materialized(many.selectExpr(key, f"int((count + {per - 1}) div {per}) AS _fan"), "fans")
    known = fans.limit(MOST_HOT_KEYS + 1).count()
    if not known:
        return left.join(right, key, how)
    if known <= MOST_HOT_KEYS:
        fans = F.broadcast(fans)
    dealt = left.join(fans, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.coalesce("_fan", F.lit(1))).cast("int"))
    copied = right.join(fans, key, "left").withColumn("_salt", F.explode(F.expr("sequence(0, coalesce(_fan, 1) - 1)")))
    return dealt.drop("_fan").join(copied.drop("_fan"), [key, "_salt"], how).drop("_salt")

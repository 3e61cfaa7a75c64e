"""Pieces several operators share: words, bindings, broadcasts of checked size, tables read by name."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the query contracts: what separates words.
ALNUM_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SPACE_BREAK = r"[\x20\x09-\x0D]+"

# Rows of a side that may be broadcast; beyond it the join is shuffled.
BROADCAST_ROWS = 400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def words(text: Column, separator: str) -> Column:
    """The words of a text in order; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separator), "")


def alnum_words(text: Column) -> Column:
    return words(lower_ascii(text), ALNUM_BREAK)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row, also where the body names it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The rows with a broadcast hint if they are few enough, else as they are. Counts them: pass a written table."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df

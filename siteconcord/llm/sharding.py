"""Sharding by histogram sort: splitters by exact byte counts, then one exchange.

Each row gets a 62-bit sort key: 38 bits of its text's hash, then 24 bits of a hash of the row, so equal texts lie side by
side and a group of copies of any size can still be cut. The key space is probed by counting, across all partitions, the
exact bytes in each of 4,096 equal parts; the part that holds a wanted splitter is probed again in 4,096 parts, until every
splitter is off by less than the tolerance or the key's bits are used up. A round sends one row per part and splitter to
the driver, however large the input. Then the narrow rows are exchanged once, by range of (shard, key), and numbered.

The law is `bytes`: the shards' sizes are near equal, whatever the number of rows or copies in them.

Defined cases: null text has no bytes (size 8, crc32 of nothing); empty tables give empty shards; equal rows are rows of
their own, with slots of their own; fewer rows than shards leave shards empty; other columns stay with `write_shards`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteconcord.operators.ordinals import dense_ordinals
from siteconcord.session import materialized

SHARDS = 24
ROW_BYTES = 8
# Tolerance of a splitter, as a part of one shard's bytes.
TOLERANCE = 0.001
KEY_BITS = 62
_TEXT_BITS = 38
_PROBE_BITS = 12


def sort_key() -> Column:
    """Copies of a text share the high bits; the low bits tell its rows apart."""
    of_text = F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 64 - _TEXT_BITS)
    of_row = F.shiftrightunsigned(F.xxhash64("doc_id", "uid"), 64 - (KEY_BITS - _TEXT_BITS))
    return F.shiftleft(of_text, KEY_BITS - _TEXT_BITS) + of_row


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, uid, size, text_crc32, key): the narrow table all counting works on, written once."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("uid"))
    narrow = rows.select(
        "doc_id",
        "uid",
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        sort_key().alias("key"),
    )
    return materialized(narrow, "sized")


def splitters(keyed: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> list[int]:
    """`shards` - 1 keys: shard i begins at splitter i - 1. `keyed` has key and size."""
    total = keyed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    # Per splitter: bytes wanted below it, and the part [low, low + 2^bits) it lies in with the exact bytes below low.
    wanted = [total * i // shards for i in range(1, shards)]
    parts = {0: 0}
    inside = dict.fromkeys(range(len(wanted)), 0)
    found: dict[int, int] = {}
    slack, bits = total / shards * tolerance, KEY_BITS
    while inside:
        step = min(_PROBE_BITS, bits)
        narrower = bits - step
        high = F.shiftright("key", bits)
        rows = keyed if bits == KEY_BITS else keyed.filter(high.isin([low >> bits for low in parts]))
        counted = rows.groupBy(F.shiftright("key", narrower).alias("part")).agg(F.sum("size").alias("bytes")).collect()
        bytes_of: dict[int, list[tuple[int, int]]] = {low: [] for low in parts}
        for row in counted:
            bytes_of[row["part"] >> step << bits].append((row["part"] << narrower, row["bytes"]))
        refined: dict[int, int] = {}
        still: dict[int, int] = {}
        for number, low in inside.items():
            below, chosen = parts[low], low + (1 << bits)
            for start, held in sorted(bytes_of[low]):
                if below + held > wanted[number]:
                    chosen = start
                    break
                below += held
            else:
                held = 0
            if narrower == 0 or wanted[number] - below <= slack or held == 0:
                found[number] = chosen
            elif below + held - wanted[number] <= slack:
                found[number] = chosen + (1 << narrower)
            else:
                refined[chosen], still[number] = below, chosen
        parts, inside, bits = refined, still, narrower
    return [found[i] for i in range(len(wanted))]


def shard_of(key: Column, cuts: list[int]) -> Column:
    """How many splitters the key has reached."""
    if not cuts:
        return F.lit(0)
    return F.aggregate(F.array(*[F.lit(c) for c in cuts]), F.lit(0), lambda n, c: n + F.when(key >= c, 1).otherwise(0))


def shards(docs: DataFrame, count: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per row of `docs` (doc_id, text): its size, crc32, shard and gapless slot from 0 within the shard."""
    keyed = sized(docs)
    cuts = splitters(keyed, count, tolerance)
    placed = keyed.withColumn("shard", shard_of(F.col("key"), cuts).cast("int"))
    numbered = dense_ordinals(placed, "place", ["key", "doc_id", "uid"], ["shard"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("place") - 1).alias("slot"))


def write_shards(docs: DataFrame, folder: str, count: int = SHARDS, tolerance: float = TOLERANCE) -> None:
    """The documents themselves, with all their columns, as one folder per shard: texts move once.

    The folders are named by `shard`, or `shard_of` and so on if a column of `docs` has that name.
    """
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text", F.monotonically_increasing_id().alias("uid"))
    keyed = materialized(rows.select("row", sort_key().alias("key")), "documents")
    text = F.coalesce("row.text", F.lit(""))
    cuts = splitters(keyed.select("key", (F.octet_length(text).cast("long") + ROW_BYTES).alias("size")), count, tolerance)
    by = "shard"
    while by in {c.lower() for c in docs.columns}:
        by += "_of"
    placed = keyed.withColumn("in_shard", shard_of(F.col("key"), cuts).cast("int")).repartitionByRange("in_shard", "key")
    placed.select("row.*", F.col("in_shard").alias(by)).write.partitionBy(by).parquet(folder)

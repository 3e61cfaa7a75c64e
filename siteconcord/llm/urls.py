"""URL filters: a blocked Bloom filter in front of an exact hash join.

Listed entries are keys: `host/path` prefixes of rules, and whole canonical URLs. The keys of the list set bits in a
blocked Bloom filter (blocks of 256 bits, eight bits a key), built by a distributed `bit_or` per word of the filter. Its
size follows the list up to `MOST_BLOCKS`; beyond that it passes more false hits and nothing else changes, so what is sent to
the executors has a fixed bound. Every candidate key of a URL is probed in Arrow batches; the few possible hits go through
an exact join with the list, which removes the false ones.

A rule (host, path, verdict) fits its host and all subdomains if the URL's path starts with the rule's. The longest rule
decides (host and path together, then the longer host). Without one, a URL whose canonical form is listed is blocked, any
other allowed.

Defined cases: null, empty and scheme-less URLs have an empty host and path, fit no rule and are allowed; equal rows
give a row each; empty tables and empty lists work; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siteconcord.llm.common import lower_ascii
from siteconcord.session import materialized

# Fixed values of the query contract.
RULES: tuple[tuple[str, str, str], ...] = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

BITS_A_KEY = 16
# 2^17 blocks of 32 bytes: 4 MB, the most that is ever sent to an executor.
MOST_BLOCKS = 1 << 17
_WORDS = 4  # 64-bit words in a block
_PROBES = 8


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host in lower case without `www.`, path without a closing slash or `.html`, query without tracking keys, no fragment."""
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"(/|\.html)$", "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(utm_\w+|ref)="))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(kept), "&"))).otherwise(""))


# --- the filter -------------------------------------------------------------------------------------------------------


def _bits(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block number and, per probe, the bit within the block, of 64-bit hashes."""
    h = hashes.view(np.uint64)
    block = (h >> np.uint64(32)) % np.uint64(blocks)
    low = h & np.uint64(0xFFFFFFFF)
    step = (low * np.uint64(0x9E3779B1) >> np.uint64(7)) | np.uint64(1)
    probes = np.stack([(low + np.uint64(i) * step >> np.uint64(3)) & np.uint64(255) for i in range(_PROBES)])
    return block.astype(np.int64), probes.astype(np.int64)


def build_filter(keys: DataFrame, hash_column: str, most_blocks: int = MOST_BLOCKS) -> np.ndarray:
    """Bits of all keys as words of 64; partial filters are merged word by word before anything reaches the driver."""
    rows = keys.count()
    blocks = 1
    while blocks * 256 < rows * BITS_A_KEY and blocks < most_blocks:
        blocks *= 2

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(blocks * _WORDS, np.uint64)
        for batch in batches:
            block, probes = _bits(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), blocks)
            for bit in probes:
                np.bitwise_or.at(held, block * _WORDS + (bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at].view(np.int64))], ["at", "word"])

    merged = keys.select(hash_column).mapInArrow(words, "at long, word long").groupBy("at").agg(F.expr("bit_or(word) AS word"))
    out = np.zeros(blocks * _WORDS, np.uint64)
    # At most MOST_BLOCKS * 4 rows.
    for row in merged.collect():
        out[row["at"]] = np.uint64(row["word"] & 0xFFFFFFFFFFFFFFFF)
    return out


def possible(rows: DataFrame, hash_column: str, bloom: np.ndarray) -> DataFrame:
    """The rows whose hash may be in the filter."""
    sent = rows.sparkSession.sparkContext.broadcast(bloom)
    at = rows.columns.index(hash_column)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        blocks = len(held) // _WORDS
        for batch in batches:
            block, probes = _bits(batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64), blocks)
            hit = np.ones(batch.num_rows, bool)
            for bit in probes:
                hit &= (held[block * _WORDS + (bit >> 6)] >> (bit & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            yield batch.filter(pa.array(hit))

    return rows.mapInArrow(probe, rows.schema)


# --- the verdict ------------------------------------------------------------------------------------------------------


def _rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    made = spark.createDataFrame([(h, p, v) for h, p, v in rules], "rule_host string, rule_path string, rule_verdict string")
    return made.withColumn("listed", F.concat("rule_host", "rule_path"))


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    listed: DataFrame | None = None,
    most_blocks: int = MOST_BLOCKS,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, url_listed) per row of `pages` (page_id, url).

    `listed`: a table of URLs (column url), of any size, whose canonical forms are blocked where no rule fits.
    """
    spark = pages.sparkSession
    rules = list(dict.fromkeys(rules))
    cut = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), canonical(F.col("url")).alias("canon"))
    cut = materialized(cut, "urls")

    rule_rows = _rule_table(spark, rules)
    keys = rule_rows.select(F.lit("rule").alias("kind"), F.col("listed").alias("entry"))
    if listed is not None:
        entries = listed.select(canonical(F.col("url")).alias("entry")).distinct()
        keys = keys.unionByName(entries.select(F.lit("url").alias("kind"), "entry"))
    keys = materialized(keys.distinct().withColumn("hash", F.xxhash64("kind", "entry")), "keys")
    bloom = build_filter(keys, "hash", most_blocks)

    # A URL's candidates: each suffix of its host at a dot with each length a rule's path has, and its canonical form.
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    lengths = sorted({len(p) for _, p, _ in rules})
    prefixes = F.array_compact(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]))
    pairs = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.struct(F.lit("rule").alias("kind"), F.concat(h, p).alias("entry")))))
    whole = F.array(F.struct(F.lit("url").alias("kind"), F.col("canon").alias("entry")))
    candidates = cut.filter("host <> ''").select("page_id", "url", "host", F.explode(F.concat(pairs, whole) if listed is not None else pairs).alias("c"))
    candidates = candidates.select("page_id", "url", "host", "c.kind", "c.entry", F.xxhash64("c.kind", "c.entry").alias("hash"))
    maybe = possible(candidates, "hash", bloom)
    # The exact join; a host or rule that most pages share is split by skew handling, or its rule list broadcast by size.
    hits = maybe.join(keys.select("kind", "entry"), ["kind", "entry"])
    # entry = host + path of a rule, but 'a.b' + '/c' must be cut where the rule is cut.
    named = hits.join(rule_rows.withColumn("kind", F.lit("rule")).withColumnRenamed("listed", "entry"), ["kind", "entry"], "left")
    fits = named.filter("kind = 'url' OR host = rule_host OR endswith(host, concat('.', rule_host))")
    longest = F.expr("max(struct(length(entry) AS size, length(rule_host) AS host_size, entry, rule_verdict)) FILTER (WHERE kind = 'rule') AS best")
    judged = fits.groupBy("page_id", "url").agg(longest, F.expr("bool_or(kind = 'url') AS in_list"))
    judged = judged.withColumnsRenamed({"page_id": "judged_id", "url": "judged_url"})
    joined = cut.join(judged, F.expr("page_id <=> judged_id AND url <=> judged_url"), "left")
    return joined.select(
        "page_id",
        "host",
        "path",
        F.col("best.entry").alias("rule"),
        F.expr("coalesce(best.rule_verdict, if(coalesce(in_list, false), 'block', 'allow'))").alias("verdict"),
        F.expr("coalesce(in_list, false)").alias("url_listed"),
    )

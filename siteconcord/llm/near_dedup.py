"""Near duplicates by MinHash with tensored banding, verified on whole shingle sets, as components.

A document is the set of its distinct k-word shingles. Documents link when 100 * |A and B| >= percent * |A or B|.

Banding needs one key per table, each of several minhashes. Here two collections of `m` small keys are made, each key from
`ROWS` minhashes, and the m * m tables are keyed by pairs: table (i, j) by the i-th key of the first and the j-th key of the
second collection. So 2 * m * ROWS minhashes serve m * m tables of 2 * ROWS minhashes each, about the square root of what separate
tables take. Two sets of similarity s meet in some table unless a whole collection fails, with probability at most
2 * (1 - s^ROWS)^m; `collection_size` takes the least m that keeps this below `MISS` (a millionth) at the threshold. That is the
only way a link can be lost; links that other links bridge are not even lost then.

* Equal sets are one class, represented by its smallest id; only classes are searched.
* A small key that only one class has cannot meet anything, nor can any pair made with it: only the others are combined. A
  text without relatives thus costs 2 * m rows instead of m * m.
* Candidates are compared by a sketch, one byte of each minhash: a pair of the threshold's similarity stays below `SKETCH` with
  a probability of less than 10^-9. What is left is confirmed on the full sets, by counting common members.
* Tables of many copies are not expanded into pairs. Each table first pairs its classes with the one of them that meets most others;
  verified links become components. After that only pairs of different components are looked at, and on each list nothing
  is paired inside the component that holds most of it.
* A table that is mixed even then may hold many texts that resemble, but do not link, each other. Of two sets that link, each has
  one of its n - ceil(percent * n / 100) + 1 rarest shingles among those of the other, so the classes of mixed tables are
  paired by these, which loses no link: copies with edits of their own have their own rarest shingles.

Defined cases: null, empty and blank texts have an empty set and are their own component; a text with fewer than k words is one
shingle; repeated rows are equal sets; rows that share a doc_id are one document and fall into one component; rows without a doc_id have
the component of an equal text, else null, and are kept only then; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteconcord.llm.batches import as_bytes, byte_batches, chunks
from siteconcord.llm.ngram_join import components, shingle_sets
from siteconcord.operators.skew import fanned_join
from siteconcord.session import discard, materialized

SHINGLE = 5
PERCENT = 85
# Minhashes of a small key, and the probability of missing a pair at the threshold.
ROWS = 3
MISS = 1e-6
# Least share of equal sketch bytes, of the threshold's similarity.
SKETCH = 0.7
# Pairs of one class that meet in one task.
PAIRS_PER_TASK = 1_000

_CHUNK = 1 << 20


def collection_size(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    """Small keys of a collection, so that a pair at the threshold is missed with a probability of at most `miss`."""
    fails = 1 - (percent / 100) ** rows
    return 1 if fails <= 0 else math.ceil(math.log(miss / 2) / math.log(fails))


def _constants(count: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20_240_901)
    return draw.integers(0, 1 << 63, count, np.uint64) * np.uint64(2) + np.uint64(1), draw.integers(0, 1 << 63, count, np.uint64)


def minhashes(sets: list[np.ndarray], count: int) -> np.ndarray:
    """(sets, count) least values of `count` hash functions over each set, none of which may be empty."""
    members = np.concatenate(sets).view(np.uint64)
    starts = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    factors, masks = _constants(count)
    out = np.empty((len(sets), count), np.uint64)
    for k in range(count):
        h = members ^ masks[k]
        h *= factors[k]
        h ^= h >> np.uint64(29)
        out[:, k] = np.minimum.reduceat(h, starts)
    return out


def small_keys(hashes: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each `rows` minhashes and its number."""
    parts = hashes.reshape(len(hashes), -1, rows)
    keys = np.broadcast_to(np.arange(1, parts.shape[1] + 1, dtype=np.uint64), parts.shape[:2]) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(rows):
        keys = (keys ^ parts[:, :, k]) * np.uint64(0xBF58476D1CE4E5B9)
        keys ^= keys >> np.uint64(31)
    return keys.view(np.int64)


def _lists(values: np.ndarray, some: np.ndarray) -> pa.ListArray:
    """One list for each row that has a set, an empty one for the others."""
    offsets = np.concatenate([[0], np.cumsum(np.where(some, values.shape[1], 0))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def described(docs: DataFrame, k: int, m: int, rows: int = ROWS) -> DataFrame:
    """(doc_id, n, digest, first, second, sketch): size and digest of the set, the two collections, a byte of each minhash."""
    doc_id = docs.schema["doc_id"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", _CHUNK):
                sets = shingle_sets(as_bytes(part.column("text")), k)
                some = np.array([len(s) > 0 for s in sets])
                full = [s for s in sets if len(s)]
                hashes = minhashes(full, 2 * m * rows) if full else np.zeros((0, 2 * m * rows), np.uint64)
                keys = small_keys(hashes, rows)
                columns = [
                    part.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    _lists(keys[:, :m], some),
                    _lists(keys[:, m:], some),
                    _lists(hashes.astype(np.uint8).view(np.int8), some),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "digest", "first", "second", "sketch"])

    schema = f"doc_id {doc_id}, n long, digest binary, first array<long>, second array<long>, sketch array<tinyint>"
    return docs.select("doc_id", "text").mapInArrow(make, schema)


def whole_sets(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, digest, members): the whole sets, for the texts that some candidate needs."""
    doc_id = docs.schema["doc_id"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", _CHUNK):
                sets = shingle_sets(as_bytes(part.column("text")), k)
                offsets = np.cumsum([0, *[len(s) for s in sets]]).astype(np.int32)
                members = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*sets, np.zeros(0, np.int64)])))
                digests = pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), digests, members], ["doc_id", "digest", "members"])

    return docs.select("doc_id", "text").mapInArrow(make, f"doc_id {doc_id}, digest binary, members array<long>")


class _Dedup:
    def __init__(self, docs: DataFrame, k: int, percent: int):
        self.docs, self.k, self.percent, self.m = docs, k, percent, collection_size(percent)
        self.near = f"100 * least(na, nb) >= {percent} * greatest(na, nb)"
        with byte_batches(docs.sparkSession):
            rows = materialized(described(docs, k, self.m), "described")
        self.sizes = materialized(rows.select("doc_id", "n", "digest"), "sizes")
        classes = rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("digest")
        firsts = [F.first(c).alias(c) for c in ("n", "first", "second", "sketch")]
        self.classes = materialized(classes.agg(F.min("doc_id").alias("id"), *firsts), "classes")
        discard(rows)
        self.links: DataFrame | None = None
        self.comps: DataFrame | None = None

    def shared_ids(self) -> DataFrame:
        """Links between the classes of rows that share a doc_id."""
        rows = self.sizes.filter("n > 0 AND doc_id IS NOT NULL")
        several = rows.groupBy("doc_id").agg(F.expr("min(digest) <> max(digest) AS several")).filter("several").select("doc_id")
        held = rows.join(several, "doc_id").join(self.classes.select("digest", "id"), "digest").select("doc_id", "id").distinct()
        return held.join(held.groupBy("doc_id").agg(F.min("id").alias("a")), "doc_id").filter("a <> id").selectExpr("a", "id AS b")

    def tables(self) -> DataFrame:
        """(key, id, n, met): the tables' keys that several classes have; `met` counts whom a class meets by its small keys."""
        one = self.classes.selectExpr("id", "n", "true AS of_first", "explode(first) AS x")
        two = self.classes.selectExpr("id", "n", "false AS of_first", "explode(second) AS x")
        halves = one.unionByName(two)
        several = halves.groupBy("of_first", "x").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
        sides = "array_sort(collect_list(x) FILTER (WHERE {})) AS {}"
        kept = halves.join(several, ["of_first", "x"]).groupBy("id", "n")
        kept = kept.agg(F.sum("c").alias("met"), F.expr(sides.format("of_first", "u")), F.expr(sides.format("NOT of_first", "v")))
        pairs = "flatten(transform(u, a -> transform(v, b -> xxhash64(a, b))))"
        keyed = materialized(kept.selectExpr("id", "n", "met", f"explode({pairs}) AS key"), "keyed")
        again = keyed.groupBy("key").agg(F.expr("min(id) <> max(id) AS several")).filter("several").select("key")
        found = materialized(keyed.join(again, "key"), "tables")
        discard(keyed)
        return found

    def labelled(self, rows: DataFrame) -> DataFrame:
        """Adds comp, the component so far."""
        if self.comps is None:
            return rows.withColumn("comp", F.col("id"))
        return rows.join(self.comps, "id", "left").withColumn("comp", F.expr("coalesce(comp, id)"))

    def mixed(self, tables: DataFrame) -> DataFrame:
        """The rows of tables that hold several components, with comp and of_most: whether it is the one that holds most of the table."""
        given = [c for c in tables.columns if c not in ("comp", "of_most")]
        rows = materialized(self.labelled(tables.select(*given)), "labelled")
        counts = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
        tops = counts.groupBy("key").agg(F.expr("max(struct(c, comp)).comp AS most"), F.expr("min(comp) <> max(comp) AS mixed"))
        found = rows.join(tops.filter("mixed"), "key").selectExpr(*given, "comp", "comp = most AS of_most")
        found = materialized(found, "mixed")
        discard(rows, tables)
        return found

    def star(self, rows: DataFrame) -> DataFrame:
        """Each table's classes, paired with the one that meets most others, if that is of another component."""
        first = rows.groupBy("key").agg(F.expr("min(struct(-met AS m, xxhash64(id) AS x, id, n, comp))").alias("centre"))
        met = rows.join(first, "key").filter("comp <> centre.comp")
        return met.selectExpr("centre.id AS a", "id AS b", "centre.n AS na", "n AS nb")

    def across(self, rows: DataFrame) -> DataFrame:
        """Pairs of different components that have one of their rarest members in common, and can reach the threshold from there on.

        Among the rows of the component that has most of a member's rows nothing is paired.
        """
        left = rows.filter("NOT of_most").selectExpr("key", "id AS b", "n AS nb", "comp AS cb", "at AS pb")
        right = rows.selectExpr("key", "id AS a", "n AS na", "comp AS ca", "of_most", "at AS pa")
        enough = f"{100 + self.percent}L * least(na - pa, nb - pb) >= {self.percent}L * (na + nb)"
        pairs = left.join(right, "key").filter(f"ca <> cb AND (of_most OR a < b) AND {self.near} AND {enough}")
        return pairs.select("a", "b", "na", "nb")

    def rarest(self, rows: DataFrame, members: DataFrame) -> DataFrame:
        """(key, id, n, at): the rarest members of each class in `rows`, as far as another class has them too, with their places from 0.

        A partner of a set of n holds at least percent * n / 100 of it, so it has one of the first n - ceil(that) + 1.
        """
        ids = rows.select("id", "n").distinct()
        held = materialized(members.join(ids, "id").selectExpr("id", "n", "explode(members) AS key"), "held")
        several = held.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
        known = held.join(several, "key")
        # Members that no other class has come first, unnumbered.
        place = "n - count(*) OVER (PARTITION BY id) + row_number() OVER (PARTITION BY id ORDER BY c, key) - 1 AS at"
        first = known.selectExpr("key", "id", "n", place).filter(f"at < n - ({self.percent} * n + 99) div 100 + 1")
        found = materialized(first, "rarest")
        discard(held)
        return found

    def confirmed(self, pairs: DataFrame, members: DataFrame) -> DataFrame:
        """The pairs (a, b) that link: those the sketch lets through, by the common members of their whole sets."""
        sized = materialized(pairs.filter(self.near).select("a", "b").distinct(), "pairs")
        of = lambda side: self.classes.selectExpr(f"id AS {side}", f"n AS n{side}", f"sketch AS s{side}")
        sketched = fanned_join(fanned_join(sized, of("b"), "b", PAIRS_PER_TASK), of("a"), "a", PAIRS_PER_TASK)
        least = math.floor(SKETCH * self.percent / 100 * 2 * self.m * ROWS)
        equal = "aggregate(zip_with(sa, sb, (x, y) -> int(x = y)), 0, (s, x) -> s + x)"
        likely = materialized(sketched.filter(f"{equal} >= {least}").select("a", "b", "na", "nb"), "likely")
        sets = lambda side: members.selectExpr(f"id AS {side}", f"members AS m{side}")
        met = fanned_join(fanned_join(likely, sets("b"), "b", PAIRS_PER_TASK), sets("a"), "a", PAIRS_PER_TASK)
        common = "size(array_intersect(ma, mb))"
        links = met.filter(f"{100 + self.percent}L * {common} >= {self.percent}L * (na + nb)").select("a", "b")
        links = materialized(links, "links")
        discard(sized, likely)
        return links

    def add(self, links: DataFrame) -> None:
        self.links = links if self.links is None else self.links.unionByName(links)
        if not links.isEmpty():
            self.comps = components(self.links)

    def run(self) -> None:
        self.add(materialized(self.shared_ids(), "links"))
        tables = self.tables()
        ids = materialized(tables.select("id").distinct().join(self.classes.select("id", "digest"), "id"), "ids")
        with byte_batches(self.docs.sparkSession):
            texts = self.docs.join(ids.selectExpr("id AS doc_id").distinct(), "doc_id", "left_semi")
            held = whole_sets(texts, self.k).withColumnRenamed("doc_id", "id")
            members = materialized(held.join(ids, ["id", "digest"], "left_semi").dropDuplicates(["id", "digest"]), "members")
        discard(ids)
        tables = self.mixed(tables)
        self.add(self.confirmed(self.star(tables), members))
        tables = self.mixed(tables)
        lists = self.mixed(self.rarest(tables, members))
        self.add(self.confirmed(self.across(lists), members))
        discard(tables, lists, members)


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per row of `docs` (doc_id, text).

    component_id is the smallest doc_id reachable by links, the row's own included; the row that has it is kept.
    """
    search = _Dedup(docs.select("doc_id", "text"), k, percent)
    search.run()
    found = search.labelled(search.classes.select("id", "digest")).select("digest", "comp")
    rows = search.sizes.join(found, "digest", "left")
    rows = rows.select("doc_id", F.col("n").alias("n_shingles"), F.expr("coalesce(comp, doc_id)").alias("component_id"))
    return rows.withColumn("kept", F.expr("coalesce(doc_id = component_id, component_id IS NULL)"))

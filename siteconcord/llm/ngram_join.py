"""Jaccard join on word n-grams as a T-occurrence search, and the components of its links.

A document is the set of its distinct k-word shingles (64-bit hashes). Two documents link when
100 * |A and B| >= percent * |A or B|; then they share at least T = percent * (|A| + |B|) / (100 + percent) shingles, that is,
each stands on at least T of the other's inverted lists. The search follows DivideSkip:

* Equal sets are one class, represented by its smallest id; only classes are searched.
* Of a set of n shingles any partner holds percent * n / 100, so it must meet one of any n - ceil(percent * n / 100) + 1 lists.
  A document's head are its first shingles by hash, that many and `MORE` + n / 20 more. Two sets that link then meet on more than `MORE` + n / 20
  lists of their heads (n the smaller size), or on all that they share. A set that meets others on fewer lists links with none.
* The sets left are read whole, and their lists ordered by length, shortest first; lists of one document are not merged. A set merges its
  first n - ceil(percent * n / 100) + 1, and of the next `MORE` + n / 20 those of at most `LONG` documents. All others are set aside.
* The merge is the shuffle that brings a list's documents together, and a count per pair of the lists both merge. A pair is counted
  from the places where either set still has T members; so copies with edits of their own, whose shortest lists nobody shares, hardly meet.
* A pair met on c lists holds at most c plus what either set has beyond the last list both met on. Pairs that can still reach T are probed:
  long lists and all else not merged, by binary search of one sorted set's members in the other.
  The likeliest pairs of any two components go first, the others follow if those two are still apart.

Copies with small edits would make lists long and pairs many. So each list first links its documents to one of them,
the one with the fewest rarer members, and verified links become components; after that only pairs of different components
are made: a list's rows outside its largest component meet the others. No link between components is lost, and no group is expanded into all its pairs.

Components are found by alternating large and small stars on the links, in tables in the shared folder.

Defined cases: null, empty and blank texts have an empty set and are their own component; a text with fewer than k words is one shingle;
repeated rows are equal sets; rows that share a doc_id are one document and fall into one component; rows without a doc_id have the
component of an equal text, else null; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import contextlib
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteconcord.llm.batches import as_bytes, byte_batches, chunks
from siteconcord.llm.common import small
from siteconcord.operators.skew import fanned_join
from siteconcord.session import discard, materialized

SHINGLE = 4
PERCENT = 85
# Lists of a head beyond those that any partner must meet, besides a twentieth of the set.
MORE = 8
# Lists of more documents than this are merged only as far as a link may show on no shorter one.
LONG = 8
# Pairs of any two components that are probed before the others of the two.
FIRST = 16
# Bytes of text whose words a worker holds at once: each word is an object of its own until it is hashed.
_CHUNK = 1 << 20


# --- sets -------------------------------------------------------------------------------------------------------------


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _combined(words: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    h = np.full(len(starts), length, np.uint64)
    for k in range(length):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + words[starts + k])
    return h


def shingle_sets(raw: list[bytes], k: int) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text. Lower-casing and splitting of bytes is that of ASCII."""
    cut = [b.lower().split() for b in raw]
    lengths = np.array([len(c) for c in cut], np.int64)
    if not lengths.sum():
        return [np.zeros(0, np.int64) for _ in raw]
    coded = pa.array(list(chain.from_iterable(cut)), pa.binary()).dictionary_encode()
    distinct = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    words = distinct[coded.indices.to_numpy()]
    ends = np.cumsum(lengths)
    hashes = _combined(words, np.arange(max(0, len(words) - k + 1)), k).view(np.int64)
    out = []
    for end, length in zip(ends.tolist(), lengths.tolist()):
        if length >= k:
            out.append(np.unique(hashes[end - length : end - k + 1]))
        elif length:
            out.append(_combined(words, np.array([end - length]), length).view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def must_merge(n: int, percent: int) -> int:
    """Lists of which any partner of a set of n meets at least one."""
    return n - -(-percent * n // 100) + 1


def _sets(rows: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, n, digest, head) of rows with doc_id, text and, optionally, wanted: the length of the head."""
    doc_id = rows.schema["doc_id"].dataType.simpleString()
    given = "wanted" in rows.columns

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", _CHUNK):
                sets = shingle_sets(as_bytes(part.column("text")), k)
                wanted = part.column("wanted").to_pylist() if given else [must_merge(len(s), percent) + MORE + len(s) // 20 for s in sets]
                heads = [s[:w] for s, w in zip(sets, wanted)]
                offsets = np.cumsum([0, *[len(h) for h in heads]]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*heads, np.zeros(0, np.int64)]))),
                    ],
                    ["doc_id", "n", "digest", "head"],
                )

    return rows.mapInArrow(make, f"doc_id {doc_id}, n long, digest binary, head array<long>")


# --- components -------------------------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(id, comp) for every id on an edge (a, b): comp is the smallest id reachable. Large and small stars alternate."""

    def least(rows: DataFrame) -> DataFrame:
        # Written, so that a node with very many edges meets its minimum in a broadcast or a join that can be split.
        return small(materialized(rows.groupBy("u").agg(F.min("v").alias("m")), "least"))

    edges = edges.selectExpr("greatest(a, b) AS u", "least(a, b) AS v").filter("u <> v").distinct()
    edges = materialized(edges, "edges")
    print_of = None
    while True:
        both = edges.unionByName(edges.selectExpr("v AS u", "u AS v"))
        large = both.join(least(both), "u").filter("v > u").selectExpr("v AS u", "least(m, u) AS v").distinct()
        large = materialized(large, "edges")
        met = large.join(least(large), "u")
        smaller = met.filter("v <> m").selectExpr("v AS u", "m AS v").unionByName(met.selectExpr("u", "m AS v"))
        discard(edges)
        edges = materialized(smaller.distinct(), "edges")
        discard(large)
        now = tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.sum(F.expr("xxhash64(v, u) >> 20"))).first())
        if now == print_of:
            break
        print_of = now
    tops = edges.selectExpr("v AS id", "v AS comp").join(edges.select(F.col("u").alias("id")), "id", "left_anti").distinct()
    return materialized(edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("comp")).unionByName(tops), "components")


# --- the search -------------------------------------------------------------------------------------------------------


@contextlib.contextmanager
def _short_batches(spark: SparkSession, rows: int):
    """Arrow batches of few rows while tables with long arrays are made."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def probe(a: np.ndarray, b: np.ndarray) -> int:
    """How many of the shorter sorted set's members a binary search finds in the longer."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0


class _Search:
    def __init__(self, docs: DataFrame, k: int, percent: int, long: int):
        self.docs, self.k, self.percent, self.long = docs, k, percent, long
        self.spark = docs.sparkSession
        self.near = f"100 * least(na, nb) >= {percent} * greatest(na, nb)"
        self.enough = f"{100 + percent} * {{}} >= {percent} * (na + nb)"
        with byte_batches(self.spark):
            heads = materialized(_sets(docs, k, percent), "heads")
        self.sizes = materialized(heads.select("doc_id", "n", "digest"), "sizes")
        classes = heads.filter("n > 0 AND doc_id IS NOT NULL").groupBy("digest")
        found = classes.agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("head").alias("head"))
        self.classes = materialized(found, "classes")
        # Heads are most of the space this takes; from here on the classes hold them.
        discard(heads)
        self.links = None
        self.comps = None

    def _labelled(self, rows: DataFrame) -> DataFrame:
        """Adds comp, the component so far."""
        if self.comps is None:
            return rows.withColumn("comp", F.col("id"))
        return rows.join(small(self.comps), "id", "left").withColumn("comp", F.expr("coalesce(comp, id)"))

    def rows(self) -> DataFrame:
        return self.classes.select("id", "n", F.explode("head").alias("h"))

    def shared(self) -> DataFrame:
        """(h, id, n): the inverted lists of the heads that hold more than one class."""
        several = self.rows().groupBy("h").count().filter("count > 1").select("h")
        return materialized(self.rows().join(several, "h"), "lists")

    def add(self, pairs: DataFrame, whole: DataFrame) -> None:
        """Verify pairs (a, b, na, nb) and merge the components of those that link."""
        pairs = materialized(pairs, "pairs")
        if pairs.isEmpty():
            return
        found = self._verified(pairs, whole)
        if not found.isEmpty():
            self.links = found if self.links is None else self.links.unionByName(found)
            self.comps = components(self.links)

    @property
    def early(self) -> str:
        """The first list two sets share leaves at least T members on either side."""
        return f"{self.enough.format('(na - ia)')} AND {self.enough.format('(nb - ib)')}"

    def star(self, merged: DataFrame) -> DataFrame:
        """Each list's documents, paired with the one that has the fewest rarer members: of edited copies the one with the fewest edits."""
        chosen = merged.groupBy("h").agg(F.min(F.expr("struct(at, xxhash64(id) AS x, id, n)")).alias("centre"))
        met = merged.join(chosen, "h").filter("id <> centre.id")
        met = met.selectExpr("id", "n AS na", "at AS ia", "centre.id AS other", "centre.n AS nb", "centre.at AS ib").filter(f"{self.near} AND {self.early}")
        return met.selectExpr("least(id, other) AS a", "greatest(id, other) AS b", "if(id < other, na, nb) AS na", "if(id < other, nb, na) AS nb").distinct()

    def _whole(self, ids: DataFrame) -> DataFrame:
        """(doc_id, digest, n, members): the whole sets of all texts with these ids."""
        wanted = ids.select(F.col("id").alias("doc_id"), F.lit(1 << 40).alias("wanted"))
        with _short_batches(self.spark, 256), byte_batches(self.spark):
            texts = self.docs.join(small(wanted), "doc_id").select("doc_id", "text", "wanted")
            sets = _sets(texts, self.k, self.percent).dropDuplicates(["doc_id", "digest"])
            return materialized(sets.withColumnRenamed("head", "members"), "sets")

    def _verified(self, pairs: DataFrame, whole: DataFrame) -> DataFrame:
        """The pairs that link, by binary probes of their whole sets."""
        with _short_batches(self.spark, 256), byte_batches(self.spark):
            whole = whole.select("doc_id", "members")
            one = whole.withColumnsRenamed({"doc_id": "a", "members": "sa"})
            two = whole.withColumnsRenamed({"doc_id": "b", "members": "sb"})
            percent = self.percent

            def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    left, right = batch.column("sa"), batch.column("sb")
                    links = []
                    for i in range(batch.num_rows):
                        a, b = left[i].values.to_numpy(), right[i].values.to_numpy()
                        links.append((100 + percent) * probe(a, b) >= percent * (len(a) + len(b)))
                    yield batch.select(["a", "b"]).filter(pa.array(links, pa.bool_()))

            met = pairs.select("a", "b").join(one, "a").join(two, "b")
            links = materialized(met.mapInArrow(probed, pairs.select("a", "b").schema), "links")
        discard(pairs)
        return links

    def mixed(self, lists: DataFrame) -> DataFrame:
        """The rows of lists that hold several components, with comp and of_most: whether it is the one that holds most of the list."""
        rows = self._labelled(lists)
        sizes = rows.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("c"))
        tops = sizes.groupBy("h").agg(F.expr("max(struct(c, comp)).comp AS most"), F.expr("min(comp) <> max(comp) AS mixed"))
        found = rows.join(tops.filter("mixed"), "h").withColumn("of_most", F.expr("comp = most")).drop("most", "mixed")
        return materialized(found, "mixed")

    def likely(self, lists: DataFrame) -> DataFrame:
        """(id) of the classes that meet others on as many lists of their heads as a link takes.

        Of two sets that link, either has all common members but n - ceil(percent * n / 100) at most in front of any place, so the first
        `MORE` + 1 + n / 20 of them lie in both heads, or all do. A partner has at least percent * n / 100 members.
        """
        least = f"({self.percent} * n + 99) div 100"
        counts = lists.groupBy("id", "n").agg(F.count(F.lit(1)).alias("c"))
        enough = counts.filter(f"c >= least({least}, {MORE + 1} + ({least}) div 20)")
        return materialized(enough.select("id").distinct(), "likely")

    def merged(self, ids: DataFrame, whole: DataFrame) -> DataFrame:
        """(h, length, id, own, n, at): the lists that each of these classes merges, with their places in its order of merging.

        Lists come by length; those with one class only are the first, unnumbered. `own` tells classes with one id apart.
        """
        classes = self.classes.join(small(ids), "id").select(F.col("id").alias("doc_id"), "digest")
        sets = whole.join(classes, ["doc_id", "digest"], "left_semi")
        rows = materialized(sets.selectExpr("doc_id AS id", "xxhash64(digest) AS own", "n", "explode(members) AS h"), "rows")
        several = rows.groupBy("h").agg(F.count(F.lit(1)).alias("length")).filter("length > 1")
        known = materialized(rows.join(several, "h"), "known")
        # A set links only if so many of its members are shared at all; the others go before anything is sorted.
        shared = known.groupBy("id", "own", "n").agg(F.count(F.lit(1)).alias("c")).filter(f"100 * c >= {self.percent} * n")
        shared = materialized(shared.select("id", "own", "c"), "shared")
        place = "n - c + row_number() OVER (PARTITION BY id, own ORDER BY length, h) - 1 AS at"
        placed = known.join(small(shared), ["id", "own"]).selectExpr("h", "length", "id", "own", "n", place)
        must = f"n - ({self.percent} * n + 99) div 100 + 1"
        found = placed.filter(f"at < {must} OR length <= {self.long} AND at < {must} + {MORE} + n div 20")
        found = materialized(found, "merged")
        discard(rows, known, shared)
        return found

    def occurrences(self, merged: DataFrame) -> DataFrame:
        """Pairs of different components whose count of common merged lists, plus what may lie beyond, reaches T.

        A list's rows outside its largest component meet its other rows, so a component's rows are not paired among themselves. The lists a pair
        is counted on are the first ones of all it shares: the short ones, and the longer ones as far as both sets still have T members.
        """
        of = "struct(id, own, n, at, comp, of_most) AS {}"
        met = fanned_join(merged.selectExpr("h", "length", of.format("x")), merged.filter("NOT of_most").selectExpr("h", of.format("y")), "h")
        met = met.filter("x.comp <> y.comp AND (x.of_most OR x.id < y.id)").selectExpr("length", "if(x.id < y.id, x, y) AS x", "if(x.id < y.id, y, x) AS y")
        sides = [f"{x}.{c} AS {name}{side}" for side, x in (("a", "x"), ("b", "y")) for c, name in (("own", "o"), ("n", "n"), ("at", "i"), ("comp", "c"))]
        met = met.selectExpr("length", "x.id AS a", "y.id AS b", *sides)
        met = met.filter(f"{self.near} AND (length <= {self.long} OR {self.early})")
        places = ("count(*) AS c", "min(ia) AS ia", "min(ib) AS ib", "max(ia) AS la", "max(ib) AS lb")
        counted = met.groupBy("a", "b", "oa", "ob", "na", "nb", "ca", "cb").agg(*[F.expr(e) for e in places])
        most = "c + least(na - 1 - la, nb - 1 - lb)"
        counted = counted.filter(self.early).withColumn("most", F.expr(most)).filter(self.enough.format("most"))
        return counted.selectExpr("a", "b", "na", "nb", "least(ca, cb) AS ca", "greatest(ca, cb) AS cb", "most / (na + nb) AS likely")

    def settle(self, pairs: DataFrame, whole: DataFrame) -> None:
        """Probe pairs of different components, the likeliest `FIRST` of any two components before all others.

        Where a group of edited copies is one component, those left outside have candidates all over it; once one of them links, the
        others join nothing new and are not probed.
        """
        order = "row_number() OVER (PARTITION BY ca, cb ORDER BY likely DESC, a, b) AS turn"
        pairs = materialized(pairs.selectExpr("a", "b", "na", "nb", "ca", "cb", order), "counted")
        self.add(pairs.filter(f"turn <= {FIRST}").select("a", "b", "na", "nb"), whole)
        rest = pairs.filter(f"turn > {FIRST}")
        if not rest.isEmpty():
            apart = rest.select("ca", "cb").distinct()
            if self.comps is not None:
                for x in ("ca", "cb"):
                    apart = apart.join(small(self.comps.selectExpr(f"id AS {x}", f"comp AS now_{x}")), x, "left")
                apart = apart.filter("coalesce(now_ca, ca) <> coalesce(now_cb, cb)").select("ca", "cb")
            apart = materialized(apart, "apart")
            self.add(rest.join(small(apart), ["ca", "cb"], "left_semi").select("a", "b", "na", "nb"), whole)
            discard(apart)
        discard(pairs)

    def run(self) -> None:
        lists = self.shared()
        if lists.isEmpty():
            return
        ids = self.likely(lists)
        discard(lists)
        whole = self._whole(ids)
        merged = self.merged(ids, whole)
        self.add(self.star(merged), whole)
        mixed = self.mixed(merged)
        self.settle(self.occurrences(mixed), whole)
        discard(ids, whole, merged, mixed)


def ngram_components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, long: int = LONG) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row per row of `docs` (doc_id, text).

    component_id is the smallest doc_id reachable by links, the row's own included.
    """
    search = _Search(docs.select("doc_id", "text"), k, percent, long)
    search.run()
    classes = search._labelled(search.classes.select("id", "digest")).select(F.col("digest").alias("own"), "comp")
    rows = search.sizes.join(classes, F.expr("digest = own"), "left")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.expr("coalesce(comp, doc_id)").alias("component_id"))


def keep_one(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The rows of `docs`, with all their columns, whose doc_id is the smallest of its component."""
    found = ngram_components(docs, k, percent)
    others = materialized(found.filter("component_id <> doc_id").select(F.col("doc_id").alias("_other")).distinct(), "others")
    row = docs.select(F.struct("*").alias("row"))
    return row.join(small(others), F.expr("row.doc_id = _other"), "left_anti").select("row.*")

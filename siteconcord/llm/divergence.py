"""How far the sources of a language differ in their words, as exact sums over a frequent-pattern tree.

Each language keeps the terms that stand in at least `MIN_DOCS` of its documents, V of them. A group (lang, source) gives a kept term
that it holds n times the probability p(n) = 1 + floor(10^9 * (n + 5) / (N + 5 * V)), N being all its kept occurrences. The distance
of two sources s and t is the sum of |p_s - p_t| over all V terms. Nearly all terms are absent from most sources, so the sum is
taken in three parts, which add up to it exactly:

* V * |p_s(0) - p_t(0)|, as if no term stood in either;
* for each term in s the change |p_s(n) - p_t(0)| - |p_s(0) - p_t(0)|, and the same for t: once per distinct count n and source;
* for each term in both the rest, |p_s(n) - p_t(m)| - |p_s(n) - p_t(0)| - |p_s(0) - p_t(m)| + |p_s(0) - p_t(0)|.

The third part comes from a frequent-pattern tree: a term's row is its nonzero counts in the order of sources; equal rows are one
row with a multiplicity; rows enter a prefix tree in sorted order. A node's multiplicity is that of all rows below it, so each
node adds its corrections against its ancestors once, however many terms share the path. Rows are range-partitioned: every task
builds the part of the tree its range spans and holds one path of it; a node on the border of two ranges is counted in both with
the rows it has there, which adds up to the same.

Defined cases: null text, lang and source are ''. A group without kept terms is there, with N = 0; a language without kept terms
has distances of 0. Repeated rows are documents of their own; ids are not read, so null or repeated ids change nothing. Ties go to the
lesser item by UTF-8 bytes. Empty tables give an empty result; other columns are ignored. The result holds one row per ordered
pair of a language's sources, and a term's row one entry per source that has it: sources are few beside documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from string import ascii_letters, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteconcord.llm.batches import as_bytes, byte_batches, chunks
from siteconcord.session import discard, materialized

MIN_DOCS = 30
TOP_TERMS = 50
# Fixed values of the probabilities.
SCALE, ADDED = 1_000_000_000, 5

# ASCII other than letters separates terms; only A-Z are lower-cased.
_FOLD = bytes(ord(chr(b).lower()) if chr(b) in ascii_uppercase else b if b > 127 or chr(b) in ascii_letters else 32 for b in range(256))
# Corrections a task gathers before it adds them up by pair.
_BUFFER = 1 << 20


# --- counts -----------------------------------------------------------------------------------------------------------


def _counted(part: pa.RecordBatch) -> pa.RecordBatch:
    """(lang, source, term, n, docs) of a batch of texts: occurrences and documents per group and term."""
    cut = [b.translate(_FOLD).split() for b in as_bytes(part.column("text"))]
    coded = pa.array(list(chain.from_iterable(cut)), pa.binary()).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = max(1, len(coded.dictionary))
    row = np.repeat(np.arange(len(cut), dtype=np.int64), [len(c) for c in cut])
    of_doc, n = np.unique(row * size + codes, return_counts=True)
    group_of = pa.StructArray.from_arrays([part.column("lang"), part.column("source")], ["lang", "source"]).to_pylist()
    numbers: dict[tuple, int] = {}
    group = np.array([numbers.setdefault((g["lang"], g["source"]), len(numbers)) for g in group_of], np.int64)
    keys, at = np.unique(group[of_doc // size] * size + of_doc % size, return_inverse=True)
    occurrences = np.zeros(len(keys), np.int64)
    np.add.at(occurrences, at, n)
    groups = list(numbers)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([groups[k][0] for k in (keys // size).tolist()], pa.string()),
            pa.array([groups[k][1] for k in (keys // size).tolist()], pa.string()),
            coded.dictionary.take(pa.array(keys % size)).cast(pa.string()),
            pa.array(occurrences),
            pa.array(np.bincount(at, minlength=len(keys)).astype(np.int64)),
        ],
        ["lang", "source", "term", "n", "docs"],
    )


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text"):
            yield _counted(part)


def kept_terms(rows: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, n, held): a language's kept terms, their occurrences there, and those per source that has them."""
    counts = rows.mapInArrow(_count_batches, "lang string, source string, term string, n long, docs long")
    by_source = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = by_source.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("held")
    )
    return by_term.filter(f"docs >= {min_docs}").drop("docs")


def _p(n: str, total: str = "n_kept") -> str:
    """The probability of a count; in decimals, since a product of long ones would overflow."""
    top = f"CAST({SCALE} AS DECIMAL(10, 0)) * CAST({n} + {ADDED} AS DECIMAL(19, 0))"
    return f"1 + bigint(({top}) div CAST({total} + {ADDED} * v AS DECIMAL(19, 0)))"


def _facts(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, v, n_kept, n_lang, p0) of every group: kept terms, its and its language's occurrences, p of an absent term."""
    groups = rows.select("lang", "source").distinct()
    languages = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n_lang"))
    totals = kept.select("lang", F.explode("held").alias("h")).groupBy("lang", "h.source").agg(F.sum("h.n").alias("n_kept"))
    known = groups.join(languages, "lang", "left").join(totals, ["lang", "source"], "left")
    return known.fillna(0, ["v", "n_lang", "n_kept"]).withColumn("p0", F.expr(f"CASE WHEN v > 0 THEN {_p('0')} ELSE 0L END"))


# --- the tree ---------------------------------------------------------------------------------------------------------


class _Tree:
    """A frequent-pattern tree that rows enter in sorted order; only the path to the last row is held.

    A node leaves the path when a row comes that does not share it: then its multiplicity is known and it is set
    against its ancestors, all at once.
    """

    def __init__(self) -> None:
        self.lang: str | None = None
        self.numbers: dict[str, int] = {}
        self.gathered = 0
        self.keys: list[np.ndarray] = []
        self.values: list[np.ndarray] = []
        self._grow(16)

    def _grow(self, depth: int) -> None:
        old = getattr(self, "number", None)
        self.number, self.p, self.p0, self.many = (np.zeros(depth, np.int64) for _ in range(4))
        if old is None:
            self.path: list[tuple[str, int]] = []

    def insert(self, items: list[dict], many: int) -> None:
        shared = 0
        while shared < len(self.path) and shared < len(items) and self.path[shared] == (items[shared]["source"], items[shared]["n"]):
            shared += 1
        self.cut(shared)
        if len(items) > len(self.number):
            kept = [a[:shared].copy() for a in (self.number, self.p, self.p0, self.many)]
            self._grow(2 * len(items))
            for a, old in zip((self.number, self.p, self.p0, self.many), kept):
                a[:shared] = old
        for depth, item in enumerate(items[shared:], shared):
            self.path.append((item["source"], item["n"]))
            self.number[depth] = self.numbers.setdefault(item["source"], len(self.numbers))
            self.p[depth], self.p0[depth], self.many[depth] = item["p"], item["p0"], 0
        if items:
            self.many[len(items) - 1] += many

    def cut(self, depth: int) -> None:
        """Close the nodes below `depth`, the deepest first; each passes its multiplicity up."""
        for d in range(len(self.path) - 1, depth - 1, -1):
            if d:
                self.many[d - 1] += self.many[d]
                p, p0, q, q0 = self.p[d], self.p0[d], self.p[:d], self.p0[:d]
                rest = np.abs(p - q) - np.abs(p - q0) - np.abs(p0 - q) + np.abs(p0 - q0)
                self.keys.append((self.number[:d] << 32) | self.number[d])
                self.values.append(self.many[d] * rest)
                self.gathered += d
            self.path.pop()

    def sums(self) -> pa.RecordBatch | None:
        """What was gathered, added up by pair."""
        if not self.keys:
            return None
        keys, at = np.unique(np.concatenate(self.keys), return_inverse=True)
        values = np.zeros(len(keys), np.int64)
        np.add.at(values, at, np.concatenate(self.values))
        names = list(self.numbers)
        self.keys, self.values, self.gathered = [], [], 0
        columns = [
            pa.array([self.lang] * len(keys), pa.string()),
            pa.array([names[k >> 32] for k in keys.tolist()], pa.string()),
            pa.array([names[k & 0xFFFFFFFF] for k in keys.tolist()], pa.string()),
            pa.array(values),
        ]
        return pa.RecordBatch.from_arrays(columns, ["lang", "source", "item", "part_value"])


def _tree_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tree = _Tree()
    for batch in batches:
        for lang, items, many in zip(*(batch.column(c).to_pylist() for c in ("lang", "items", "many"))):
            if lang != tree.lang:
                tree.cut(0)
                if (out := tree.sums()) is not None:
                    yield out
                tree = _Tree()
                tree.lang = lang
            tree.insert(items, many)
            if tree.gathered > _BUFFER and (out := tree.sums()) is not None:
                yield out
    tree.cut(0)
    if (out := tree.sums()) is not None:
        yield out


def tree_corrections(cells: DataFrame) -> DataFrame:
    """(lang, source, item, part_value) with source < item: parts of the sums over terms that both have.

    `cells` has lang, term, source, n, p, p0.
    """
    by_term = cells.groupBy("lang", "term").agg(F.expr("array_sort(collect_list(struct(source, n, p, p0))) AS items"))
    rows = materialized(by_term.groupBy("lang", "items").agg(F.count(F.lit(1)).alias("many")), "term-rows")
    ordered = rows.repartitionByRange("lang", "items").sortWithinPartitions("lang", "items")
    return ordered.mapInArrow(_tree_batches, "lang string, source string, item string, part_value long")


# --- the audit --------------------------------------------------------------------------------------------------------


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) of `docs` (text, lang, source).

    Part 'pair' ranks each group's distances to the language's other sources, part 'term' the terms it uses more than its
    language does, to rank `top_terms`; ranks go by value descending, then item.
    """
    spark = docs.sparkSession
    rows = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")])
    with byte_batches(spark):
        kept = materialized(kept_terms(rows, min_docs), "kept")
    facts = materialized(_facts(rows, kept), "facts")
    held = kept.select("lang", "term", F.col("n").alias("in_lang"), F.explode("held").alias("h")).select("lang", "term", "in_lang", "h.*")
    cells = held.join(facts, ["lang", "source"]).withColumns({"p": F.expr(_p("n")), "q": F.expr(_p("in_lang", "n_lang"))})
    cells = materialized(cells.select("lang", "source", "term", "n", "p", "p0", "q"), "cells")
    discard(kept)

    others = facts.selectExpr("lang", "source AS item", "p0 AS q0")
    pairs = facts.join(others, "lang").filter("source <> item")
    absent = pairs.selectExpr("lang", "source", "item", "v * abs(p0 - q0) AS part_value")
    counts = cells.groupBy("lang", "source", "n", "p", "p0").agg(F.count(F.lit(1)).alias("many"))
    one = counts.join(others, "lang").filter("source <> item")
    one = one.selectExpr("lang", "source", "item", "many * (abs(p - q0) - abs(p0 - q0)) AS part_value")
    # What holds for one order of a pair holds for the other.
    halves = one.unionByName(tree_corrections(cells)).groupBy("lang", "source", "item").agg(F.sum("part_value").alias("part_value"))
    halves = materialized(halves, "corrections")
    both = halves.unionByName(halves.selectExpr("lang", "item AS source", "source AS item", "part_value"))
    sums = absent.unionByName(both).groupBy("lang", "source", "item").agg(F.sum("part_value").alias("value"))
    by_value = "row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank"
    far = sums.selectExpr("lang", "source", "'pair' AS part", "item", "value", by_value)
    more = cells.filter("p > q").selectExpr("lang", "source", "'term' AS part", "term AS item", "p - q AS value")
    more = more.selectExpr("*", by_value).filter(f"rank <= {top_terms}")
    return far.unionByName(more)

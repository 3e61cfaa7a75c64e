"""A Merkle manifest of a table: digests of its rows, trees per language, one root, and a proof for every row.

A row's leaf is H of its fields, H being the lowercase hex SHA-256 of its inputs put together: a null field is '-', any other its
UTF-8 byte count, ':' and the value. A language's leaves ascend by doc_id; as long as there are several nodes, every run of `arity`
consecutive ones (the last run may hold fewer, even one) becomes its H. What remains is the language's subroot. The subroots in
the order of languages are the leaves of one more tree, whose top is the root.

A level is one self-join: nodes carry their place in the level, and each computes the places of its siblings (place XOR 1 in a
binary tree, else its slot shifted by 1 to arity - 1 within its run) and equijoins the level on them. Then the rows in slot zero,
which know their whole run, emit the parents. Levels are written to the shared folder; each is `arity` times smaller than the one
below. Proofs go back down the same tables: a node's proof is its siblings followed by its parent's proof, so each step is a
join on the parent's place, and neither a tree nor a level is ever in one task.

Defined cases: null lang is a language of its own and comes first; null doc_ids come first in their language; rows that share a doc_id go by
their leaves, and rows equal in every field are leaves side by side that may change places without any effect on the result. Empty
and null texts have different leaves. An empty table has no root: its manifest is empty. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteconcord.llm.common import lower_ascii
from siteconcord.operators.ordinals import dense_ordinals
from siteconcord.session import discard, materialized

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 8
# Rows whose doc_id's CRC-32 this divides are tampered with.
TAMPERED = 3


def leaf(*fields: str | Column) -> Column:
    parts = []
    for field in fields:
        value = (F.col(field) if isinstance(field, str) else field).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def level(nodes: DataFrame, arity: int) -> DataFrame:
    """Adds `before` and `after`, the digests of a node's siblings in its run, to nodes (tree, place, n, h, ...)."""
    if arity == 2:
        shifted = nodes.selectExpr("tree", "place", "place ^ 1 AS sibling")
    else:
        offsets = nodes.selectExpr("tree", "place", f"explode(sequence(1, {arity - 1})) AS offset")
        shifted = offsets.selectExpr("tree", "place", f"place - place % {arity} + (place + offset) % {arity} AS sibling")
    met = shifted.join(nodes.selectExpr("tree", "place AS sibling", "h AS sibling_h"), ["tree", "sibling"])
    # A run has at most `arity` members.
    runs = met.groupBy("tree", "place").agg(F.expr("array_sort(collect_list(struct(sibling, sibling_h))) AS run"))
    joined = nodes.join(runs, ["tree", "place"], "left")
    side = "coalesce(array_join(transform(filter(run, x -> x.sibling {} place), x -> x.sibling_h), ''), '')"
    return joined.withColumns({"before": F.expr(side.format("<")), "after": F.expr(side.format(">"))}).drop("run")


def parents(linked: DataFrame, arity: int) -> DataFrame:
    """The rows in slot zero know their run and emit its digest."""
    first = linked.filter(f"place % {arity} = 0")
    return first.selectExpr(
        "tree", f"place div {arity} AS place", f"(n + {arity - 1}) div {arity} AS n", "sha2(concat(before, h, after), 256) AS h"
    )


class Forest:
    """Trees over leaves (tree, place, n, h, ...): place counts from 0 in a tree of n leaves. `tops` has (tree, h)."""

    def __init__(self, leaves: DataFrame, arity: int):
        self.arity = arity
        self.levels: list[DataFrame] = []
        most = leaves.agg(F.max("n")).first()[0] or 0
        nodes, tops = leaves, []
        while True:
            tops.append(nodes.filter("n = 1"))
            if most <= 1:
                break
            linked = materialized(level(nodes.filter("n > 1"), arity), "level")
            self.levels.append(linked)
            nodes, most = parents(linked, arity), -(-most // arity)
        self.ready = tops
        self.tops = materialized(reduce(DataFrame.unionByName, [t.select("tree", "h") for t in tops]), "tops")

    def proofs(self, above: DataFrame) -> DataFrame:
        """The leaves, each with what `above` (tree, proof, ...) holds for its tree and with its siblings put before that proof.

        A proof is an array of (before, after), from the leaf up.
        """
        carried = [c for c in above.columns if c not in ("tree", "proof")]
        start = lambda depth: self.ready[depth].join(above, "tree")
        found = start(len(self.levels))
        for depth in range(len(self.levels) - 1, -1, -1):
            up = found.select("tree", F.col("place").alias("parent"), F.col("proof").alias("above"), *carried)
            linked = self.levels[depth].withColumn("parent", F.expr(f"place div {self.arity}"))
            down = linked.join(up, ["tree", "parent"])
            down = down.withColumn("proof", F.expr("concat(array(struct(before, after)), above)"))
            down = down.drop("parent", "above", "before", "after")
            found = down.unionByName(start(depth))
            if depth:
                found = materialized(found, "proofs")
        return found

    def discard(self) -> None:
        discard(self.tops, *self.levels)


def folded(digest: str, proof: str = "proof") -> str:
    """The root that a leaf's digest gives with the siblings of a proof."""
    return f"aggregate({proof}, {digest}, (x, s) -> sha2(concat(s.before, x, s.after), 256))"


def numbered(leaves: DataFrame, by: str, order: list[str]) -> DataFrame:
    """Adds tree, place and n; `by` becomes a tree name that is never null and sorts as it does."""
    named = leaves.withColumn("tree", F.expr(f"coalesce(concat('=', {by}), '')"))
    named = materialized(named, "leaves")
    placed = dense_ordinals(named, "place", order, ["tree"]).withColumn("place", F.col("place") - 1)
    sizes = named.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
    return materialized(placed.join(sizes, "tree"), "numbered")


def manifest(docs: DataFrame, changed: Column | None = None, arity: int = ARITY) -> DataFrame:
    """One row per row of `docs` (doc_id, text, lang, source, n_chars): doc_id, leaf, subroot, root, proof, folded_root, verified.

    `proof` is the array of sibling digests (before, after) from the leaf to the root. `folded_root` is what the proof makes
    of the leaf as it is found when the row is read again: with `changed` as its text, where given.
    """
    fields = [F.col(f) for f in FIELDS]
    again = leaf(*fields) if changed is None else leaf(*fields[:-1], changed)
    leaves = numbered(docs.select("doc_id", "lang", leaf(*fields).alias("h"), again.alias("found")), "lang", ["doc_id", "h"])
    languages = Forest(leaves.drop("lang"), arity)
    subroots = languages.tops.selectExpr("tree AS language", "h")
    count = subroots.count()
    # One row per language, numbered without gathering them.
    listed = dense_ordinals(subroots, "place", ["language"]).selectExpr("'' AS tree", "place - 1 AS place", f"{count}L AS n", "h", "language")
    listed = materialized(listed, "subroots")
    whole = Forest(listed, arity)
    root = whole.tops.select("h").first()
    top = whole.tops.selectExpr("tree", "CAST(array() AS array<struct<before: string, after: string>>) AS proof")
    above = materialized(whole.proofs(top).selectExpr("language AS tree", "h AS subroot", "proof"), "above")
    proofs = languages.proofs(above)
    found = proofs.select("doc_id", F.col("h").alias("leaf"), "subroot", F.lit(root["h"] if root else None).alias("root"), "proof", F.expr(folded("found")).alias("folded_root"))
    return found.withColumn("verified", F.expr("folded_root = root"))


def tampered_text() -> Column:
    """The text with A-Z lower-cased in the rows a fixed rule picks; others, and nulls, are as they are."""
    picked = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % TAMPERED == 0
    return F.when(picked, lower_ascii(F.col("text"))).otherwise(F.col("text"))

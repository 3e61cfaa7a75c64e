"""Benchmark decontamination: which documents hold passages of test items, and their removal.

The distinct n-word windows of the items form a hash set that every task gets (its size is checked; a set beyond the
bound is joined by a shuffle instead). The documents' windows are hashed in generated code and looked up; a hit is verified
word by word. An item of fewer than n words, but not none, is one window of its own length. Everything is built-in
functions: no Python runs on the executors.

Defined cases: null and empty texts have no words and hit nothing; items without words have no window; empty tables give
no rows or no hits; a row's result depends on its own doc_id and text alone, so repeated rows get equal results; other
columns are ignored by `contamination` and kept by `remove`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteconcord.llm.common import ALNUM_BREAK, BROADCAST_ROWS, alnum_words, let
from siteconcord.session import materialized

WINDOW = 10


def _key(passage: Column) -> Column:
    return F.xxhash64(passage)


def _windows(cut: DataFrame, lengths: list[int]) -> DataFrame:
    """`cut` has words; adds at, length and key for every window of the lengths, in one pass."""
    places = ", ".join(f"if(size(words) < {n}, array(), transform(sequence(0, size(words) - {n}), i -> struct(i AS at, {n} AS length)))" for n in lengths)
    # Places are a column of their own: exploding it is generated code, which does not copy `words` into every row. The outer form keeps
    # Spark from testing beforehand whether there are any, which would cut the words once more; a row without places joins nothing.
    listed = cut.withColumn("places", F.expr(f"flatten(array({places}))"))
    opened = listed.select(*cut.columns, F.explode_outer("places").alias("w")).select(*cut.columns, "w.at", "w.length")
    return opened.withColumn("key", _key(F.expr("slice(words, at + 1, length)")))


def window_set(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(key, length, passage, items): distinct windows of the items (item_id, text) with the ids of their items."""
    cut = items.select(F.col("item_id").cast("string").alias("item_id"), alnum_words(F.col("text")).alias("words"))
    cut = cut.filter(F.size("words") > 0).withColumn("length", F.least(F.size("words"), F.lit(window)))
    starts = cut.select("*", F.explode(F.expr("sequence(0, size(words) - length)")).alias("at"))
    passages = starts.select("item_id", "length", F.expr("slice(words, at + 1, length)").alias("passage"))
    keyed = passages.withColumn("key", _key(F.col("passage")))
    return keyed.groupBy("key", "length", "passage").agg(F.collect_set("item_id").alias("items"))


def _row_key(text: Column) -> Column:
    return F.xxhash64(text)


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, most: int = BROADCAST_ROWS) -> DataFrame:
    """(hit_id, hit_row, at, length, items): every place of a document where a window of an item stands.

    Up to `most` distinct windows are broadcast, and a hit is verified where it is found. More are joined by a shuffle that
    carries keys and places only; the passages found are verified when they are back at their documents.
    """
    listed = materialized(window_set(items, window), "windows")
    lengths = sorted(r[0] for r in listed.select("length").distinct().collect())
    cut = docs.select(F.col("doc_id").alias("hit_id"), _row_key(F.col("text")).alias("hit_row"), alnum_words(F.col("text")).alias("words"))
    if not lengths:
        return cut.limit(0).selectExpr("hit_id", "hit_row", "0 AS at", "0 AS length", "array('') AS items")
    opened = _windows(cut, lengths)
    if listed.limit(most + 1).count() <= most:
        found = opened.join(F.broadcast(listed), ["key", "length"])
        return found.filter("slice(words, at + 1, length) = passage").select("hit_id", "hit_row", "at", "length", "items")
    near = opened.select("hit_id", "hit_row", "at", "length", "key").join(listed, ["key", "length"])
    near = near.groupBy("hit_id", "hit_row").agg(F.collect_set(F.struct("at", "length", "passage", "items")).alias("near"))
    back = near.withColumnsRenamed({"hit_id": "near_id", "hit_row": "near_row"})
    # Equal rows have equal hits: one of them is enough.
    once = cut.dropDuplicates(["hit_id", "hit_row"]).join(back, F.expr("hit_id <=> near_id AND hit_row = near_row"))
    same = once.select("hit_id", "hit_row", F.explode(F.expr("filter(near, x -> slice(words, x.at + 1, x.length) = x.passage)")).alias("x"))
    return same.select("hit_id", "hit_row", "x.at", "x.length", "x.items")


def _by_row(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """Per document row with hits: positions of the hit words, ids of the items."""
    spans = F.transform(F.collect_set(F.struct("at", "length")), lambda s: F.sequence(s["at"], s["at"] + s["length"] - 1))
    ids = F.array_distinct(F.flatten(F.collect_set("items")))
    grouped = hits(docs, items, window).groupBy("hit_id", "hit_row").agg(spans.alias("spans"), ids.alias("ids"))
    return grouped.select("hit_id", "hit_row", F.array_sort(F.array_distinct(F.flatten("spans"))).alias("hit"), F.array_sort("ids").alias("ids"))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of `docs` (doc_id, text): how many words stand in windows of `items` (item_id, text), and whose."""
    docs = docs.select("doc_id", "text")
    counted = docs.select("doc_id", _row_key(F.col("text")).alias("row"), F.size(alnum_words(F.col("text"))).cast("long").alias("n_words"))
    joined = counted.join(_by_row(docs, items, window), F.expr("doc_id <=> hit_id AND row = hit_row"), "left")
    n_hit = F.coalesce(F.size("hit"), F.lit(0)).cast("long")
    return joined.select(
        "doc_id",
        "n_words",
        F.when(F.col("hit").isNull(), 0).otherwise(n_hit).cast("long").alias("n_hit"),
        F.when(F.col("ids").isNull(), 0).otherwise(F.size("ids")).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("items_sha256"),
        F.col("hit").isNotNull().alias("contaminated"),
    )


def _without(text: Column, hit: Column) -> Column:
    """The text without the words at the ascending places `hit`; what stood between two words stays once."""
    breaks = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    # Runs of hit words: their first and last places.
    firsts = F.filter(hit, lambda x, i: (i == 0) | (F.get(hit, i - 1) != x - 1))
    lasts = F.filter(hit, lambda x, i: (i == F.size(hit) - 1) | (F.get(hit, i + 1) != x + 1))
    cut = F.struct(alnum_split(text).alias("words"), F.split(text, breaks).alias("gaps"), firsts.alias("firsts"), lasts.alias("lasts"))

    def joined(v: Column, pieces: Column) -> Column:
        def between(j: Column) -> Column:
            start = F.when(j == 0, 0).otherwise(F.get(v["lasts"], j - 1) + 1)
            end = F.coalesce(F.get(v["firsts"], j), F.size(pieces))
            return F.array_join(F.slice(pieces, start + 1, end - start), "")

        return F.array_join(F.transform(F.sequence(F.lit(0), F.size(v["firsts"])), between), "")

    def kept(v: Column) -> Column:
        pieces = F.transform(v["words"], lambda w, i: F.concat(w, F.get(v["gaps"], i + 1)))
        return F.concat(v["gaps"][0], let(pieces, lambda p: joined(v, p)))

    return F.trim(let(cut, kept))


def alnum_split(text: Column) -> Column:
    return F.array_remove(F.split(text, ALNUM_BREAK), "")


def remove(docs: DataFrame, items: DataFrame, window: int = WINDOW, what: str = "documents") -> DataFrame:
    """`docs` without the documents that hold a window (`documents`), or without the words inside windows (`spans`).

    All columns of `docs` stay; with `spans`, n_chars (if there) follows the new text.
    """
    if what not in ("documents", "spans"):
        raise ValueError(f"what must be documents or spans, not {what}")
    found = _by_row(docs, items, window)
    same = F.expr("_id <=> hit_id AND _row = hit_row")
    # Whole rows are one column, so that no name of theirs meets one of the hits'.
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("_id"), _row_key(F.col("text")).alias("_row"))
    if what == "documents":
        # The ids are few beside the texts; Spark broadcasts them if they are small.
        return rows.join(found.select("hit_id", "hit_row"), same, "left_anti").select("row.*")
    joined = rows.join(found, same, "left")
    text = F.when(F.col("hit").isNull(), F.col("row.text")).otherwise(_without(F.col("row.text"), F.col("hit")))
    out = joined.select(F.col("row").withField("text", text).alias("row"))
    if "n_chars" in docs.columns:
        out = out.withColumn("row", F.col("row").withField("n_chars", F.length("row.text").cast(docs.schema["n_chars"].dataType)))
    return out.select("row.*")

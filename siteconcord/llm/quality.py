"""Quality rules as a short-circuit cascade.

Every rule is an expression over a few numbers of a text; a document is kept if it passes all. How often a rule rejects
and how long it takes is measured on a bounded sample, then the rules are tried in the order of rejections per second
spent, and a row leaves at its first rejection (`CASE WHEN` evaluates no further branch). The order changes the time, never
the outcome. Everything is built-in functions.

Defined cases: null text has no words (and fails the base rule); an empty table gives an empty result and leaves the rules
in the order given; one row out for each row in, equal rows alike; other columns are ignored.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteconcord.llm.common import SPACE_BREAK, let, words
from siteconcord.session import materialized

# Bound of the sample on which costs and selectivities are estimated.
SAMPLE_ROWS = 2_000


@dataclass(frozen=True)
class Rule:
    """`rejects`: SQL condition over text, words and the numbers of `measures`."""

    name: str
    rejects: str


RULES: tuple[Rule, ...] = (
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("duplicate_lines", "n_lines >= 4 AND 10 * n_dup_lines > 5 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 30 * n_words"),
    Rule("no_letters", "2 * size(filter(words, w -> w rlike '\\\\p{L}')) < size(words)"),
    Rule("ellipses", "n_lines >= 4 AND 10 * size(filter(split(text, '\\n'), l -> l rlike '(\\\\.\\\\.\\\\.|…)\\\\s*$')) > 8 * n_lines"),
)


def repeated_words(cut: Column) -> Column:
    """How many words stand in a 3-word window that occurs twice or more in the text.

    Windows are 64-bit hashes. Only a text whose windows are not all distinct is looked at closer: its windows are sorted
    with their places, equal neighbours give the places, and each covers three words.
    """
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(cut) - 3), lambda i: F.xxhash64(cut[i], cut[i + 1], cut[i + 2])
    )

    def closer(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        places = let(
            ordered,
            lambda s: F.transform(
                F.filter(
                    s,
                    lambda x, k: ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | (F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))),
                ),
                lambda x: x["at"],
            ),
        )
        covered = F.array_distinct(F.flatten(F.transform(places, lambda p: F.array(p, p + 1, p + 2))))
        return F.size(covered)

    counted = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(closer(h)))
    return F.when(F.size(cut) < 3, 0).otherwise(counted).cast("long")


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, text, words and the numbers the rules use."""
    text = F.coalesce("text", F.lit(""))
    cut = docs.select("doc_id", text.alias("text"), words(F.col("text"), SPACE_BREAK).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counted = let(lines, lambda v: F.struct(F.size(v).alias("all"), F.size(F.array_distinct(v)).alias("distinct")))
    return cut.select(
        "doc_id",
        "text",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", SPACE_BREAK, "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        counted.alias("lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
    ).select("*", F.expr("bigint(lines.all) AS n_lines"), F.expr("bigint(lines.all - lines.distinct) AS n_dup_lines"))


def ordered_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per second on about `rows` documents drawn by a hash of their id, most first."""
    scale = 1 << 20
    drawn = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(scale))
    sample = materialized(measures(docs.filter(drawn < -(-rows * scale // max(docs.count(), 1)))), "sample")
    seconds, rejected = {}, {}
    for rule in rules:
        started = time.perf_counter()
        rejected[rule] = sample.filter(F.expr(rule.rejects)).count()
        seconds[rule] = time.perf_counter() - started
    return sorted(rules, key=lambda r: -rejected[r] / max(seconds[r], 1e-6))


def quality(docs: DataFrame, rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of `docs` (doc_id, text): the base numbers, base_failed, the first rule that rejects, kept."""
    docs = docs.select("doc_id", "text")
    cascade = F.when(F.col("base_failed"), F.lit("base"))
    for rule in ordered_rules(docs, rules, rows):
        cascade = cascade.when(F.expr(rule.rejects), F.lit(rule.name))
    measured = measures(docs).withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))
    judged = measured.withColumn("rejected_by", cascade)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.col("rejected_by").isNull().alias("kept")
    )

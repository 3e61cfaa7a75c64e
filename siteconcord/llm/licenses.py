"""License scans: which text blocks contain the words of a known license notice.

A template is the set of words of a published notice. A block is a line of a document, or, where a notice is wrapped, a
run of consecutive words across line breaks, so short that the template is at least `threshold` of its length. A block
meets a template when it holds at least `threshold` of the template's words. A line that does so by itself ends the runs
before and after it, and runs are taken from the left without overlap, each up to its last new word, so a notice counts once.

The join is exact. What a block holds its document holds, so documents meet the templates first, and only the pairs that
are left are looked at by lines and runs. Words are ordered by how many documents hold them, rarest first; only words of
templates can ever match, so only these are counted (a table bounded by the templates). Then

* length filter: a document with fewer template words than the overlap asked for is dropped;
* prefix filter: a template of n words that needs c of them must share one of its n - c + 1 rarest words with the document,
  so only those are in the index the documents' words are joined with (broadcast; its size is that of the templates);
* positional filter: what is left behind the first shared word on either side must still suffice; a run is only looked at
  where as many occurrences as words are asked for lie within its reach;
* the survivors are counted exactly.

Beside this the phrases of `PHRASES` are located as consecutive words. Everything is built-in functions.

Defined cases: null text is empty (no words, no label, score 0); an empty table gives an empty result; rows that share a
doc_id share the labels found in any of them; a null doc_id counts as one more id; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteconcord.llm.common import alnum_words, let

THRESHOLD = 0.8
# Closed places of one text that are kept in a list of their own.
_FEW = 256

# Fixed values of the query contract: phrase and label.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# First sentences of published license notices, and the one-line forms in use.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)


def _cut(text: str) -> list[str]:
    """The words of a template, cut as in documents."""
    cut = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return "".join(c if c.isalnum() or ord(c) > 127 else " " for c in cut).split()


def _template_words(texts: Sequence[tuple[str, str]]) -> list[tuple[str, list[str]]]:
    """(label, distinct words) with the words cut as in documents."""
    found = [(label, sorted(set(_cut(text)))) for label, text in texts]
    return [t for t in found if t[1]]


def _spans(texts: Sequence[tuple[str, str]], threshold: float) -> list[int]:
    """How many words a run may have, for each of `_template_words`."""
    lengths = [n for _, text in texts if (n := len(_cut(text)))]
    return [max(n, math.floor(n / threshold + 1e-9)) if threshold > 0 else n for n in lengths]


def _holders(docs: DataFrame, vocabulary: Sequence[str], least: int) -> DataFrame:
    """(doc_id, text, held): the template words of each document, in the order of `vocabulary`; length filter applied."""
    # array_intersect keeps the order of its first argument: the vocabulary's.
    held = F.array_intersect(F.array(*[F.lit(w) for w in vocabulary]), alnum_words(F.col("text")))
    return docs.select("doc_id", "text", held.alias("held")).filter(F.size("held") >= least)


def word_frequencies(docs: DataFrame, vocabulary: Sequence[str]) -> dict[str, int]:
    """How many documents of the corpus hold each word of the vocabulary; one row per word reaches the driver."""
    counted = _holders(docs, vocabulary, 1).select(F.explode("held").alias("word")).groupBy("word").count()
    return {**dict.fromkeys(vocabulary, 0), **{r["word"]: r["count"] for r in counted.collect()}}


def _runs(occurrences: Column, needed: Column, span: Column) -> Column:
    """The runs that meet the template: places (block, overlap) from the left; `occurrences` are (pos, block, word) in order."""

    def run(x: Column, i: Column) -> Column:
        # No two occurrences share a position, so a run holds at most `span` of them.
        reached = F.filter(F.slice(occurrences, i + 1, span), lambda y: y["pos"] < x["pos"] + span)

        def described(r: Column) -> Column:
            words = F.transform(r, lambda y: y["word"])
            distinct = F.array_distinct(words)
            last = r[F.array_position(words, F.element_at(distinct, -1)).cast("int") - 1]["pos"]
            return F.struct(x["pos"].alias("pos"), last.alias("last"), x["block"].alias("block"), F.size(distinct).alias("overlap"))

        # Fewer occurrences than words asked for, repeated ones included, need no look.
        return F.when(F.get(occurrences, i + needed - 1)["pos"] < x["pos"] + span, let(reached, described))

    # Closed places go to a short list and full lists to a list of lists, so that closing one copies few of the others.
    one = "struct<last:int,block:int,overlap:int>"
    none = F.array().cast(f"array<{one}>")
    start = F.struct(F.lit(None).cast(one).alias("open"), none.alias("few"), F.array().cast(f"array<array<{one}>>").alias("full"))

    def shut(state: Column) -> Column:
        return F.when(state["open"].isNull(), none).otherwise(F.array(state["open"]))

    def taken(state: Column, x: Column) -> Column:
        last = state["open"]
        begins = F.coalesce(last["last"] < x["pos"], F.lit(True))
        # A later run inside a place may hold more of the template's words.
        better = F.struct(last["last"].alias("last"), last["block"].alias("block"), F.greatest(last["overlap"], x["overlap"]).alias("overlap"))
        place = F.when(begins, F.struct(x["last"].alias("last"), x["block"].alias("block"), x["overlap"].alias("overlap"))).otherwise(better)
        many = F.size(state["few"]) >= _FEW
        few = F.when(~begins, state["few"]).when(many, shut(state)).otherwise(F.concat(state["few"], shut(state)))
        full = F.when(begins & many, F.concat(state["full"], F.array(state["few"]))).otherwise(state["full"])
        return F.struct(place.alias("open"), few.alias("few"), full.alias("full"))

    met = F.filter(F.transform(occurrences, run), lambda x: x["overlap"] >= needed)
    places = F.aggregate(met, start, taken, lambda state: F.concat(F.flatten(state["full"]), state["few"], shut(state)))
    return F.transform(places, lambda x: F.struct(x["block"].alias("block"), x["overlap"].alias("overlap")))


def matching_blocks(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, block, template, label, overlap, containment): every block that holds `threshold` of a template's words.

    `block` is the line, of a run the line it begins on.
    """
    sets = _template_words(templates)
    schema = "word string, template int, label string, at int, size int, needed int, span int, rare array<string>, members array<string>"
    vocabulary = sorted({w for _, members in sets for w in members})
    if not vocabulary:
        empty = docs.limit(0).select("doc_id", F.lit(0).alias("block"))
        return empty.selectExpr("doc_id", "block", "0 AS template", "'' AS label", "0 AS overlap", "0D AS containment")
    counts = word_frequencies(docs, vocabulary)
    order = sorted(vocabulary, key=lambda w: (counts[w], w))
    rank = {w: i for i, w in enumerate(order)}
    index, least = [], len(vocabulary)
    for number, ((label, members), span) in enumerate(zip(sets, _spans(templates, threshold))):
        members = sorted(members, key=rank.__getitem__)
        # Rounding must not ask for more than the threshold does.
        needed = max(1, math.ceil(threshold * len(members) - 1e-9))
        least = min(least, needed)
        rare = members[: len(members) - needed + 1]
        for at, word in enumerate(rare):
            index.append((word, number, label, at, len(members), needed, span, rare, members))
    prefixes = docs.sparkSession.createDataFrame(index, schema)
    probes = _holders(docs, order, least).select("doc_id", "text", "held", F.posexplode("held").alias("there", "word"))
    # Both sides are in one order, so the first shared word is the only one that is looked at.
    near = probes.join(F.broadcast(prefixes), "word").filter(
        "1 + least(size - 1 - at, size(held) - 1 - there) >= needed AND size(array_intersect(held, members)) >= needed "
        "AND array_intersect(held, rare)[0] = word"
    )
    cut = F.transform(F.split("text", "\n"), lambda line: alnum_words(line))
    lines = near.select("doc_id", "template", "label", "size", "needed", "span", "members", cut.alias("lines"))
    lines = lines.withColumn("overlaps", F.transform("lines", lambda ws: F.size(F.array_intersect(F.col("members"), ws))))
    alone = F.filter(
        F.transform("overlaps", lambda n, i: F.struct(i.alias("block"), n.alias("overlap"))), lambda x: x["overlap"] >= F.col("needed")
    )

    def tokens(ws: Column, i: Column) -> Column:
        # No run reaches across a line that meets the template by itself.
        kept = F.when(F.col("overlaps")[i] >= F.col("needed"), F.array_repeat(F.lit(""), F.col("span"))).otherwise(ws)
        return F.transform(kept, lambda w: F.struct(i.alias("block"), w.alias("word")))

    placed = F.transform(
        F.flatten(F.transform("lines", tokens)),
        lambda x, pos: F.struct(pos.alias("pos"), x["block"].alias("block"), x["word"].alias("word")),
    )
    lines = lines.select(
        "doc_id", "template", "label", "size", "needed", "span", alone.alias("alone"),
        F.filter(placed, lambda x: F.array_contains(F.col("members"), x["word"])).alias("occurrences"),
    )
    blocks = lines.select("doc_id", "template", "label", "size", F.explode(F.concat("alone", _runs(F.col("occurrences"), F.col("needed"), F.col("span")))).alias("b"))
    return blocks.selectExpr("doc_id", "b.block", "template", "label", "b.overlap", "b.overlap / size AS containment")


def phrase_starts(words: Column, phrase: str) -> Column:
    """Where the words of the phrase stand consecutively, from 0."""
    parts = phrase.split(" ")

    def stands(i: Column) -> Column:
        test = F.lit(True)
        for k, part in enumerate(parts):
            test = test & (words[i + k] == part)
        return test

    places = F.sequence(F.lit(0), F.size(words) - len(parts))
    return F.when(F.size(words) >= len(parts), F.filter(places, stands)).otherwise(F.array().cast("array<int>"))


def license_scan(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of `docs` (doc_id, text): phrase places, labels of phrases and of matching blocks, best score."""
    docs = docs.select("doc_id", "text")
    cut = docs.select("doc_id", alnum_words(F.col("text")).alias("words"))
    common = set.intersection(*[set(p.split(" ")) for p in phrases]) if phrases else set()
    # Without the word all phrases share there is nothing to look for.
    maybe = F.array_contains("words", min(common)) if common else F.lit(bool(phrases))
    none = F.array().cast("array<int>")
    places = cut.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        *[F.when(maybe, phrase_starts(F.col("words"), p)).otherwise(none).alias(f"at{i}") for i, p in enumerate(phrases)],
    )
    every = F.flatten(F.array(*[F.col(f"at{i}") for i in range(len(phrases))])) if phrases else none
    labels = [F.when(F.size(f"at{i}") > 0, F.lit(label)) for i, label in enumerate(phrases.values())]
    based = places.select(
        "doc_id",
        "n_words",
        every.alias("places"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))).alias("base") if labels else F.array().cast("array<string>").alias("base"),
    )
    found = matching_blocks(docs, templates, threshold).groupBy("doc_id").agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("best"), F.count(F.lit(1)).alias("n_blocks")
    )
    found = found.withColumnRenamed("doc_id", "found_id")
    joined = based.join(found, F.expr("doc_id <=> found_id"), "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"),
    )

"""op11 to op13 against brute force, on odd rows and on empty tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from siteconcord.llm import divergence, manifest, near_dedup
from siteconcord.operators import skew

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, id long, key string, tree string, item string, place long, comp long"
TEXTS = [None, "", " \n", "a", "tie tie", "tie tie", "x " * 40_000, "Alpha beta GAMMA delta epsilon zeta", "ÄÖ ſecret K ünïcode", "alpha beta gamma delta epsilon zeta"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None if i == 3 else "en", None if i == 4 else "s", None if i == 5 else 0, 1, 2, "k", "t", "i", 3, 4) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[3], (None, "tie tie", "en", "s", 0, 1, 2, "k", "t", "i", 3, 4)], SCHEMA).repartition(3)


# --- near duplicates ----------------------------------------------------------------------------------------------------


def brute_components(rows, k, percent):
    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()

    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        same = rows[i][0] is not None and rows[i][0] == rows[j][0] and sets[i] and sets[j]
        if same or sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            up[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)] = min(doc_id, least.get(top(i), doc_id))
    return sorted(((d, len(s), least.get(top(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def copies(seed, groups, per):
    """Groups of texts with edits of their own around one text, so that some link only through others."""
    draw = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{draw.randrange(5_000)}" for _ in range(draw.randrange(40, 160))]
        for _ in range(per):
            words = list(base)
            for _ in range(draw.randrange(0, 5)):
                words[draw.randrange(len(words))] = f"e{draw.randrange(10**9)}"
            rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize("percent", [85, 70])
def test_near_duplicates_against_all_pairs(spark, percent):
    rows = copies(7, 12, 25)
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent).collect()
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=repr)
    assert got == brute_components(rows, 5, percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_near_duplicates_odd(spark, odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    found = near_dedup.near_duplicates(odd).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=repr) == brute_components(rows, 5, 85)
    assert near_dedup.near_duplicates(odd.limit(0)).collect() == []
    unknown = spark.createDataFrame([(None, "only here and nowhere else at all")], "doc_id long, text string")
    assert [(r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(unknown).collect()] == [(None, True)]


def test_rows_of_one_id_are_one_document(spark):
    rows = [(3, "a b c d e f"), (5, "a b c d e f"), (5, "q r s t u v w"), (9, "q r s t u v w"), (7, "other words that stand alone here")]
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["component_id"]) for r in found} == {(3, 3), (5, 3), (9, 3), (7, 7)}


def test_tables_meet_as_computed():
    """Pairs at the threshold meet in a table as often as the tensored keys promise, with far fewer tables than the default."""
    draw = np.random.default_rng(1)
    m, met, trials = 3, 0, 400
    for _ in range(trials):
        members = draw.integers(-(1 << 62), 1 << 62, 1_080)
        keys = near_dedup.small_keys(near_dedup.minhashes([members[:1_000], members[80:]], 2 * m * near_dedup.ROWS), near_dedup.ROWS)
        same = keys[0] == keys[1]
        met += bool(same[:m].any() and same[m:].any())
    s = 920 / 1_080
    expected = (1 - (1 - s**near_dedup.ROWS) ** m) ** 2
    assert abs(met / trials - expected) < 0.06
    size = near_dedup.collection_size(85)
    assert 2 * (1 - 0.85**near_dedup.ROWS) ** size <= near_dedup.MISS < 2 * (1 - 0.85**near_dedup.ROWS) ** (size - 1)


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_fanned_join(spark, how):
    left = spark.range(3_000).selectExpr("CASE WHEN id % 3 = 0 THEN 1 WHEN id % 500 = 1 THEN NULL ELSE id END AS k", "id")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k long, v string")
    plain = left.join(right, "k", how)
    got = skew.fanned_join(left, right, "k", 50, how)
    assert sorted(map(repr, got.select(plain.columns).collect())) == sorted(map(repr, plain.collect()))


# --- divergence ---------------------------------------------------------------------------------------------------------


def brute_divergence(rows, min_docs, top):
    held, docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        held[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang in {g[0] for g in held}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        groups = {s: held[lang, s] for x, s in held if x == lang}
        whole = sum(groups.values(), Counter())

        def p(counts, kept=kept):
            total = sum(counts[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // total for t in kept}

        of, q = {s: p(c) for s, c in groups.items()}, p(whole)
        for s in groups:
            pairs = [(o, sum(abs(of[s][t] - of[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, of[s][t] - q[t]) for t in kept if groups[s][t] and of[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


@pytest.mark.parametrize("min_docs", [1, 3])
def test_divergence_against_all_terms(spark, min_docs):
    draw = random.Random(5)
    words = [f"{c}{d}" for c in "abcdefghij" for d in ("ä", "x", "Q")]
    rows = [(i, " ".join(draw.choices(words[: draw.randrange(3, 30)], k=draw.randrange(0, 40))), draw.choice(["en", "de", None]), f"s{draw.randrange(9)}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    got = divergence.divergence(docs, min_docs, 5).select("lang", "source", "part", "item", "value", "rank")
    assert sorted(map(tuple, got.collect())) == brute_divergence(rows, min_docs, 5)


def test_divergence_odd(odd):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in odd.collect()]
    for min_docs in (1, 2, 30):
        got = divergence.divergence(odd, min_docs).select("lang", "source", "part", "item", "value", "rank").collect()
        assert sorted(map(tuple, got)) == brute_divergence(rows, min_docs, 50)
    assert divergence.divergence(odd.limit(0)).collect() == []


def test_tree_shares_paths():
    """Rows that share a path are set against its ancestors once: as many corrections as node-ancestor pairs."""
    item = lambda s, n: {"source": s, "n": n, "p": 10 * n, "p0": 1}
    tree = divergence._Tree()
    tree.lang = "en"
    for items, many in [([item("a", 1), item("b", 1)], 4), ([item("a", 1), item("b", 1), item("c", 2)], 3), ([item("a", 1), item("c", 1)], 2)]:
        tree.insert(items, many)
    tree.cut(0)
    assert tree.gathered == 4
    sums = tree.sums()
    got = {(r["source"], r["item"]): r["part_value"] for r in sums.to_pylist()}
    rest = lambda p, q: abs(p - q) - abs(p - 1) - abs(1 - q)
    assert got == {("a", "b"): 7 * rest(10, 10), ("a", "c"): 3 * rest(10, 20) + 2 * rest(10, 10), ("b", "c"): 3 * rest(10, 20)}


# --- manifest -----------------------------------------------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(hashes, arity):
    """(top, proof of each leaf as levels of (before, after))."""
    proofs, of = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        for i, place in enumerate(of):
            run = hashes[place // arity * arity : (place // arity + 1) * arity]
            proofs[i].append(("".join(run[: place % arity]), "".join(run[place % arity + 1 :])))
        hashes = [sha(*hashes[i : i + arity]) for i in range(0, len(hashes), arity)]
        of = [place // arity for place in of]
    return hashes[0], proofs


def brute_manifest(rows, arity):
    def leaf(doc_id, source, lang, n_chars, text):
        return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])

    trees = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        hit = doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        changed = re.sub("[A-Z]", lambda m: m[0].lower(), text) if hit else text
        trees[lang].append((doc_id, leaf(doc_id, source, lang, n_chars, text), leaf(doc_id, source, lang, n_chars, changed)))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for name in names:
        trees[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    parts = {name: brute_tree([h for _, h, _ in trees[name]], arity) for name in names}
    root, above = brute_tree([parts[name][0] for name in names], arity)
    out = []
    for name, up in zip(names, above):
        for (doc_id, h, found), proof in zip(trees[name], parts[name][1]):
            whole = proof + up
            fold = found
            for before, after in whole:
                fold = sha(before, fold, after)
            out.append((doc_id, h, parts[name][0], root, sha(*[b + a for b, a in whole]), fold, fold == root))
    return sorted(out, key=repr)


def listed_manifest(docs, arity):
    found = manifest.manifest(docs, manifest.tampered_text(), arity).withColumn(
        "proof_sha256", F.expr("sha2(array_join(transform(proof, s -> concat(s.before, s.after)), ''), 256)")
    )
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[n] for n in names) for r in found.collect()), key=repr)


@pytest.mark.parametrize("arity", [2, 3, 8])
def test_manifest_against_a_list(spark, arity):
    draw = random.Random(arity)
    rows = [(i, f"Text {i}", draw.choice(["en"] * 9 + ["de", None, *(f"l{k}" for k in range(9))]), "s", i) for i in draw.sample(range(1_000), 260)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    assert listed_manifest(docs, arity) == brute_manifest(rows, arity)


def test_manifest_odd(odd):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in odd.collect()]
    assert listed_manifest(odd, 8) == brute_manifest(rows, 8)
    assert manifest.manifest(odd.limit(0)).collect() == []
    assert {r["verified"] for r in manifest.manifest(odd).collect()} == {True}

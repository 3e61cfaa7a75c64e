"""The registered queries of this package and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteconcord.llm import (
    decontaminate,
    divergence,
    language,
    licenses,
    manifest,
    near_dedup,
    ngram_join,
    packing,
    quality,
    secret_scan,
    sharding,
    urls,
    warc,
)
from siteconcord.llm.common import table
from siteconcord.session import new_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


# --- SQL of the other side --------------------------------------------------------------------------------------------

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACED = r"[^\x20\x09-\x0D]+"


def _starts(phrase: str) -> str:
    parts = phrase.split(" ")
    test = " AND ".join(f"w[i + {k}] = '{p}'" for k, p in enumerate(parts, 1))
    return f"list_filter(range(len(w) - {len(parts) - 1}), lambda i: {test})"


def _templates_sql() -> str:
    rows = []
    for number, (label, members) in enumerate(licenses._template_words(licenses.TEMPLATES)):
        listed = ", ".join(f"'{w}'" for w in members)
        rows.append(f"({number}, '{label}', [{listed}])")
    return ", ".join(rows)


_PHRASES = list(licenses.PHRASES.items())
LICENSE_SQL = f"""
WITH d AS (SELECT doc_id, text, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
t(template, label, members) AS (VALUES {_templates_sql()}),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text FROM documents),
b AS (SELECT doc_id, list_distinct(regexp_extract_all({_LOWER}, '{_ALNUM}')) AS held FROM lines),
m AS (SELECT doc_id, label, len(list_intersect(held, members)) AS overlap, len(members) AS size
      FROM b, t WHERE 10 * len(list_intersect(held, members)) >= 8 * len(members)),
f AS (SELECT doc_id, list(DISTINCT label) AS more, max(overlap / size) AS best, count(*) AS n_blocks FROM m GROUP BY doc_id),
p AS (SELECT doc_id, w, {", ".join(f"{_starts(p)} AS at{i}" for i, (p, _) in enumerate(_PHRASES))} FROM d),
q AS (SELECT doc_id, w, list_concat(list_concat(at0, at1), at2) AS places,
  list_sort(list_filter([{", ".join(f"CASE WHEN len(at{i}) > 0 THEN '{label}' END" for i, (_, label) in enumerate(_PHRASES))}], lambda x: x IS NOT NULL)) AS base FROM p)
SELECT q.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
  CAST(list_min(places) AS BIGINT) AS first_word, CAST(list_max(places) AS BIGINT) AS last_word,
  coalesce(array_to_string(base, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(base, coalesce(more, [])))), ','), '') AS labels,
  CASE WHEN len(base) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0)::DOUBLE END AS score,
  coalesce(n_blocks, 0)::BIGINT AS n_blocks
FROM q LEFT JOIN f USING (doc_id)"""

JACCARD_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACED}') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(len(w) - 3), lambda i: w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4]) END) AS g FROM d),
sizes AS (SELECT doc_id, len(g) AS n FROM s),
x AS (SELECT doc_id, unnest(g) AS h FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM x a JOIN x b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN sizes sa ON sa.doc_id = a JOIN sizes sb ON sb.doc_id = b WHERE 100 * o >= 85 * (sa.n + sb.n - o)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT s.doc_id, CAST(n AS BIGINT) AS n_shingles, c.component_id
FROM sizes s JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) c USING (doc_id)"""

CONTAMINATION_SQL = f"""
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[j + 1 : j + least(len(w), 10)], ' ') AS g
       FROM (SELECT *, unnest(range(len(w) - least(len(w), 10) + 1)) AS j FROM i WHERE len(w) > 0)),
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
ks AS (SELECT DISTINCT k FROM iw),
dw AS (SELECT doc_id, k, j, array_to_string(w[j + 1 : j + k], ' ') AS g
       FROM (SELECT doc_id, w, k, unnest(range(len(w) - k + 1)) AS j FROM d, ks WHERE len(w) >= k)),
h AS (SELECT doc_id, j, k, item_id FROM dw JOIN iw USING (k, g)),
hw AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(j, j + k)) AS x FROM h) GROUP BY doc_id),
hi AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id)), ',') AS ids FROM h GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)"""

WARC_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
o AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS owner FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND owner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND owner <> page_id THEN owner END AS refers_to
FROM o"""

# Hosts with such a label are listed: the pages' own URLs, so the list grows with the input.
JUNK_HOST = r"(^|[.])(spam-farm|cheap-pills|casino|free-money|malware)[.]"
URL_SQL = rf"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
c AS (SELECT page_id, url,
    translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    list_sort(list_filter(string_split(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1), '&'),
      lambda q: q <> '' AND NOT regexp_matches(q, '^(utm_\w+|ref)='))) AS q FROM u),
k AS (SELECT *, regexp_replace(host, '^www\.', '') || regexp_replace(path, '(/|\.html)$', '') ||
    CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS canon FROM c),
listed AS (SELECT DISTINCT canon FROM k WHERE regexp_matches(host, '{JUNK_HOST}')),
r(rule_host, rule_path, verdict) AS (VALUES {", ".join(str(r) for r in urls.RULES)}),
m AS (SELECT page_id, url, max({{'size': length(rule_host || rule_path), 'host': length(rule_host), 'rule': rule_host || rule_path, 'verdict': verdict}}) AS best
  FROM k JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY ALL)
SELECT DISTINCT k.page_id, host, path, best.rule AS rule,
  coalesce(best.verdict, CASE WHEN host <> '' AND listed.canon IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
  host <> '' AND listed.canon IS NOT NULL AS url_listed
FROM k LEFT JOIN m USING (page_id, url) LEFT JOIN listed ON listed.canon = k.canon"""

QUALITY_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{_SPACED}')) AS lines FROM documents),
g AS (SELECT doc_id, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS g FROM (SELECT doc_id, w, unnest(range(len(w) - 2)) AS i FROM d)),
many AS (SELECT doc_id, unnest([i, i + 1, i + 2]) AS i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
r AS (SELECT doc_id, count(DISTINCT i) AS n_repeat FROM many GROUP BY doc_id),
m AS (SELECT d.*, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > 3 * n_words OR (n_lines >= 4 AND 10 * n_dup_lines > 5 * n_lines)
    OR word_chars < 2 * n_words OR word_chars > 30 * n_words
    OR 2 * len(list_filter(w, lambda x: regexp_matches(x, '\\p{{L}}'))) < len(w)
    OR (n_lines >= 4 AND 10 * len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…)\\s*$'))) > 8 * n_lines)) AS kept
FROM b"""

NEAR_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACED}') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1 : i + 5], ' ')) END) AS g FROM d),
sizes AS (SELECT doc_id, len(g) AS n FROM s),
x AS (SELECT doc_id, unnest(g) AS h FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM x a JOIN x b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN sizes sa ON sa.doc_id = a JOIN sizes sb ON sb.doc_id = b WHERE 100 * o >= 85 * (sa.n + sb.n - o)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT s.doc_id, CAST(n AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sizes s JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) c USING (doc_id)"""

_TERMS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
DIVERGENCE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all({_LOWER}, '{_TERMS}') AS w,
    row_number() OVER () AS r FROM documents),
w AS (SELECT lang, source, r, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {divergence.MIN_DOCS}),
v AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, CAST(sum(n) AS HUGEINT) AS n_lang FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY lang, source, term),
t AS (SELECT lang, source, CAST(sum(n) AS HUGEINT) AS n_kept FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + ({divergence.SCALE}::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(n_kept, 0) + 5 * v) AS p,
    1 + ({divergence.SCALE}::HUGEINT * (k.n + 5)) // (n_lang + 5 * v) AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN t ON t.lang = g.lang AND t.source = g.source
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM o
QUALIFY part = 'pair' OR rank <= {divergence.TOP_TERMS}"""


def _merkle_levels(name: str, levels: int) -> str:
    """CTEs that fold the nodes {name}0 (tree, place, n, h) run by run; a tree of one node stays as it is."""
    parts = []
    for i in range(levels):
        nodes = f"{name}{i}"
        run = "PARTITION BY tree, place // 8 ORDER BY place"
        listed = f"string_agg(h, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        behind = f"string_agg(h, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
        parts.append(f"""{name}s{i} AS (SELECT tree, place, n, h, CASE WHEN n > 1 THEN coalesce({listed}, '') ELSE '' END AS before,
  CASE WHEN n > 1 THEN coalesce({behind}, '') ELSE '' END AS after FROM {nodes}),
{name}{i + 1} AS (SELECT tree, place // 8 AS place, (n + 7) // 8 AS n,
  CASE WHEN n > 1 THEN sha256(before || h || after) ELSE h END AS h FROM {name}s{i} WHERE place % 8 = 0)""")
    return ",\n".join(parts)


def _merkle_folds(alias: str, name: str, levels: int, place: str, start: str) -> tuple[list[str], str, str]:
    """(joins, proof, fold) of the path from a place of {name}0 to its top."""
    joins, proof, fold = [], [], start
    for i in range(levels):
        s = f"{alias}{i}"
        joins.append(f"JOIN {name}s{i} {s} ON {s}.tree = {{tree}} AND {s}.place = {place} // {8**i}")
        proof.append(f"{s}.before || {s}.after")
        fold = f"CASE WHEN {s}.n > 1 THEN sha256({s}.before || {fold} || {s}.after) ELSE {fold} END"
    return joins, " || ".join(proof), fold


def _manifest_sql(levels: int, top_levels: int) -> str:
    field = lambda f: f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen(CAST({f} AS VARCHAR)) || ':' || {f} END"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    head = " || ".join(field(f) for f in manifest.FIELDS[:-1])
    joins, proof, _ = _merkle_folds("a", "l", levels, "d.place", "")
    tops, top_proof, _ = _merkle_folds("b", "r", top_levels, "t.place", "")
    # The fold is taken step by step: one column each, so that the text of the SQL stays short.
    steps, last = [], "found"
    for i, alias in [(i, f"a{i}") for i in range(levels)] + [(i, f"b{i}") for i in range(top_levels)]:
        steps.append(f"CASE WHEN {alias}_n > 1 THEN sha256({alias}_before || {last} || {alias}_after) ELSE {last} END AS f_{alias}")
        last = f"f_{alias}"
    kept = ", ".join(f"{a}.n AS {a}_n, {a}.before AS {a}_before, {a}.after AS {a}_after" for a in [f"a{i}" for i in range(levels)] + [f"b{i}" for i in range(top_levels)])
    return f"""
WITH crc(tab) AS (SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))),
x AS (SELECT *, xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: ascii(CAST(doc_id AS VARCHAR)[i]))),
    lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS code FROM documents, crc),
y AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256({head} || {field("text")}) AS h,
  sha256({head} || CASE WHEN code % 3 = 0 THEN {field(lowered)} ELSE {field("text")} END) AS found FROM x),
d AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n FROM y),
l0 AS (SELECT tree, place, n, h FROM d),
{_merkle_levels("l", levels)},
t AS (SELECT tree AS language, h, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM l{levels}),
r0 AS (SELECT '' AS tree, place, n, h FROM t),
{_merkle_levels("r", top_levels)},
m AS (SELECT d.doc_id, d.h AS leaf, d.found, t.h AS subroot, (SELECT h FROM r{top_levels}) AS root, sha256({proof} || {top_proof}) AS proof_sha256, {kept}
  FROM d JOIN t ON t.language = d.tree {" ".join(j.format(tree="d.tree") for j in joins)} {" ".join(j.format(tree="''") for j in tops)}),
{", ".join(f"m{i} AS (SELECT *, {step} FROM {f'm{i - 1}' if i else 'm'})" for i, step in enumerate(steps))}
SELECT doc_id, leaf, subroot, root, proof_sha256, {last} AS folded_root, {last} = root AS verified FROM m{len(steps) - 1}"""


# Enough for 8^7 rows a language and 8^3 languages.
MANIFEST_SQL = _manifest_sql(7, 3)


# --- the queries ------------------------------------------------------------------------------------------------------


@query("op1_license_scan", LICENSE_SQL)
def op1(spark, sf_dir):
    return licenses.license_scan(table(spark, sf_dir, "documents"))


@query("op2_ngram_jaccard", JACCARD_SQL)
def op2(spark, sf_dir):
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


@query("op3_secret_scan")
def op3(spark, sf_dir):
    found = secret_scan.secret_spans(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secret_scan.BASE_RULES]
    listed = ", ".join(f"'{k}'" for k in base)
    text = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    return found.selectExpr(
        "doc_id",
        *[f"bigint(size(filter(spans, s -> s.kind = '{k}'))) AS n_{k}" for k in base],
        f"sha2({text.format(f'filter(spans, s -> s.kind IN ({listed}))')}, 256) AS base_sha256",
        f"{text.format('spans')} AS spans",
    )


@query("op4_decontamination", CONTAMINATION_SQL)
def op4(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_warc", WARC_SQL)
def op5(spark, sf_dir):
    archive = warc.write_archive(table(spark, sf_dir, "pages"), new_folder(spark, "archive"))
    return warc.described(warc.read_archive(spark, archive))


@query("op6_url_filter", URL_SQL)
def op6(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.filter(urls.host_of(F.col("url")).rlike(JUNK_HOST)).select("url")
    return urls.judge(pages, urls.RULES, listed)


def pack(docs: DataFrame) -> DataFrame:
    path = public_tokenizers.path
    return packing.pack(docs, path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op7_packing")
def op7(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))


@query("op8_quality", QUALITY_SQL)
def op8(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"))


@query("op9_sharding")
def op9(spark, sf_dir):
    placed = sharding.shards(table(spark, sf_dir, "documents"))
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@query("op10_language_id")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = language.held_out()
    model = language.fit(docs.filter(~out))
    return language.identify(docs, model).withColumn("held_out", F.coalesce(out, F.lit(False))).select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query("op11_near_dedup", NEAR_SQL)
def op11(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op12_divergence", DIVERGENCE_SQL)
def op12(spark, sf_dir):
    return divergence.divergence(table(spark, sf_dir, "documents"))


@query("op13_manifest", MANIFEST_SQL)
def op13(spark, sf_dir):
    found = manifest.manifest(table(spark, sf_dir, "documents"), manifest.tampered_text())
    digests = F.expr("array_join(transform(proof, s -> concat(s.before, s.after)), '')")
    return found.withColumn("proof_sha256", F.sha2(digests, 256)).drop("proof")


@query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)

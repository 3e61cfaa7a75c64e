"""Scalar functions and tag maps, over whole tables."""

from __future__ import annotations

from siteconcord.catalog.book import PARAMS, RUNS, Inputs, ctes, number_sql, query, sql_tags
from siteconcord.functions import display, hours, tags, text
from siteconcord.params import REF_KEY

# --- texts: the documents and the descriptions of the assets --------------------------------------------------------

_TEXTS = "texts AS (SELECT doc_id AS id, text FROM documents UNION ALL SELECT -1 - asset_ord AS id, SITE_DESCRIPTION AS text FROM assets)"
_SPACE = text.SPACE


def _texts(i: Inputs):
    documents = i.table("documents").selectExpr("doc_id AS id", "text")
    return documents.unionByName(i.assets.selectExpr("-1 - asset_ord AS id", "SITE_DESCRIPTION AS text"))


def clean_sql(c: str) -> str:
    for pattern, by in (("[\\r\\n]+", ". "), (f"{_SPACE}+", " "), ("\\s\\.", "."), ("\\.+", "."), (f"^{_SPACE}+|{_SPACE}+$", "")):
        c = f"regexp_replace({c}, '{pattern}', '{by}', 'g')"
    return c


def limited_sql(c: str) -> str:
    units = f"length({c}) + length(regexp_replace({c}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g'))"
    return f"CASE WHEN {c} <> '' AND {units} < 255 THEN {c} END"


def distinct_sql(values: str) -> str:
    """Distinct values in order of appearance, joined; null if none."""
    first = f"list_filter({values}, lambda v, n: list_position({values}, v) = n)"
    return f"CASE WHEN len({values}) > 0 THEN array_to_string({first}, '; ') END"


_EMAIL = "[a-zA-Z0-9._-]+@[a-zA-Z0-9._-]+\\.[a-zA-Z0-9._-]+"
# Fixed value: the phone pattern of functions.text for an engine without look-around.
_PHONE = (
    f"(?:\\+47{_SPACE}?)?(?:[0-9]{{2}}{_SPACE}?[0-9]{{2}}{_SPACE}?[0-9]{{2}}{_SPACE}?[0-9]{{2}}"
    f"|[0-9]{{3}}{_SPACE}?[0-9]{{2}}{_SPACE}?[0-9]{{3}})"
)


def emails_sql(c: str) -> str:
    found = f"list_filter(list_transform(regexp_extract_all({c}, '{_EMAIL}'), lambda m: regexp_replace(m, '\\.+', '.', 'g')), lambda m: length(m) < 255)"
    return distinct_sql(found)


def phones_sql(c: str) -> str:
    digits = f"list_transform(regexp_extract_all({c}, '{_PHONE}'), lambda m: regexp_replace(m, '{_SPACE}', '', 'g'))"
    shown = "'+47 ' || substr(m, 1, 2) || ' ' || substr(m, 3, 2) || ' ' || substr(m, 5, 2) || ' ' || substr(m, 7, 2)"
    return distinct_sql(f"list_transform(list_filter({digits}, lambda m: length(m) = 8), lambda m: {shown})")


_GREEN = f"(?i)(^|[^A-Za-z0-9_])gr(ø|Ø)nt({_SPACE}+rundt)?({_SPACE}+varme)?{_SPACE}*skap([^A-Za-z0-9_]|$)"


def _text_query(name: str, expression: str, sql: str, pre: str = "text AS t"):
    @query(name, f"{ctes('assets')}, {_TEXTS}, x AS (SELECT id, {pre} FROM texts) SELECT id, {sql} AS value FROM x")
    def over_texts(spark, sf):
        return _texts(Inputs(spark, sf)).selectExpr("id", f"{expression} AS value")


_text_query("clean_tag_value", text.clean_tag_value("text"), limited_sql("t"), f"{clean_sql('text')} AS t")
_text_query("extract_emails", f"array_join({text.extract_emails('text')}, '; ')", emails_sql("t"))
_text_query("extract_phones", f"array_join({text.extract_phones('text')}, '; ')", phones_sql("t"))
_text_query(
    "detect_cabinet",
    f"concat_ws('/', {text.cabinet_kind('text')}, {text.cabinet_colour('text')}, {text.cabinet_manufacturer('text')})",
    f"concat_ws('/', CASE WHEN t ILIKE '%rotaid%' THEN 'twist' END, CASE WHEN regexp_matches(t, '{_GREEN}') THEN 'green' END, CASE WHEN t ILIKE '%rotaid%' THEN 'Rotaid' END)",
)
_text_query(
    "xml_escape",
    text.xml_escape("text"),
    "replace(replace(replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&apos;')",
)


@query("yes_no", "SELECT item_id, CASE WHEN length(text) % 2 = 0 THEN 'Y' ELSE 'N' END AS flag FROM benchmark")
def yes_no(spark, sf):
    return Inputs(spark, sf).table("benchmark").selectExpr("item_id", f"{text.yes_no('(length(text) % 2 = 0)')} AS flag")


@query(
    "number_text",
    f"SELECT c_custkey, {number_sql('c_acctbal')} AS balance, {number_sql('CAST(c_custkey AS DOUBLE) / 1000')} AS share FROM customer",
)
def number_text(spark, sf):
    customers = Inputs(spark, sf).table("customer")
    share = text.number_text("double(c_custkey) / 1000")
    return customers.selectExpr("c_custkey", f"{text.number_text('c_acctbal')} AS balance", f"{share} AS share")


# --- opening hours ----------------------------------------------------------------------------------------------------


def _hhmm_sql(c: str) -> str:
    return f"CASE WHEN {c} BETWEEN 0 AND 2400 AND {c} % 100 < 60 THEN lpad(CAST({c} // 100 AS VARCHAR), 2, '0') || ':' || lpad(CAST({c} % 100 AS VARCHAR), 2, '0') END"


@query(
    "format_hhmm",
    f"{ctes('assets')} SELECT asset_ord, {_hhmm_sql('OPENING_HOURS_TUE_FROM')} AS tue, {_hhmm_sql('OPENING_HOURS_SUN_TO')} AS sun FROM assets",
)
def format_hhmm(spark, sf):
    return Inputs(spark, sf).assets.selectExpr(
        "asset_ord", f"{hours.format_hhmm('OPENING_HOURS_TUE_FROM')} AS tue", f"{hours.format_hhmm('OPENING_HOURS_SUN_TO')} AS sun"
    )


_DAY_ROWS = " UNION ALL ".join(
    f"SELECT asset_ord, {n} AS n, '{tag}' AS day, {_hhmm_sql(f'OPENING_HOURS_{day}_FROM')} || '-' || {_hhmm_sql(f'OPENING_HOURS_{day}_TO')} AS iv FROM assets"
    for n, (tag, day) in enumerate(zip(hours.DAYS, hours.REGISTRY_DAYS, strict=True))
)
# Gaps and islands over long rows, where the library folds inside the row.
HOURS_SQL = f"""days AS ({_DAY_ROWS}),
runs_of_days AS (SELECT asset_ord, iv, n - row_number() OVER (PARTITION BY asset_ord, iv ORDER BY n) AS island, n, day FROM days WHERE iv IS NOT NULL),
parts AS (SELECT asset_ord, min(n) AS n, CASE WHEN count(*) = 1 THEN min(day) ELSE arg_min(day, n) || '-' || arg_max(day, n) END || ' ' || iv AS part FROM runs_of_days GROUP BY asset_ord, iv, island),
week AS (SELECT asset_ord, string_agg(part, '; ' ORDER BY n) AS week FROM parts GROUP BY asset_ord)"""
_HOURS = "week || CASE OPENING_HOURS_CLOSED_HOLIDAYS WHEN 'Y' THEN '; PH off' WHEN 'N' THEN '; PH open' ELSE '' END"


@query("opening_hours", f"{ctes('assets')}, {HOURS_SQL} SELECT asset_ord, {_HOURS} AS opening_hours FROM assets LEFT JOIN week USING (asset_ord)")
def opening_hours(spark, sf):
    return Inputs(spark, sf).assets.selectExpr("asset_ord", f"{hours.opening_hours()} AS opening_hours")


@query("merge_day_runs", f"{ctes('assets')}, {HOURS_SQL} SELECT asset_ord, part FROM parts")
def merge_day_runs(spark, sf):
    runs = text.let(hours.day_intervals(), "w", hours.merge_day_runs("w"))
    return Inputs(spark, sf).assets.selectExpr("asset_ord", f"explode({runs}) AS part")


# Every asset is judged at an instant of its own, over two weeks with two public holidays in summer time.
_WALL = "(TIMESTAMP '2024-04-29 01:30:00' + INTERVAL 1 HOUR * CAST(asset_ord % 336 AS INTEGER) + INTERVAL 2 HOUR)"


@query(
    "opening_state",
    f"""{ctes('assets')}, {HOURS_SQL}, w AS (SELECT asset_ord, {_WALL} AS wall FROM assets),
    j AS (SELECT a.asset_ord, week, OPENING_HOURS_CLOSED_HOLIDAYS AS ph, CAST(wall AS DATE) IN (DATE '2024-05-01', DATE '2024-05-09') AS holiday,
      strftime(wall, '%H:%M') AS clock, d.iv FROM assets a JOIN w USING (asset_ord) LEFT JOIN week USING (asset_ord)
      LEFT JOIN days d ON d.asset_ord = a.asset_ord AND d.n = (dayofweek(wall) + 6) % 7)
    SELECT asset_ord, CASE WHEN week IS NULL THEN 'unspecified' WHEN holiday AND ph = 'Y' THEN 'closed' WHEN holiday AND ph = 'N' THEN 'open'
      WHEN clock >= substr(iv, 1, 5) AND clock < substr(iv, 7, 5) THEN 'open' ELSE 'closed' END AS state FROM j""",
)
def opening_state(spark, sf):
    at = "TIMESTAMP_NTZ'2024-04-29 01:30:00' + INTERVAL 1 HOUR * int(asset_ord % 336)"
    judged = Inputs(spark, sf).assets.selectExpr("asset_ord", f"{at} AS at", f"{hours.opening_hours()} AS opening_hours")
    return judged.selectExpr("asset_ord", f"{hours.opening_state('opening_hours', 'at')} AS state")


# --- tags ---------------------------------------------------------------------------------------------------------------

_LEVEL = number_sql("SITE_FLOOR_NUMBER")
_D_TEXT = "coalesce(SITE_DESCRIPTION, '')"
_ROTAID = f"{_D_TEXT} ILIKE '%rotaid%'"
MAPPED = (
    ("emergency", "'defibrillator'"),
    ("emergency:phone", "'113'"),
    (REF_KEY, "ASSET_GUID"),
    ("name", limited_sql(clean_sql("SITE_NAME"))),
    ("level", _LEVEL),
    ("defibrillator:location", limited_sql(clean_sql("SITE_DESCRIPTION"))),
    ("email", emails_sql(_D_TEXT)),
    ("phone", phones_sql(_D_TEXT)),
    ("opening_hours", _HOURS),
    ("defibrillator:cabinet", f"CASE WHEN {_ROTAID} THEN 'twist' END"),
    ("defibrillator:cabinet:colour", f"CASE WHEN regexp_matches({_D_TEXT}, '{_GREEN}') THEN 'green' END"),
    ("defibrillator:cabinet:manufacturer", f"CASE WHEN {_ROTAID} THEN 'Rotaid' END"),
)
MAPPED_SQL = sql_tags(*MAPPED)
# The same over the tags of a node in the same row.
MERGED_SQL = sql_tags(
    *((k, f"coalesce({v}, {k})") if k in ("name", "opening_hours") else (k, v) for k, v in MAPPED),
    *((k, k) for k in ("note", "fixme", "amenity")),
)


@query("level", f"{ctes('assets')} SELECT asset_ord, {_LEVEL} AS level FROM assets")
def level(spark, sf):
    return Inputs(spark, sf).assets.selectExpr("asset_ord", f"{tags.level('SITE_FLOOR_NUMBER')} AS level")


@query("map_asset_to_tags", f"{ctes('valid')}, {HOURS_SQL} SELECT asset_ord, {MAPPED_SQL} AS tags_text FROM valid LEFT JOIN week USING (asset_ord)")
def map_asset_to_tags(spark, sf):
    mapped = Inputs(spark, sf).valid.selectExpr("asset_ord", f"{tags.map_asset_to_tags(PARAMS)} AS tags")
    return mapped.selectExpr("asset_ord", f"{tags.tags_text('tags')} AS tags_text")


# Tags of each order: a current and a wanted value of three keys, some absent.
_A = "CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END"
_B = "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END"
_B2 = "CASE WHEN o_orderkey % 7 <> 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE 'X' END END"
_C2 = "CASE WHEN o_orderkey % 4 = 0 THEN 'new' END"


def _tagged(spark, sf):
    orders = Inputs(spark, sf).table("orders")
    return orders.selectExpr(
        "o_orderkey", f"{tags.tags_from([('a', _A), ('b', _B)])} AS current", f"{tags.tags_from([('b', _B2), ('c', _C2)])} AS wanted"
    )


@query(
    "tag_updates",
    f"""WITH o AS (SELECT o_orderkey, {_A} AS a, {_B} AS b, {_B2} AS b2, {_C2} AS c2 FROM orders)
    SELECT o_orderkey, {sql_tags(('b', 'CASE WHEN b2 IS DISTINCT FROM b THEN b2 END'), ('c', 'c2'))} AS updates FROM o""",
)
def tag_updates(spark, sf):
    return _tagged(spark, sf).selectExpr("o_orderkey", f"{tags.tags_text(tags.tag_updates('current', 'wanted'))} AS updates")


@query(
    "merge_tags",
    f"""WITH o AS (SELECT o_orderkey, {_A} AS a, {_B} AS b, {_B2} AS b2, {_C2} AS c2 FROM orders)
    SELECT o_orderkey, {sql_tags(('a', 'a'), ('b', 'coalesce(b2, b)'), ('c', 'c2'))} AS merged FROM o""",
)
def merge_tags(spark, sf):
    return _tagged(spark, sf).selectExpr("o_orderkey", f"{tags.tags_text(tags.merge_tags('current', 'wanted'))} AS merged")


@query(
    "apply_tag_updates",
    f"""WITH o AS (SELECT o_orderkey, {_A} AS a, {_B} AS b, {_C2} AS c2 FROM orders)
    SELECT o_orderkey, {sql_tags(('a', 'CASE WHEN o_orderkey % 2 = 0 THEN a END'), ('b', 'b'), ('c', 'c2'))} AS applied FROM o""",
)
def apply_tag_updates(spark, sf):
    # An update without a value removes its key.
    updates = f"map_concat({tags.tags_from([('c', _C2)])}, CASE WHEN o_orderkey % 2 = 1 THEN map('a', cast(NULL AS string)) ELSE {tags.NO_TAGS} END)"
    orders = Inputs(spark, sf).table("orders").selectExpr("o_orderkey", f"{tags.tags_from([('a', _A), ('b', _B)])} AS current", f"{updates} AS updates")
    return orders.selectExpr("o_orderkey", f"{tags.tags_text(tags.apply_tag_updates('current', 'updates'))} AS applied")


@query(
    "drop_undefined",
    f"WITH o AS (SELECT o_orderkey, {_A} AS a, {_B} AS b FROM orders) SELECT o_orderkey, {sql_tags(('a', 'a'), ('b', 'b'))} AS kept FROM o",
)
def drop_undefined(spark, sf):
    orders = Inputs(spark, sf).table("orders").selectExpr("o_orderkey", f"map('a', {_A}, 'b', {_B}) AS tags")
    return orders.selectExpr("o_orderkey", f"{tags.tags_text(tags.drop_undefined('tags'))} AS kept")


REST_SQL = sql_tags(*((k, k) for k in ("name", "note", "fixme", "amenity", "opening_hours")))
MOVED_SQL = sql_tags(("emergency", "'defibrillator'"), (REF_KEY, "ref"))


@query("split_aed_tags", f"{ctes('elements')} SELECT id, {MOVED_SQL} AS moved, {REST_SQL} AS rest FROM elements")
def split_aed_tags(spark, sf):
    moved, rest = tags.only_keys("tags", PARAMS.moved_keys), tags.without_keys("tags", PARAMS.moved_keys)
    return Inputs(spark, sf).elements.selectExpr("id", f"{tags.tags_text(moved)} AS moved", f"{tags.tags_text(rest)} AS rest")


@query(
    "sorted_tags",
    f"{ctes('elements')} SELECT id, array_to_string(list_filter(['amenity', 'emergency', CASE WHEN fixme IS NOT NULL THEN 'fixme' END, 'name'], lambda x: x IS NOT NULL AND (x <> 'amenity' OR amenity IS NOT NULL) AND (x <> 'name' OR name IS NOT NULL)), ',') AS keys FROM elements",
)
def sorted_tags(spark, sf):
    kept = tags.only_keys("tags", ("amenity", "emergency", "fixme", "name"))
    keys = f"array_sort(transform(map_keys({kept}), k -> collate(k, 'UNICODE')))"
    return Inputs(spark, sf).elements.selectExpr("id", f"array_join(transform({keys}, k -> collate(k, 'UTF8_BINARY')), ',') AS keys")


# --- wording ------------------------------------------------------------------------------------------------------------

_SECONDS = "CAST(floor(epoch(finished_at) - epoch(started_at) + 0.5) AS BIGINT)"


@query(
    "run_duration",
    f"""WITH runs AS ({RUNS}), d AS (SELECT id, {_SECONDS} AS s FROM runs)
    SELECT id, s AS seconds, CASE WHEN s IS NULL THEN '-' WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN (s // 60) || 'm ' || (s % 60) || 's' ELSE (s // 3600) || 'h ' || (s // 60 % 60) || 'm' END AS label FROM d""",
)
def run_duration(spark, sf):
    ends = ("started_at", "finished_at")
    return Inputs(spark, sf).runs.selectExpr("id", f"{display.duration_seconds(*ends)} AS seconds", f"{display.duration_label(*ends)} AS label")


def _phrase_sql(n: str, unit: str) -> str:
    amount = f"abs({n}) || ' {unit}' || CASE WHEN abs({n}) = 1 THEN '' ELSE 's' END"
    return f"CASE WHEN {n} < 0 THEN {amount} || ' ago' ELSE 'in ' || {amount} END"


@query(
    "relative_time",
    f"""WITH e AS (SELECT event_id, CAST(floor((epoch_ms(ts) - epoch_ms(TIMESTAMP '2024-01-16 00:00:00')) / 60000.0 + 0.5) AS BIGINT) AS mi FROM events),
    h AS (SELECT *, CAST(floor(mi / 60.0 + 0.5) AS BIGINT) AS h FROM e), d AS (SELECT *, CAST(floor(h / 24.0 + 0.5) AS BIGINT) AS d FROM h)
    SELECT event_id, CASE WHEN abs(mi) < 60 THEN CASE WHEN mi = 0 THEN 'this minute' ELSE {_phrase_sql('mi', 'minute')} END
      WHEN abs(h) < 24 THEN {_phrase_sql('h', 'hour')} WHEN d = 1 THEN 'tomorrow' WHEN d = -1 THEN 'yesterday' ELSE {_phrase_sql('d', 'day')} END AS label FROM d""",
)
def relative_time(spark, sf):
    events = Inputs(spark, sf).table("events")
    return events.selectExpr("event_id", f"""{display.relative_time('ts', "TIMESTAMP_NTZ'2024-01-16 00:00:00'")} AS label""")


@query("format_datetime", "SELECT event_id, strftime(ts, '%b %d, %Y, %I:%M %p') AS shown FROM events")
def format_datetime(spark, sf):
    return Inputs(spark, sf).table("events").selectExpr("event_id", f"{display.format_datetime('ts')} AS shown")


@query("format_number", "SELECT o_orderkey, format('{:,}', o_orderkey * 977) AS shown FROM orders")
def format_number(spark, sf):
    return Inputs(spark, sf).table("orders").selectExpr("o_orderkey", f"{display.format_count('o_orderkey * 977')} AS shown")


@query(
    "change_comment",
    f"""WITH runs AS ({RUNS}), l AS (SELECT id, list_filter([CASE WHEN created_count > 0 THEN 'Added' END, CASE WHEN updated_count > 0 THEN 'Modified' END, CASE WHEN deleted_count > 0 THEN 'Deleted' END], lambda x: x IS NOT NULL) AS l FROM runs)
    SELECT id, CASE len(l) WHEN 0 THEN 'Updated' WHEN 3 THEN 'Added, Modified, and Deleted' ELSE array_to_string(l, ' and ') END || ' defibrillators' AS comment FROM l""",
)
def change_comment(spark, sf):
    comment = display.change_comment("created_count", "updated_count", "deleted_count", "defibrillators")
    return Inputs(spark, sf).runs.selectExpr("id", f"{comment} AS comment")

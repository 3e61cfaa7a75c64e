"""Run log, dashboards and the point layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from siteconcord.catalog.book import PARAMS, RUNS, Inputs, ctes, number_sql, query
from siteconcord.catalog.fixtures import ISSUES_SQL, NOW
from siteconcord.functions.display import element_label, element_url
from siteconcord.operators import maplayer, runlog
from siteconcord.params import ISSUE_LABELS, STUCK_MESSAGE
from siteconcord.plans import maintenance
from siteconcord.plans.job import append_event
from siteconcord.session import materialized, new_folder
from siteconcord.sources.runlog import ISSUE_COLUMNS

_LOG = f"WITH runs AS ({RUNS}), issues AS ({ISSUES_SQL})"
_NOW = f"TIMESTAMP_NTZ'{NOW}'"
_TS = f"TIMESTAMP '{NOW}'"
_LATEST = "(SELECT id FROM runs ORDER BY started_at DESC, id LIMIT 1)"

# --- events of runs -----------------------------------------------------------------------------------------------------


def events_of(i: Inputs):
    """Run events from the runs: a start, two increments, and a completion unless it still runs."""
    halves = ", ".join(f"int({c} - {c} div 3)" for c in runlog.COUNTERS)
    thirds = ", ".join(f"int({c} div 3)" for c in runlog.COUNTERS)
    none = ", ".join("cast(NULL AS int)" for _ in runlog.COUNTERS)
    names = ", ".join(["kind", "at", "mode", "status", "error_message", *runlog.COUNTERS])
    return i.runs.selectExpr(
        "id AS run_id",
        f"""stack(4, 'start', started_at, mode, cast(NULL AS string), cast(NULL AS string), {none},
        'metrics', started_at, cast(NULL AS string), cast(NULL AS string), cast(NULL AS string), {halves},
        'metrics', started_at, cast(NULL AS string), cast(NULL AS string), cast(NULL AS string), {thirds},
        'complete', finished_at, cast(NULL AS string), status, error_message, {none}) AS ({names})""",
    ).filter("kind <> 'complete' OR at IS NOT NULL")


_COUNTERS = ", ".join(runlog.COUNTERS)


@query("run_state", f"{_LOG} SELECT id, started_at, finished_at, status, mode, error_message, {_COUNTERS} FROM runs")
def run_state(spark, sf):
    return runlog.run_state(events_of(Inputs(spark, sf)))


@query("run_counters", f"{_LOG} SELECT id AS run_id, {_COUNTERS} FROM runs")
def run_counters(spark, sf):
    return runlog.run_counters(events_of(Inputs(spark, sf)).filter("kind = 'metrics'"))


@query("orphan_events", f"{_LOG} SELECT id AS run_id, CASE WHEN finished_at IS NULL THEN 2 ELSE 3 END AS events FROM runs WHERE mode = 'live'")
def orphan_events(spark, sf):
    events = events_of(Inputs(spark, sf))
    return runlog.orphan_events(events.filter("kind <> 'start' OR mode <> 'live'"))


@query("append_run", f"{_LOG} SELECT id, started_at, 'running' AS status, mode, 0 AS created_count FROM runs WHERE id = {_LATEST}")
def append_run(spark, sf):
    latest = runlog.latest_run(Inputs(spark, sf).runs).first()
    folder = new_folder(spark, "run-events")
    append_event(spark, folder, latest["id"], "start", at=latest["started_at"], mode=latest["mode"])
    return runlog.run_state(spark.read.parquet(folder)).select("id", "started_at", "status", "mode", "created_count")


# --- queries over the log -----------------------------------------------------------------------------------------------


@query(
    "run_by_id",
    f"{_LOG} SELECT id, started_at, finished_at, status, mode, error_message, linked_aeds_count, updated_count, created_count, deleted_count FROM runs WHERE id = 'run-42'",
)
def run_by_id(spark, sf):
    return runlog.run_by_id(Inputs(spark, sf).runs, "run-42")


_RUN_LIST = "id, started_at, finished_at, status, mode, updated_count, created_count, deleted_count"


@query("recent_runs", f"{_LOG} SELECT {_RUN_LIST} FROM runs ORDER BY started_at DESC, id LIMIT 200")
def recent_runs(spark, sf):
    return runlog.recent_runs(Inputs(spark, sf).runs, 10_000)


@query("latest_run", f"{_LOG} SELECT id, started_at, status FROM runs ORDER BY started_at DESC, id LIMIT 1")
def latest_run(spark, sf):
    return runlog.latest_run(Inputs(spark, sf).runs).select("id", "started_at", "status")


@query("latest_success", f"{_LOG} SELECT id, finished_at, status FROM runs WHERE status = 'success' ORDER BY finished_at DESC NULLS LAST, id LIMIT 1")
def latest_success(spark, sf):
    return runlog.latest_success(Inputs(spark, sf).runs).select("id", "finished_at", "status")


_KIND = """CASE WHEN osm_node_id IS NULL THEN NULL WHEN issue_type <> 'osm_not_a_node' THEN 'node'
  WHEN details ->> '$.osmElementType' IN ('node', 'way', 'relation') THEN details ->> '$.osmElementType' END"""


@query("issue_element_type", f"{_LOG} SELECT id, {_KIND} AS kind FROM issues")
def issue_element_type(spark, sf):
    return Inputs(spark, sf).issues.selectExpr("id", f"{runlog.ISSUE_ELEMENT_TYPE} AS kind")


@query(
    "issue_links",
    f"""{_LOG}, k AS (SELECT id, osm_node_id AS node, {_KIND} AS kind FROM issues)
    SELECT id, 'https://www.openstreetmap.org/' || kind || '/' || node AS url, upper(kind[1]) || kind[2:] || ' ' || node AS label FROM k""",
)
def issue_links(spark, sf):
    kinds = Inputs(spark, sf).issues.selectExpr("id", "osm_node_id", f"{runlog.ISSUE_ELEMENT_TYPE} AS kind")
    return kinds.selectExpr("id", f"{element_url('kind', 'osm_node_id')} AS url", f"{element_label('kind', 'osm_node_id')} AS label")


_LABEL = "CASE issue_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ISSUE_LABELS.items()) + " ELSE issue_type END"


@query("issue_labels", f"{_LOG} SELECT id, {_LABEL} AS label FROM issues")
def issue_labels(spark, sf):
    return Inputs(spark, sf).issues.selectExpr("id", f"{runlog.issue_label()} AS label")


@query("issues_of_run", f"{_LOG} SELECT id, run_id, issue_type FROM issues WHERE run_id = {_LATEST}")
def issues_of_run(spark, sf):
    i = Inputs(spark, sf)
    return runlog.issues_of_run(i.issues, i.runs).select("id", "run_id", "issue_type")


_ISSUE_LIST = f"id, run_id, issue_type, severity, message, register_ref, osm_node_id, {_KIND} AS osm_element_type, created_at"


@query("run_issues", f"{_LOG} SELECT {_ISSUE_LIST} FROM issues ORDER BY created_at DESC, id LIMIT 400")
def run_issues(spark, sf):
    return runlog.run_issues(Inputs(spark, sf).issues)


@query("issue_type_counts", f"{_LOG} SELECT issue_type, CAST(count(*) AS INTEGER) AS count FROM issues GROUP BY issue_type")
def issue_type_counts(spark, sf):
    return runlog.issue_type_counts(Inputs(spark, sf).issues)


@query("issue_type_counts_of_run", f"{_LOG} SELECT issue_type, CAST(count(*) AS INTEGER) AS count FROM issues WHERE run_id = 'run-7' GROUP BY issue_type")
def issue_type_counts_of_run(spark, sf):
    return runlog.issue_type_counts(Inputs(spark, sf).issues, "run-7")


@query("issue_count", f"{_LOG} SELECT CAST(count(*) AS INTEGER) AS issue_count FROM issues WHERE run_id = {_LATEST}")
def issue_count(spark, sf):
    i = Inputs(spark, sf)
    return runlog.issue_count(i.issues, i.runs)


_STUCK = f"status = 'running' AND started_at < {_TS} - INTERVAL 3 HOUR"


@query(
    "mark_stuck",
    f"""{_LOG} SELECT id, CASE WHEN {_STUCK} THEN 'failed' ELSE status END AS status, CASE WHEN {_STUCK} THEN {_TS} ELSE finished_at END AS finished_at,
    CASE WHEN {_STUCK} THEN '{STUCK_MESSAGE}' ELSE error_message END AS error_message FROM runs""",
)
def mark_stuck(spark, sf):
    return runlog.mark_stuck(Inputs(spark, sf).runs, _NOW).select("id", "status", "finished_at", "error_message")


@query("prune", f"{_LOG} SELECT id, finished_at FROM runs WHERE finished_at IS NULL OR finished_at >= {_TS} - INTERVAL 30 DAY")
def prune(spark, sf):
    return runlog.prune(Inputs(spark, sf).runs, _NOW).select("id", "finished_at")


_LATER = "2024-02-08 00:00:00"


def _kept_log_sql(number: int, runs: str, at: str) -> str:
    """Runs after an upkeep, hanging ones marked, and how many of their events and issues there are."""
    hangs = f"status = 'running' AND started_at < TIMESTAMP '{at}' - INTERVAL 3 HOUR"
    return f"""m{number} AS (SELECT id, started_at, events + CASE WHEN {hangs} THEN 1 ELSE 0 END AS events, CASE WHEN {hangs} THEN 'failed' ELSE status END AS status,
    CASE WHEN {hangs} THEN TIMESTAMP '{at}' ELSE finished_at END AS finished_at, CASE WHEN {hangs} THEN '{STUCK_MESSAGE}' ELSE error_message END AS error_message FROM {runs}),
    k{number} AS (SELECT * FROM m{number} WHERE finished_at IS NULL OR finished_at >= TIMESTAMP '{at}' - INTERVAL 30 DAY)"""


@query(
    "log_maintenance",
    f"""{_LOG}, s AS (SELECT *, 3 + CASE WHEN finished_at IS NULL THEN 0 ELSE 1 END AS events FROM runs), {_kept_log_sql(1, "s", NOW)}, {_kept_log_sql(2, "k1", _LATER)},
    n AS (SELECT run_id, count(*) AS issues FROM issues GROUP BY run_id),
    b AS (SELECT 1 AS upkeep, * FROM k1 UNION ALL SELECT 2, * FROM k2)
    SELECT upkeep, id, status, finished_at, error_message, CAST(events AS BIGINT) AS events, coalesce(issues, 0) AS issues FROM b LEFT JOIN n ON run_id = id""",
)
def log_maintenance(spark, sf):
    """The log is stored by months, kept up twice at one time and once a month later, and read back each time."""
    i, home = Inputs(spark, sf), new_folder(spark, "kept-log")
    events, issues = f"{home}/events", f"{home}/issues"
    maintenance.store(events_of(i), events, maintenance.EVENT_PERIOD, "at", "month")
    of_runs = i.issues.drop("created_at").join(i.runs.selectExpr("id AS run_id", "started_at AS created_at"), "run_id")
    maintenance.store(of_runs, issues, maintenance.ISSUE_PERIOD, "created_at", "month")
    found = []
    for upkeep, times in enumerate(([NOW, NOW], [_LATER]), 1):
        for at in times:
            maintenance.maintain(spark, events, issues, ISSUE_COLUMNS, f"TIMESTAMP_NTZ'{at}'", unit="month")
        left = maintenance.stored(spark, events, runlog.EVENT_COLUMNS, maintenance.EVENT_PERIOD)
        counts = left.groupBy(F.col("run_id").alias("id")).agg(F.expr("count(*) AS events"))
        told = maintenance.stored(spark, issues, ISSUE_COLUMNS, maintenance.ISSUE_PERIOD)
        told = told.groupBy(F.col("run_id").alias("id")).agg(F.expr("count(*) AS issues"))
        state = runlog.run_state(left).select("id", "status", "finished_at", "error_message")
        rows = state.join(counts, "id", "full").join(told, "id", "full")
        found.append(materialized(rows.selectExpr(f"{upkeep} AS upkeep", "*").fillna(0, ["issues"]), "kept-log-state"))
    return found[0].unionByName(found[1])


# A later reference time, so that runs with issues expire too.
@query(
    "prune_cascade",
    f"{_LOG} SELECT id, run_id FROM issues WHERE run_id NOT IN (SELECT id FROM runs WHERE finished_at < TIMESTAMP '2024-02-05 00:00:00' - INTERVAL 30 DAY)",
)
def prune_cascade(spark, sf):
    i = Inputs(spark, sf)
    return runlog.prune_cascade(i.issues, i.runs, "TIMESTAMP_NTZ'2024-02-05 00:00:00'").select("id", "run_id")


@query(
    "overview_stats",
    f"""{_LOG}, l AS (SELECT * FROM runs ORDER BY started_at DESC, id LIMIT 1), s AS (SELECT * FROM runs WHERE status = 'success' ORDER BY finished_at DESC NULLS LAST, id LIMIT 1),
    n AS (SELECT CAST(count(*) AS INTEGER) AS n FROM issues WHERE run_id = {_LATEST})
    SELECT n AS open_issue_count, n AS total_issue_count, l.status AS latest_status, l.osm_aeds_count AS latest_osm, s.finished_at AS success_finished_at, s.registry_aeds_count AS success_registry FROM n, l, s""",
)
def overview_stats(spark, sf):
    i = Inputs(spark, sf)
    return runlog.overview_stats(i.runs, i.issues).selectExpr(
        "open_issue_count",
        "total_issue_count",
        "latest_run.status AS latest_status",
        "latest_run.osm_aeds_count AS latest_osm",
        "latest_success.finished_at AS success_finished_at",
        "latest_success.registry_aeds_count AS success_registry",
    )


@query(
    "overview_baseline",
    f"{_LOG} SELECT finished_at, status, registry_aeds_count, osm_aeds_count, linked_aeds_count FROM runs WHERE status = 'success' ORDER BY finished_at DESC NULLS LAST, id LIMIT 1",
)
def overview_baseline(spark, sf):
    i = Inputs(spark, sf)
    return runlog.overview_baseline(runlog.overview_stats(i.runs, i.issues))


_SECONDS = "CAST(floor(epoch(finished_at) - epoch(started_at) + 0.5) AS BIGINT)"
_DURATION = "CASE WHEN s IS NULL THEN '-' WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN (s // 60) || 'm ' || (s % 60) || 's' ELSE (s // 3600) || 'h ' || (s // 60 % 60) || 'm' END"
_SHOWN = "strftime({}, '%b %d, %Y, %I:%M %p')"


@query(
    "run_list_view",
    f"""{_LOG}, r AS (SELECT *, {_SECONDS} AS s FROM runs ORDER BY started_at DESC, id LIMIT 30)
    SELECT id, {_SHOWN.format('started_at')} AS started, status, mode, s AS duration_s, {_DURATION} AS duration, format('{{:,}}', updated_count) AS updated,
    format('{{:,}}', created_count) AS created, format('{{:,}}', deleted_count) AS deleted FROM r""",
)
def run_list_view(spark, sf):
    return runlog.run_list_view(Inputs(spark, sf).runs)


@query(
    "run_detail_view",
    f"""{_LOG}, r AS (SELECT *, {_SECONDS} AS s FROM runs WHERE id = 'run-8'),
    i AS (SELECT *, {_KIND} AS kind FROM issues WHERE run_id = 'run-8' ORDER BY created_at DESC, id LIMIT 400)
    SELECT r.id AS run_id, r.status, r.mode, {_DURATION} AS duration, r.error_message, format('{{:,}}', r.updated_count) AS updated, format('{{:,}}', r.created_count) AS created,
    format('{{:,}}', r.deleted_count) AS deleted, i.id AS issue_id, CASE WHEN i.id IS NOT NULL THEN {_LABEL} END AS label, i.severity, i.message,
    upper(kind[1]) || kind[2:] || ' ' || osm_node_id AS osm_label FROM r LEFT JOIN i ON i.run_id = r.id""",
)
def run_detail_view(spark, sf):
    i = Inputs(spark, sf)
    return runlog.run_detail_view(i.runs, i.issues, "run-8")


@query(
    "issue_view",
    f"""{_LOG}, i AS (SELECT *, {_KIND} AS kind FROM issues ORDER BY created_at DESC, id LIMIT 1000)
    SELECT id, run_id, severity, message, register_ref, {_LABEL} AS label, {_SHOWN.format('created_at')} AS created, run_id[:8] || '...' AS run_short,
    'https://www.openstreetmap.org/' || kind || '/' || osm_node_id AS osm_url FROM i""",
)
def issue_view(spark, sf):
    view = runlog.issue_view(Inputs(spark, sf).issues, limit=5000)
    return view.select("id", "run_id", "severity", "message", "register_ref", "label", "created", "run_short", "osm_url")


# --- point layer --------------------------------------------------------------------------------------------------------

_P = f"""{ctes('elements')}, p AS (SELECT *, CASE WHEN type = 'node' THEN lat ELSE center_lat END AS plat, CASE WHEN type = 'node' THEN lon ELSE center_lon END AS plon FROM elements),
f AS (SELECT *, opening_hours IS NOT NULL AS closed FROM p WHERE plat IS NOT NULL)"""
# A Tuesday evening: whatever has the fixture's hours is closed.
_EVENING = "TIMESTAMP_NTZ'2024-01-09 18:30:00'"


def _decorated(i: Inputs):
    return maplayer.with_opening_state(maplayer.map_features(i.elements, PARAMS), _EVENING)


@query("element_point", f"{_P} SELECT id, type, plat AS point_lat, plon AS point_lon FROM f")
def element_point(spark, sf):
    return maplayer.element_point(Inputs(spark, sf).elements).select("id", "type", "point_lat", "point_lon")


@query(
    "map_features",
    f"""{_P} SELECT type || '/' || id AS feature_id, plat AS point_lat, plon AS point_lon, ref, name, CAST(NULL AS VARCHAR) AS level, CAST(NULL AS VARCHAR) AS location,
    opening_hours, type AS element_type, 'https://www.openstreetmap.org/' || type || '/' || id AS osm_url FROM f""",
)
def map_features(spark, sf):
    return maplayer.map_features(Inputs(spark, sf).elements, PARAMS)


@query(
    "map_opening_state",
    f"{_P} SELECT type || '/' || id AS feature_id, CASE WHEN closed THEN 'closed' ELSE 'unspecified' END AS opening_state, closed AS is_closed_now FROM f",
)
def map_opening_state(spark, sf):
    return _decorated(Inputs(spark, sf)).select("feature_id", "opening_state", "is_closed_now")


@query(
    "map_status_counts",
    f"{_P} SELECT count(*) AS displayed, count(*) FILTER (WHERE closed) AS closed, (SELECT count(*) FROM elements) AS total FROM f",
)
def map_status_counts(spark, sf):
    i = Inputs(spark, sf)
    return maplayer.map_status_counts(i.elements, _decorated(i))


@query("map_bounds", f"{_P} SELECT min(plon) AS west, min(plat) AS south, max(plon) AS east, max(plat) AS north FROM f")
def map_bounds(spark, sf):
    return maplayer.map_bounds(_decorated(Inputs(spark, sf)))


@query(
    "cluster_rollup",
    f"""{_P}, m AS (SELECT (plon + 180) / 360 AS x, 0.5 - ln((1 + sin(radians(plat))) / (1 - sin(radians(plat)))) / (4 * pi()) AS y, closed FROM f),
    z AS (SELECT unnest(range(13)) AS zoom), c AS (SELECT CAST(zoom AS INTEGER) AS zoom, CAST(floor(x * 512 * power(2, zoom) / 40) AS BIGINT) AS cell_x, CAST(floor(y * 512 * power(2, zoom) / 40) AS BIGINT) AS cell_y,
      count(*) AS point_count, count(*) FILTER (WHERE closed) AS closed_count FROM m, z GROUP BY ALL)
    SELECT *, point_count - closed_count AS open_count, CASE WHEN closed_count = 0 THEN 'open' WHEN closed_count = point_count THEN 'closed' ELSE 'mixed' END AS kind FROM c""",
)
def cluster_rollup(spark, sf):
    return maplayer.cluster_rollup(_decorated(Inputs(spark, sf)))


_JSON = "CASE WHEN {0} IS NULL THEN 'null' ELSE '\"' || {0} || '\"' END"


@query(
    "map_payload",
    f"""{_P} SELECT (SELECT count(*) FROM elements) AS "totalElements", (SELECT count(*) FROM f) AS "displayedElements",
    '{{"type":"Feature","geometry":{{"type":"Point","coordinates":[' || {number_sql('plon')} || ',' || {number_sql('plat')} || ']}},"properties":{{"id":"' || type || '/' || id
    || '","ref":' || {_JSON.format('ref')} || ',"name":' || {_JSON.format('name')} || ',"level":null,"location":null,"openingHours":' || {_JSON.format('opening_hours')}
    || ',"elementType":"' || type || '","osmUrl":"https://www.openstreetmap.org/' || type || '/' || id || '"}}}}' AS feature FROM f""",
)
def map_payload(spark, sf):
    at = "TIMESTAMP_NTZ'2024-01-09 18:30:00'"
    folder = new_folder(spark, "map-payload")
    maplayer.write_map_payload(Inputs(spark, sf).elements, PARAMS, folder, at, "cast(NULL AS string)")
    features = spark.read.text(f"{folder}/features").withColumnRenamed("value", "feature")
    summary = spark.read.schema("totalElements bigint, displayedElements bigint").json(f"{folder}/summary")
    # One row.
    return features.join(F.broadcast(summary), how="cross")

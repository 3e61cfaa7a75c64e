"""Run log: append-only run events folded into runs, and the queries over runs and issues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteconcord.functions.display import (
    duration_label,
    duration_seconds,
    element_label,
    element_url,
    format_count,
    format_datetime,
)
from siteconcord.functions.text import literal
from siteconcord.operators.skew import hot_keys, skew_join
from siteconcord.params import ISSUE_LABELS, STUCK_MESSAGE

COUNTERS = (
    "registry_aeds_count",
    "osm_aeds_count",
    "linked_aeds_count",
    "updated_count",
    "created_count",
    "deleted_count",
)
EVENT_COLUMNS = (
    "run_id string, kind string, at timestamp_ntz, mode string, status string, error_message string, "
    + ", ".join(f"{c} int" for c in COUNTERS)
)


def clamped_limit(limit: float | None, fallback: int, most: int) -> int:
    """The limit without its fraction, within 1..most."""
    value = fallback if limit is None else int(limit)
    return min(max(1, value), most)


def _checked_sum(name: str, condition: str = "true") -> str:
    refused = f"int(raise_error(concat('{name} must not be negative: ', {name})))"
    return f"int(coalesce(sum(CASE WHEN {name} < 0 THEN {refused} ELSE {name} END) FILTER (WHERE {condition}), 0)) AS {name}"


def run_counters(deltas: DataFrame) -> DataFrame:
    """Sums of the increments per run; a missing one counts as 0, a negative one is refused."""
    return deltas.groupBy("run_id").agg(*[F.expr(_checked_sum(c)) for c in COUNTERS])


def run_state(events: DataFrame) -> DataFrame:
    """One row per started run from its events: start, any number of counter increments, completion."""
    facts = [
        "min(at) FILTER (WHERE kind = 'start') AS started_at",
        "max(at) FILTER (WHERE kind = 'complete') AS finished_at",
        "coalesce(max_by(status, at) FILTER (WHERE kind = 'complete'), 'running') AS status",
        "min_by(mode, at) FILTER (WHERE kind = 'start') AS mode",
        "max_by(error_message, at) FILTER (WHERE kind = 'complete') AS error_message",
        *[_checked_sum(c, "kind = 'metrics'") for c in COUNTERS],
    ]
    folded = events.groupBy("run_id").agg(*[F.expr(f) for f in facts])
    return folded.filter("started_at IS NOT NULL").withColumnRenamed("run_id", "id")


def orphan_events(events: DataFrame) -> DataFrame:
    """(run_id, events): runs with a completion or increments but no start; each is an error of the writer."""
    counted = events.groupBy("run_id").agg(F.expr("count_if(kind = 'start') AS starts"), F.expr("count(*) AS events"))
    return counted.filter("starts = 0").drop("starts")


def run_by_id(runs: DataFrame, run_id: str) -> DataFrame:
    return runs.filter(f"id = {literal(run_id)}").select(
        "id",
        "started_at",
        "finished_at",
        "status",
        "mode",
        "error_message",
        "linked_aeds_count",
        "updated_count",
        "created_count",
        "deleted_count",
    )


def recent_runs(runs: DataFrame, limit: float | None = None) -> DataFrame:
    """The latest runs; ties by id."""
    columns = ("id", "started_at", "finished_at", "status", "mode", "updated_count", "created_count", "deleted_count")
    newest = runs.select(*columns).orderBy(F.desc("started_at"), "id")
    return newest.limit(clamped_limit(limit, 30, 200))


def latest_run(runs: DataFrame) -> DataFrame:
    """The run that started last, ties to the least id; no row without runs."""
    return runs.orderBy(F.desc("started_at"), "id").limit(1)


def latest_success(runs: DataFrame) -> DataFrame:
    return runs.filter("status = 'success'").orderBy(F.desc_nulls_last("finished_at"), "id").limit(1)


# Kind of the map element an issue is about, null if unknown.
ISSUE_ELEMENT_TYPE = (
    "CASE WHEN osm_node_id IS NULL THEN NULL WHEN issue_type <> 'osm_not_a_node' THEN 'node' "
    "WHEN get_json_object(details, '$.osmElementType') IN ('node', 'way', 'relation') "
    "THEN get_json_object(details, '$.osmElementType') END"
)


def issues_of_run(issues: DataFrame, runs: DataFrame) -> DataFrame:
    """All issues of the latest run."""
    newest = latest_run(runs.select("id", "started_at")).selectExpr("id AS run_id")
    # One row.
    return issues.join(F.broadcast(newest), "run_id", "left_semi")


def of_run(issues: DataFrame, run_id: str | None) -> DataFrame:
    return issues if run_id is None else issues.filter(f"run_id = {literal(run_id)}")


def run_issues(issues: DataFrame, run_id: str | None = None, limit: float | None = None) -> DataFrame:
    """The latest issues, of one run or of all; ties by id."""
    newest = of_run(issues, run_id).orderBy(F.desc("created_at"), "id").limit(clamped_limit(limit, 400, 1000))
    return newest.selectExpr(
        "id",
        "run_id",
        "issue_type",
        "severity",
        "message",
        "register_ref",
        "osm_node_id",
        f"{ISSUE_ELEMENT_TYPE} AS osm_element_type",
        "created_at",
    )


def issue_type_counts(issues: DataFrame, run_id: str | None = None) -> DataFrame:
    counted = of_run(issues, run_id).groupBy("issue_type").agg(F.expr("int(count(*)) AS count"))
    return counted.orderBy(F.desc("count"), "issue_type")


def issue_count(issues: DataFrame, runs: DataFrame) -> DataFrame:
    """One row: issues of the latest run, 0 without runs."""
    return issues_of_run(issues, runs).selectExpr("int(count(*)) AS issue_count")


def mark_stuck(runs: DataFrame, now: str, after: str = "3 hours") -> DataFrame:
    """Runs with those that run for too long turned into failed ones."""
    stuck = f"(status = 'running' AND started_at < {now} - INTERVAL {after})"
    changed = {"status": "'failed'", "finished_at": now, "error_message": literal(STUCK_MESSAGE)}
    return runs.selectExpr(
        *[f"CASE WHEN {stuck} THEN {changed[c]} ELSE {c} END AS {c}" if c in changed else c for c in runs.columns]
    )


def expired(now: str, after: str = "30 days") -> str:
    return f"coalesce(finished_at < {now} - INTERVAL {after}, false)"


def prune(runs: DataFrame, now: str, after: str = "30 days") -> DataFrame:
    """Runs without those finished long ago; unfinished ones stay."""
    return runs.filter(f"NOT {expired(now, after)}")


def prune_cascade(issues: DataFrame, runs: DataFrame, now: str, after: str = "30 days") -> DataFrame:
    """Issues without those of pruned runs."""
    removed = runs.filter(expired(now, after)).selectExpr("id AS run_id")
    return skew_join(issues, removed, "run_id", "left_anti", hot_keys(issues, "run_id"))


_OVERVIEW = "struct(finished_at, status, registry_aeds_count, osm_aeds_count, linked_aeds_count)"


def overview_stats(runs: DataFrame, issues: DataFrame) -> DataFrame:
    """One row: the latest run, the latest success, and the issue counts of the latest run."""
    latest = latest_run(runs).selectExpr(f"{_OVERVIEW} AS latest_run")
    success = latest_success(runs).selectExpr(f"{_OVERVIEW} AS latest_success")
    counts = issue_count(issues, runs).selectExpr("issue_count AS open_issue_count", "issue_count AS total_issue_count")
    # All three have at most one row.
    return counts.join(F.broadcast(latest), F.lit(True), "left").join(F.broadcast(success), F.lit(True), "left")


def overview_baseline(stats: DataFrame) -> DataFrame:
    """The run the overview compares with: the latest success, else the latest run."""
    return stats.selectExpr("coalesce(latest_success, latest_run) AS baseline").select("baseline.*")


def run_list_view(runs: DataFrame, limit: float | None = None) -> DataFrame:
    return recent_runs(runs, limit).selectExpr(
        "id",
        f"{format_datetime('started_at')} AS started",
        "status",
        "mode",
        f"{duration_seconds('started_at', 'finished_at')} AS duration_s",
        f"{duration_label('started_at', 'finished_at')} AS duration",
        f"{format_count('updated_count')} AS updated",
        f"{format_count('created_count')} AS created",
        f"{format_count('deleted_count')} AS deleted",
    )


def issue_label(kind: str = "issue_type") -> str:
    """The dashboard's label of an issue type, the type itself if it has none."""
    cases = " ".join(f"WHEN '{value}' THEN {literal(label)}" for value, label in ISSUE_LABELS.items())
    return f"CASE {kind} {cases} ELSE {kind} END"


def with_links(listed: DataFrame) -> DataFrame:
    """Issues with url and label of their element; null without element or kind."""
    return listed.selectExpr(
        "*",
        f"{element_url('osm_element_type', 'osm_node_id')} AS osm_url",
        f"{element_label('osm_element_type', 'osm_node_id')} AS osm_label",
    )


def issue_view(issues: DataFrame, run_id: str | None = None, limit: float | None = None) -> DataFrame:
    return with_links(run_issues(issues, run_id, limit)).selectExpr(
        "*",
        f"{issue_label()} AS label",
        f"{format_datetime('created_at')} AS created",
        "concat(left(run_id, 8), '...') AS run_short",
    )


def run_detail_view(runs: DataFrame, issues: DataFrame, run_id: str) -> DataFrame:
    """The run's facts beside each of its issues (one row with null issue fields if it has none)."""
    run = run_by_id(runs, run_id).selectExpr(
        "id AS run_id",
        "status",
        "mode",
        f"{duration_label('started_at', 'finished_at')} AS duration",
        "error_message",
        f"{format_count('updated_count')} AS updated",
        f"{format_count('created_count')} AS created",
        f"{format_count('deleted_count')} AS deleted",
    )
    listed = with_links(run_issues(issues, run_id)).selectExpr(
        "run_id", "id AS issue_id", f"{issue_label()} AS label", "severity", "message", "osm_label"
    )
    # One run and at most the listed issues.
    return run.join(listed, "run_id", "left")

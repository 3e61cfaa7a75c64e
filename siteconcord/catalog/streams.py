"""Streaming jobs, run over files until these are used up."""

from __future__ import annotations

from siteconcord.catalog.book import PARAMS, RUNS, VIEWS, Inputs, query
from siteconcord.catalog.dashboards import events_of
from siteconcord.catalog.planning import PLAN_SQL
from siteconcord.operators.runlog import run_state
from siteconcord.session import new_folder
from siteconcord.streaming.jobs import reconcile_incremental, stuck_runs_job


@query(
    "stuck_runs_stream",
    f"""WITH runs AS ({RUNS}), clock AS (SELECT least(max(started_at), max(finished_at)) AS now FROM runs)
    SELECT id AS run_id, started_at, started_at + INTERVAL 3 HOUR AS failed_at, 'failed' AS status FROM runs, clock
    WHERE finished_at IS NULL AND started_at + INTERVAL 3 HOUR < now""",
)
def stuck_runs_stream(spark, sf):
    home = new_folder(spark, "stuck-runs")
    events = events_of(Inputs(spark, sf))
    events.withColumn("at", events["at"].cast("timestamp")).write.parquet(f"{home}/events")
    stuck_runs_job(spark, f"{home}/events", f"{home}/out", f"{home}/state").awaitTermination()
    found = spark.read.schema("run_id string, started_at timestamp, failed_at timestamp, status string").parquet(f"{home}/out")
    ntz = ("run_id", "cast(started_at AS timestamp_ntz) AS started_at", "cast(failed_at AS timestamp_ntz) AS failed_at", "status")
    return found.selectExpr(*ntz)


def _snapshot_sql(number: int, kept: str) -> str:
    """The run of one snapshot: the whole plan over the assets it has."""
    named = f"assets AS ({VIEWS['assets'].strip()})"
    base = PLAN_SQL.replace(named, f"assets AS (SELECT * FROM ({VIEWS['assets'].strip()}) WHERE {kept})")
    count = "CAST(count(*) FILTER (WHERE op = '{}') AS INTEGER)"
    return f"""SELECT * FROM ({base} SELECT 'run-{number}' AS id, 'success' AS status, 'dry-run' AS mode, CAST((SELECT count(*) FROM assets) AS INTEGER) AS registry_aeds_count,
    CAST((SELECT count(*) FROM elements) AS INTEGER) AS osm_aeds_count, {count.format('modify')} AS updated_count, {count.format('create')} AS created_count,
    {count.format('delete')} AS deleted_count FROM plan)"""


_SNAPSHOTS = ("true", "asset_ord % 50 <> 0")


@query("reconcile_incremental", " UNION ALL ".join(_snapshot_sql(n, sql) for n, sql in enumerate(_SNAPSHOTS)))
def incremental(spark, sf):
    """Two snapshots arrive one after the other; the second lacks some assets."""
    i, home = Inputs(spark, sf), new_folder(spark, "incremental")
    i.elements.write.parquet(f"{home}/elements")
    for n, kept in enumerate(_SNAPSHOTS):
        i.assets.filter(kept).write.parquet(f"{home}/assets-{n}")
        row = (f"run-{n}", f"{home}/assets-{n}", f"{home}/elements", "parquet")
        arrived = spark.createDataFrame([row], "run_id string, assets_path string, elements_path string, format string")
        arrived.coalesce(1).write.mode("append").json(f"{home}/arrivals")
        reconcile_incremental(spark, f"{home}/arrivals", f"{home}/out", f"{home}/state", p=PARAMS).awaitTermination()
    state = run_state(spark.read.parquet(f"{home}/out/run_events"))
    return state.select("id", "status", "mode", "registry_aeds_count", "osm_aeds_count", "updated_count", "created_count", "deleted_count")

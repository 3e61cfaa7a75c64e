"""A whole run: events, metrics, guards, plan, change files, issues."""

from __future__ import annotations

from datetime import datetime, timezone
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siteconcord.operators.runlog import COUNTERS, EVENT_COLUMNS
from siteconcord.operators.validate import RunAborted, enforce
from siteconcord.params import MatchParams
from siteconcord.plans.maintenance import EVENT_PERIOD, store
from siteconcord.plans.reconcile import reconcile
from siteconcord.sources.runlog import MODES, STATUSES
from siteconcord.sources.sinks import append_issues, write_geojson, write_osc


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def append_event(spark: SparkSession, path: str, run_id: str, kind: str, **fields) -> None:
    """Append one event of a run; increments must be non-negative."""
    if fields.get("mode", MODES[0]) not in MODES or fields.get("status", STATUSES[0]) not in STATUSES:
        raise ValueError(f"Unknown mode or status: {fields}")
    negative = {k: v for k, v in fields.items() if k in COUNTERS and v < 0}
    if negative:
        raise ValueError(f"Counters must not be negative: {negative}")
    schema = T.StructType.fromDDL(EVENT_COLUMNS)
    values = {"run_id": run_id, "kind": kind, "at": fields.pop("at", None) or _utc_now(), **fields}
    row = Row(*[values.get(name) for name in schema.names])
    store(spark.createDataFrame([row], schema).coalesce(1), path, EVENT_PERIOD, "at")


def put_if_absent(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there, so that of several who try at once one succeeds.

    By the file system of the path, or by the operating system where it is local.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    marker = jvm.org.apache.hadoop.fs.Path(path)
    system = marker.getFileSystem(conf)
    system.mkdirs(marker.getParent())
    try:
        if system.getScheme() == "file":
            no_attributes = spark.sparkContext._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0)
            jvm.java.nio.file.Files.createFile(jvm.java.io.File(marker.toUri().getPath()).toPath(), no_attributes)
        else:
            system.create(marker, False).close()
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def _start_marker(path: str, run_id: str) -> str:
    return f"{path.rstrip('/')}_starts/{quote(run_id, safe='')}"


def claim_start(spark: SparkSession, path: str, run_id: str) -> bool:
    """Put the marker of a run's start beside its event log; False if somebody has started it."""
    return put_if_absent(spark, _start_marker(path, run_id))


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def known_run(spark: SparkSession, path: str, run_id: str) -> bool:
    """Whether the event log has a start of this run."""
    if not exists(spark, path):
        return False
    started = spark.read.schema(EVENT_COLUMNS).parquet(path).filter("kind = 'start'")
    return not started.filter(F.col("run_id") == run_id).isEmpty()


def attempt_of(spark: SparkSession, path: str, run_id: str) -> str | None:
    """The id under which an announced run may start now: itself, or with the number of the attempt; None once one succeeded."""
    attempt, name = 1, run_id
    while known_run(spark, path, name) or exists(spark, _start_marker(path, name)):
        ended = spark.read.schema(EVENT_COLUMNS).parquet(path).filter("kind = 'complete' AND status = 'success'") if exists(spark, path) else None
        if ended is not None and not ended.filter(F.col("run_id") == name).isEmpty():
            return None
        attempt += 1
        name = f"{run_id}.{attempt}"
    return name


def run_reconciliation(
    spark: SparkSession, assets: DataFrame, elements: DataFrame, out: str, run_id: str, *, mode: str = "dry-run", p: MatchParams | None = None
):
    """Reconcile and write under `out`: run events, issues, plan, and the two change files of this run.

    A run id that has been started is refused before anything is written, and of two that start it at one time only
    one goes on. Counters and issues of the inputs are stored
    before any guard, files only after all. On failure the run is recorded as failed and the
    error goes on.
    """
    events = f"{out}/run_events"
    if known_run(spark, events, run_id) or not claim_start(spark, events, run_id):
        raise ValueError(f"Run {run_id} has been started before.")
    append_event(spark, events, run_id, "start", mode=mode)

    def store_inputs(input_metrics: DataFrame, issues: DataFrame) -> None:
        inputs = input_metrics.first()
        append_event(
            spark,
            events,
            run_id,
            "metrics",
            registry_aeds_count=inputs["registry_aeds"],
            osm_aeds_count=inputs["osm_aeds"],
            linked_aeds_count=inputs["linked_aeds"],
        )
        append_issues(issues, f"{out}/issues", run_id, f"TIMESTAMP_NTZ'{_utc_now()}'")

    try:
        try:
            result = reconcile(assets, elements, p)
        except RunAborted as aborted:
            if aborted.input_metrics is not None:
                store_inputs(aborted.input_metrics, aborted.issues)
            raise
        store_inputs(result.input_metrics, result.issues)
        counts = result.metrics.first()
        append_event(
            spark,
            events,
            run_id,
            "metrics",
            updated_count=counts["updated"],
            created_count=counts["created"],
            deleted_count=counts["deleted"],
        )
        enforce(result.guard)
        plan = result.plan
        plan.write.parquet(f"{out}/plans/{run_id}")
        write_osc(plan, f"{out}/changes/{run_id}.osc")
        write_geojson(plan, f"{out}/changes/{run_id}.geojson")
        append_event(spark, events, run_id, "complete", status="success")
        return result
    except Exception as error:
        append_event(spark, events, run_id, "complete", status="failed", error_message=str(error))
        raise

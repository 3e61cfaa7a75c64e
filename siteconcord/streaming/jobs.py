"""Streaming forms of the timer-driven jobs."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteconcord.operators.runlog import EVENT_COLUMNS
from siteconcord.params import MatchParams
from siteconcord.plans.job import attempt_of, exists, put_if_absent, run_reconciliation

SNAPSHOT_COLUMNS = "run_id string, assets_path string, elements_path string, format string"


def reconcile_incremental(
    spark: SparkSession, arrivals: str, out: str, checkpoint: str, *, mode: str = "dry-run", p: MatchParams | None = None
):
    """Reconcile every snapshot announced in `arrivals`, then stop; call it from a timer or keep it running.

    Each JSON line of a file there names a run and the paths of its two snapshots. Files are taken one per batch and
    remembered in `checkpoint`. A ledger under `out` names, per batch, the announced runs whose outputs are whole; a batch that is
    tried again passes over these without a look at the events. Others start anew as `<run_id>.2` and so on, so no
    counter or issue is stored twice under one id; one that succeeded but was not entered is entered then.
    """
    announced = spark.readStream.schema(SNAPSHOT_COLUMNS).option("maxFilesPerTrigger", 1).json(arrivals)

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        # One announcement file: a handful of rows of paths.
        for row in batch.collect():
            entry = f"{out}/ledger/{batch_id}/{quote(row['run_id'], safe='')}"
            if exists(spark, entry):
                continue
            run_id = attempt_of(spark, f"{out}/run_events", row["run_id"])
            if run_id is not None:
                reader = spark.read.format(row["format"] or "parquet")
                run_reconciliation(
                    spark, reader.load(row["assets_path"]), reader.load(row["elements_path"]), out, run_id, mode=mode, p=p
                )
            put_if_absent(spark, entry)

    writer = announced.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def stuck_runs(events: DataFrame, after: str = "3 hours", delay: str = "0 seconds") -> DataFrame:
    """Stream of runs whose start was not followed by a completion within the time limit.

    `events` is a stream of run events. A run is reported once the event time has passed its limit; state of a run is
    dropped as soon as it is decided.
    """
    starts = events.filter("kind = 'start'").selectExpr("run_id", "at AS started_at").withWatermark("started_at", delay)
    ends = events.filter("kind = 'complete'").selectExpr("run_id AS done_id", "at AS done_at").withWatermark("done_at", delay)
    within = f"run_id = done_id AND done_at >= started_at AND done_at <= started_at + INTERVAL {after}"
    joined = starts.join(ends, F.expr(within), "leftOuter")
    return joined.filter("done_id IS NULL").selectExpr(
        "run_id", "started_at", f"started_at + INTERVAL {after} AS failed_at", "'failed' AS status"
    )


def stuck_runs_job(spark: SparkSession, events: str, out: str, checkpoint: str, after: str = "3 hours"):
    """Append the stuck runs found in the event files to `out`, then stop. Event times are read as UTC."""
    schema = EVENT_COLUMNS.replace("at timestamp_ntz", "at timestamp")
    stream = spark.readStream.schema(schema).parquet(events)
    writer = stuck_runs(stream, after).writeStream.format("parquet").option("path", out)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

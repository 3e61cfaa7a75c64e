"""Upkeep of the stored run log: runs that hang are failed, runs that ended long ago go, with their events and issues.

Both tables are kept in one folder per period (a day or a month) of their rows. Rows of runs that stay can only lie in the periods
these runs span, so every other old period is dropped unread; of a period that both kinds of runs share, the rows that stay are
written in its place by a dynamic partition overwrite. Each step can be repeated: an upkeep that broke off is simply run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteconcord.functions.text import literal
from siteconcord.operators.runlog import EVENT_COLUMNS, expired, mark_stuck, run_state
from siteconcord.params import STUCK_MESSAGE
from siteconcord.session import discard, materialized

# The periods a log may be kept in, and how their folders are named.
FORMATS = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}
EVENT_PERIOD, ISSUE_PERIOD = "on_day", "created_on"


def _period(at: str, unit: str) -> str:
    return f"date_format({at}, '{FORMATS[unit]}')"


def store(rows: DataFrame, path: str, column: str, at: str, unit: str = "day") -> None:
    """Append rows, each in the period of its time `at`."""
    rows.withColumn(column, F.expr(_period(at, unit))).write.mode("append").partitionBy(column).parquet(path)


def stored(spark: SparkSession, path: str, columns: str, column: str) -> DataFrame:
    return spark.read.schema(f"{columns}, {column} string").parquet(path)


def periods(spark: SparkSession, path: str, column: str) -> list[str]:
    """The periods of a table, by its folders alone."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def _drop(spark: SparkSession, path: str, column: str, gone: list[str]) -> None:
    for period in gone:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={period}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _retain(spark: SparkSession, path: str, columns: str, column: str, staying: DataFrame, last: str, unit: str) -> None:
    """Leave only rows of the runs of `staying` (run_id, since, until) in the periods up to `last`; later ones are not touched."""
    old = [p for p in periods(spark, path, column) if p <= last]
    # A run that hung for years spans hundreds of periods, so the spans are made distinct before they are written out as periods.
    spans = staying.select("since", "until").distinct().selectExpr(f"explode(sequence(since, until, INTERVAL 1 {unit})) AS at")
    spanned = spans.selectExpr(f"{_period('at', unit)} AS period").distinct()
    # At most one row per period of the log.
    spanned = {r[0] for r in spanned.filter(F.col("period") <= last).collect()}
    shared = [p for p in old if p in spanned]
    _drop(spark, path, column, [p for p in old if p not in spanned])
    if not shared:
        return
    rows = stored(spark, path, columns, column).filter(F.col(column).isin(shared))
    # Written before it takes the place of what it was read from.
    kept = materialized(rows.join(staying.select("run_id").distinct(), "run_id", "left_semi").select(rows.columns), "kept")
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    filled = {r[0] for r in kept.select(column).distinct().collect()}
    _drop(spark, path, column, [p for p in shared if p not in filled])
    discard(kept)


def maintain(
    spark: SparkSession,
    events: str,
    issues: str,
    issue_columns: str,
    now: str,
    *,
    unit: str = "day",
    stuck_after: str = "3 hours",
    keep: str = "30 days",
) -> None:
    """One upkeep of the log at the time `now`, an SQL timestamp: fail what hangs, then let go what ended more than `keep` ago."""
    runs = materialized(run_state(stored(spark, events, EVENT_COLUMNS, EVENT_PERIOD)), "runs")
    hanging = runs.filter(f"status = 'running' AND started_at < {now} - INTERVAL {stuck_after}")
    if not hanging.isEmpty():
        known = {"run_id": "id", "kind": "'complete'", "at": now, "status": "'failed'", "error_message": literal(STUCK_MESSAGE)}
        fields = [c.split() for c in EVENT_COLUMNS.split(", ")]
        failed = hanging.selectExpr(*[f"CAST({known.get(c, 'NULL')} AS {kind}) AS {c}" for c, kind in fields])
        store(failed, events, EVENT_PERIOD, "at", unit)
    ended = mark_stuck(runs, now, stuck_after).filter(f"NOT {expired(now, keep)}")
    ends = f"date_trunc('{unit}', coalesce(finished_at, {now})) AS until"
    staying = materialized(ended.selectExpr("id AS run_id", f"date_trunc('{unit}', started_at) AS since", ends), "staying")
    last = spark.sql(f"SELECT {_period(f'{now} - INTERVAL {keep}', unit)}").first()[0]
    _retain(spark, events, EVENT_COLUMNS, EVENT_PERIOD, staying, last, unit)
    _retain(spark, issues, issue_columns, ISSUE_PERIOD, staying, last, unit)
    discard(runs, staying)

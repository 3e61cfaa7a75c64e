"""Run log tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Allowed modes and states of a run.
MODES = ("dry-run", "live")
STATUSES = ("running", "success", "failed")

RUN_COLUMNS = (
    "id string, started_at timestamp_ntz, finished_at timestamp_ntz, status string, mode string, error_message string, "
    "registry_aeds_count int, osm_aeds_count int, linked_aeds_count int, updated_count int, created_count int, "
    "deleted_count int"
)
ISSUE_COLUMNS = (
    "id string, run_id string, issue_type string, severity string, message string, register_ref string, "
    "osm_node_id bigint, details string, created_at timestamp_ntz"
)


def runs_scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_COLUMNS).parquet(path)


def issues_scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ISSUE_COLUMNS).parquet(path)

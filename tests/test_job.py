"""Whole runs: files, run log, guards."""

import glob
import json
import xml.etree.ElementTree as ET
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from siteconcord.catalog import fixtures
from siteconcord.catalog.book import PARAMS, Inputs
from siteconcord.functions.geo import haversine_m, mercator_cell
from siteconcord.operators.claim import greedy_claim
from siteconcord.operators.runlog import EVENT_COLUMNS, run_state
from siteconcord.operators.validate import RunAborted, validate_registry
from siteconcord.params import MatchParams
from siteconcord.plans import maintenance
from siteconcord.plans.job import append_event, attempt_of, claim_start, run_reconciliation
from siteconcord.plans.reconcile import reconcile
from siteconcord.session import materialized
from siteconcord.streaming.jobs import reconcile_incremental

SF_DIR = "/root/testdata/sf0.001"


def document(folder):
    return "".join(open(part).read() for part in sorted(glob.glob(f"{folder}/part-*")))


@pytest.fixture(scope="module")
def inputs(spark):
    return fixtures.assets(spark, SF_DIR), fixtures.elements(spark, SF_DIR)


def test_run_writes_plan_files_and_log(spark, inputs, tmp_path):
    run_reconciliation(spark, *inputs, str(tmp_path), "r1")
    state = run_state(spark.read.parquet(f"{tmp_path}/run_events")).first()
    assert (state["status"], state["mode"], state["registry_aeds_count"], state["osm_aeds_count"]) == ("success", "dry-run", 150, 180)
    plan = spark.read.parquet(f"{tmp_path}/plans/r1")
    counts = {op: plan.filter(F.col("op") == op).count() for op in ("create", "modify", "delete")}
    assert (counts["create"], counts["modify"], counts["delete"]) == (state["created_count"], state["updated_count"], state["deleted_count"])

    root = ET.fromstring(document(tmp_path / "changes" / "r1.osc"))
    assert [(section.tag, len(section)) for section in root] == list(counts.items())
    assert [int(n.get("id")) for n in root.find("create")] == [-i for i in range(1, counts["create"] + 1)]
    for node in root.iter("node"):
        keys = [t.get("k") for t in node]
        assert keys == sorted(keys, key=lambda k: k.replace(":", "\x01").replace("_", "\x00"))

    features = [json.loads(line) for line in document(tmp_path / "changes" / "r1.geojson").splitlines()]
    assert [f["properties"]["_operation"] for f in features] == [op for op, n in counts.items() for _ in range(n)]
    moved = [f for f in features if f["properties"]["_operation"] == "modify"]
    assert all("_from_lat" in f["properties"] for f in moved)

    issues = spark.read.parquet(f"{tmp_path}/issues")
    assert sorted(r["issue_seq"] for r in issues.collect()) == list(range(1, issues.count() + 1))


def test_result_does_not_depend_on_row_order(spark, inputs, tmp_path):
    def plan_of(assets, elements, name):
        run_reconciliation(spark, assets, elements, str(tmp_path / name), "r")
        return document(tmp_path / name / "changes" / "r.osc")

    shuffled = [df.repartition(5, F.rand(3)) for df in inputs]
    assert plan_of(*inputs, "a") == plan_of(*shuffled, "b")


def test_too_many_deletes_abort_the_run(spark, inputs, tmp_path):
    strict = replace(MatchParams(), max_delete_fraction=0.001)
    with pytest.raises(RunAborted, match="exceeds max allowed 0.1%"):
        run_reconciliation(spark, *inputs, str(tmp_path), "r1", p=strict)
    state = run_state(spark.read.parquet(f"{tmp_path}/run_events")).first()
    assert state["status"] == "failed" and state["error_message"].startswith("Delete fraction") and state["deleted_count"] > 0
    assert not glob.glob(f"{tmp_path}/changes/*")


def test_no_nodes_abort_the_run(spark, inputs, tmp_path):
    with pytest.raises(RunAborted):
        run_reconciliation(spark, inputs[0], inputs[1].filter("type = 'way'"), str(tmp_path), "r1")
    assert run_state(spark.read.parquet(f"{tmp_path}/run_events")).first()["status"] == "failed"


def test_counters_must_not_be_negative(spark, tmp_path):
    with pytest.raises(ValueError):
        append_event(spark, str(tmp_path), "r1", "metrics", created_count=-1)


def test_known_run_is_refused_and_inputs_are_stored_before_the_guard(spark, inputs, tmp_path):
    assets, elements = inputs
    with pytest.raises(RunAborted):
        run_reconciliation(spark, assets, elements.filter("type = 'way'"), str(tmp_path), "r1")
    events = spark.read.parquet(f"{tmp_path}/run_events")
    state = run_state(events).first()
    assert (state["status"], state["registry_aeds_count"]) == ("failed", 150) and state["osm_aeds_count"] > 0
    issues = spark.read.parquet(f"{tmp_path}/issues").count()
    assert issues > 0
    with pytest.raises(ValueError):
        run_reconciliation(spark, assets, elements, str(tmp_path), "r1")
    assert run_state(spark.read.parquet(f"{tmp_path}/run_events")).first()["registry_aeds_count"] == 150
    assert spark.read.parquet(f"{tmp_path}/issues").count() == issues
    assert attempt_of(spark, f"{tmp_path}/run_events", "r1") == "r1.2"


def test_poles_have_clusters(spark):
    cell = mercator_cell("lat", "0D", 4)
    rows = spark.sql("SELECT 90D AS lat UNION ALL SELECT -90D").selectExpr(f"{cell[0]} AS x", f"{cell[1]} AS y").collect()
    assert all(r["y"] is not None for r in rows)


def test_more_copies_than_eight_keep_the_order_of_ties(spark):
    """Twelve copies north and one node as far south, whose ordinal lies between those of the copies."""
    assets = spark.createDataFrame([(i, 60.0, 10.0) for i in range(1, 5)], "asset_ord long, lat double, lon double")
    nodes = [(1, 60.0005, 10.0, False), (10, 59.9995, 10.0, False), *[(20 + i, 60.0005, 10.0, False) for i in range(11)]]
    nodes = spark.createDataFrame(nodes, "elem_ord long, lat double, lon double, opted_out boolean")
    claimed = {r["asset_ord"]: (r["elem_ord"], r["distance_m"]) for r in greedy_claim(assets, nodes, 175.0).collect()}
    north, south = claimed[1][1], haversine_south(spark)
    order = [1, 10, 20, 21] if south <= north else [1, 20, 21, 22]
    assert [claimed[i][0] for i in range(1, 5)] == order


def haversine_south(spark):
    return spark.range(1).selectExpr(f"{haversine_m('60D', '10D', '59.9995D', '10D')} AS d").first()["d"]


# --- starts, ledger, upkeep ---------------------------------------------------------------------------------------------


def test_of_two_starters_one_goes_on(spark, tmp_path):
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda _: claim_start(spark, f"{tmp_path}/run_events", "run/1 ä"), range(32)))
    assert sum(won) == 1
    assert attempt_of(spark, f"{tmp_path}/run_events", "run/1 ä") == "run/1 ä.2"


def test_claimed_run_is_refused(spark, inputs, tmp_path):
    assert claim_start(spark, f"{tmp_path}/run_events", "r1")
    with pytest.raises(ValueError):
        run_reconciliation(spark, *inputs, str(tmp_path), "r1")
    assert not (tmp_path / "run_events").exists()


def test_ledger_decides_on_a_replay(spark, inputs, tmp_path):
    assets, elements = inputs
    assets.write.parquet(f"{tmp_path}/assets")
    elements.write.parquet(f"{tmp_path}/elements")
    row = ("r1", f"{tmp_path}/assets", f"{tmp_path}/elements", "parquet")
    announced = spark.createDataFrame([row], "run_id string, assets_path string, elements_path string, format string")
    announced.coalesce(1).write.json(f"{tmp_path}/arrivals")
    again = lambda state: reconcile_incremental(spark, f"{tmp_path}/arrivals", f"{tmp_path}/out", f"{tmp_path}/{state}").awaitTermination()
    again("state")
    assert (tmp_path / "out/ledger/0/r1").exists()
    events = spark.read.parquet(f"{tmp_path}/out/run_events").count()
    # The same batch once more, as after the loss of the stream's own state.
    again("state-2")
    assert spark.read.parquet(f"{tmp_path}/out/run_events").count() == events
    # A batch that was not entered, but whose run succeeded, is entered and not run again.
    (tmp_path / "out/ledger/0/r1").unlink()
    again("state-3")
    assert (tmp_path / "out/ledger/0/r1").exists()
    assert spark.read.parquet(f"{tmp_path}/out/run_events").count() == events


def log_rows(path, column):
    return sorted(p.name for p in path.iterdir() if p.name.startswith(f"{column}="))


def test_upkeep_by_days(spark, tmp_path):
    """One run over two days around the limit, one long gone, one that hangs, one that still runs."""
    events, issues = f"{tmp_path}/events", f"{tmp_path}/issues"
    day = lambda text: datetime.fromisoformat(text)
    runs = {
        "gone": (day("2024-01-01 10:00:00"), day("2024-01-01 11:00:00")),
        "gone-late": (day("2024-01-02 23:00:00"), day("2024-01-03 05:00:00")),
        "kept": (day("2024-01-02 23:30:00"), day("2024-01-03 07:00:00")),
        "hangs": (day("2024-01-05 00:00:00"), None),
        "runs": (day("2024-02-02 05:00:00"), None),
    }
    for run_id, (start, end) in runs.items():
        append_event(spark, events, run_id, "start", mode="live", at=start)
        if end:
            append_event(spark, events, run_id, "complete", status="success", at=end)
    rows = [(f"{r}-{k}", r, t) for r, (start, end) in runs.items() for k, t in enumerate((start, end or start))]
    columns = "id string, run_id string, created_at timestamp_ntz"
    maintenance.store(spark.createDataFrame(rows, columns), issues, maintenance.ISSUE_PERIOD, "created_at")

    def state():
        left = run_state(maintenance.stored(spark, events, EVENT_COLUMNS, maintenance.EVENT_PERIOD)).collect()
        held = maintenance.stored(spark, issues, columns, maintenance.ISSUE_PERIOD).collect()
        return {r["id"]: (r["status"], r["started_at"]) for r in left}, sorted(r["id"] for r in held)

    expected = (
        {"kept": ("success", runs["kept"][0]), "hangs": ("failed", runs["hangs"][0]), "runs": ("running", runs["runs"][0])},
        ["hangs-0", "hangs-1", "kept-0", "kept-1", "runs-0", "runs-1"],
    )
    for _ in range(2):
        maintenance.maintain(spark, events, issues, columns, "TIMESTAMP_NTZ'2024-02-02 06:00:00'")
        assert state() == expected
    assert log_rows(tmp_path / "issues", "created_on") == [f"created_on=2024-0{d}" for d in ("1-02", "1-03", "1-05", "2-02")]
    maintenance.maintain(spark, events, issues, columns, "TIMESTAMP_NTZ'2024-03-20 06:00:00'")
    assert state() == ({"runs": ("failed", runs["runs"][0])}, ["runs-0", "runs-1"])


def test_inputs_of_one_split_are_worked_on_by_many_tasks(spark):
    """A registry and an extract of few bytes come in one split; the validated tables are made by several tasks."""
    assets, elements = fixtures.assets(spark, SF_DIR).coalesce(1), fixtures.elements(spark, SF_DIR).coalesce(1)
    result = reconcile(assets, elements)
    assert len(result.nodes.inputFiles()) > 1 and len(result.assets.inputFiles()) > 1


def test_filter_on_faults_runs_behind_the_deal(spark):
    """Faults are found by several tasks also where only the assets without one are read."""
    assets = fixtures.assets(spark, SF_DIR).coalesce(1)
    valid, issues = validate_registry(assets, PARAMS)
    assert len(valid.inputFiles()) > 1
    assert valid.count() + issues.count() == assets.count()
    staged, _ = Inputs(spark, SF_DIR).staged
    assert len(staged.inputFiles()) > 1 and staged.count() == valid.count()


def test_upkeep_writes_one_row_per_run_that_stays(spark, tmp_path, monkeypatch):
    """A run that hung for years spans many periods; what is written is its span, not a row for each."""
    events, issues = str(tmp_path / "events"), str(tmp_path / "issues")
    append_event(spark, events, "old", "start", mode="live", at=datetime(1995, 3, 1))
    append_event(spark, events, "gone", "start", mode="live", at=datetime(1999, 3, 1))
    append_event(spark, events, "gone", "complete", status="success", at=datetime(1999, 3, 2))
    written = {}

    def counted(df, label="step", heavy=False):
        written[label] = df.count()
        return materialized(df, label, heavy)

    monkeypatch.setattr(maintenance, "materialized", counted)
    maintenance.maintain(spark, events, issues, "run_id string", "TIMESTAMP_NTZ'2024-01-07 06:00:00'")
    assert written["staying"] == 1
    left = maintenance.stored(spark, events, EVENT_COLUMNS, maintenance.EVENT_PERIOD)
    assert sorted((r["run_id"], r["kind"]) for r in left.collect()) == [("old", "complete"), ("old", "start")]

"""The whole_ queries read the plan and the issues of all five tasks."""

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
QUERIES = contract.queries()


def rows(spark, name):
    return QUERIES[name](spark, SF_DIR).collect()


def test_metrics_and_conflicts_of_all_tasks(spark):
    whole, small = rows(spark, "whole_plan_metrics")[0], rows(spark, "plan_metrics")[0]
    assert whole["created"] > 0 == small["created"] and whole["updated"] > small["updated"]
    # Deletes come from tasks 2 and 3 alone.
    assert whole["deleted"] == small["deleted"] == rows(spark, "whole_plan_delete_fraction")[0]["deleted"]
    # Mixed managed nodes are changed by the extraction and by the update.
    assert any(r["modifies"] > 1 for r in rows(spark, "whole_plan_conflicts"))


def test_files_hold_every_change(spark):
    whole = rows(spark, "whole_plan_metrics")[0]
    written = [r["op"] for r in rows(spark, "whole_plan_geojson")]
    assert [written.count(op) for op in ("create", "modify", "delete")] == [whole["created"], whole["updated"], whole["deleted"]]
    lines = {r["line"]: r["times"] for r in rows(spark, "whole_plan_osc")}
    assert lines["    </node>"] == len(written)


def test_issues_of_inputs_and_tasks(spark):
    found = rows(spark, "whole_run_issues")
    assert sorted(r["issue_seq"] for r in found) == list(range(1, len(found) + 1))
    assert len(found) == rows(spark, "reconcile")[0]["issues"] > len(rows(spark, "append_issues"))

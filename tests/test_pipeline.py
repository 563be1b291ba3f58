import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators.quality import GateFailed
from tidemark.plans import pipeline
from tidemark.sources import contracts

from .test_contracts import ASSIGN_CSV, USERS_CSV, write_snapshot

HEADER = "event_id,user_id,event_name,event_ts,session_id,experiment_id,variant,revenue,properties"
# ada signs up, starts and completes; bo signs up and pays; cy signs up, starts and uses a feature a week later
STORY = [
    ("ada", "signup", "2026-05-04T07:30:00Z", ""),
    ("ada", "onboarding_started", "2026-05-04T07:45:00Z", ""),
    ("ada", "onboarding_completed", "2026-05-05T10:00:00Z", ""),
    ("ada", "session_started", "2026-05-13T12:00:00+02:00", ""),
    ("ada", "feature_collab_used", "2026-05-13T12:05:00+02:00", ""),
    ("bo", "signup", "2026-05-06T00:00:00Z", ""),
    ("bo", "subscription_payment", "2026-05-07T03:45:00Z", "18.125"),
    ("cy", "signup", "2026-05-12T06:00:00Z", ""),
    ("cy", "onboarding_started", "2026-05-12T06:20:00Z", ""),
    ("cy", "session_started", "2026-05-20T00:10:00+05:30", ""),
    ("cy", "feature_export_used", "2026-05-20T00:40:00+05:30", ""),
]


def events_csv(story=STORY):
    return "\n".join([HEADER, *(f"w{i},{u},{n},{t},v{i},,,{r},{{}}" for i, (u, n, t, r) in enumerate(story))]) + "\n"


@pytest.fixture()
def source(scratch_dir):
    return write_snapshot(os.path.join(scratch_dir, "src"), USERS_CSV, events_csv(), ASSIGN_CSV)


def test_gate_blocks_publication(spark, scratch_dir):
    # nobody uses a feature: the engagement check fails and nothing of the build becomes visible
    quiet = [x for x in STORY if not x[1].startswith("feature_")]
    src = write_snapshot(os.path.join(scratch_dir, "src"), USERS_CSV, events_csv(quiet), ASSIGN_CSV)
    wh = os.path.join(scratch_dir, "wh")
    with pytest.raises(GateFailed, match="engagement_mart_is_not_empty"):
        pipeline.run(spark, src, wh, snapshot_id="20260601T000000Z")
    assert contracts.current_snapshot(spark, f"{wh}/raw") == "20260601T000000Z"
    assert contracts.current_snapshot(spark, f"{wh}/marts") is None


def test_gate_blocks_an_empty_experiment_mart(spark, scratch_dir):
    src = write_snapshot(os.path.join(scratch_dir, "src"), USERS_CSV, events_csv(), ASSIGN_CSV.splitlines()[0] + "\n")
    wh = os.path.join(scratch_dir, "wh")
    with pytest.raises(GateFailed, match="fct_ab_tests:non_empty"):
        pipeline.run(spark, src, wh, snapshot_id="20260601T000000Z")
    assert contracts.current_snapshot(spark, f"{wh}/marts") is None


def test_end_to_end(spark, scratch_dir, source):
    wh = os.path.join(scratch_dir, "wh")
    res = pipeline.run(spark, source, wh, snapshot_id="20260601T000000Z")
    assert res.loaded == {"dim_users": 3, "raw_events": 11, "ab_test_assignments": 3}
    assert all(c["passed"] for c in res.checks) and not res.data_test_failures
    read = lambda name: contracts.read_source(spark, f"{wh}/marts", name)
    assert read("fct_funnel").count() == 15
    assert read("fct_funnel").schema["stage"].metadata["comment"] == "activation step"
    metrics = {r["metric"]: r for r in res.report_rows}
    assert metrics["users"]["display"] == "3"
    assert (metrics["biggest_dropoff_step"]["display"], metrics["biggest_dropoff"]["display"]) == ("first_project_created", "100.0%")
    result = read("ab_results").first()
    assert (result["experiment_id"], result["control_rate"], result["treatment_rate"]) == ("banner", 0.0, 0.5)
    assert {"p_value", "interval_low", "mde", "recommendation", "revenue_p_value"} <= set(result.asDict())
    weekly = {(str(r["cohort_period"]), r["period_number"]): (r["retained"], r["users"], r["retention_rate"]) for r in read("retention").collect()}
    assert weekly == {("2026-05-04", 1): (1, 2, 0.5), ("2026-05-11", 1): (1, 1, 1.0)}
    assert [tuple(r) for r in read("retention_heatmap").orderBy("cohort_period").collect()] == [("2026-05-04", 0.5), ("2026-05-11", 1.0)]
    for name in (*pipeline.REPORT_NAMES, "model_metadata"):
        assert read(name).count() > 0
    assert spark.table("fct_funnel").count() == 15 and spark.table("int_user_activity").count() == 3


def test_rebuilding_a_day_replaces_it_whole(spark, scratch_dir, source):
    wh = os.path.join(scratch_dir, "wh")
    pipeline.run(spark, source, wh, snapshot_id="20260601T000000Z")
    bad = write_snapshot(os.path.join(scratch_dir, "bad"), USERS_CSV, events_csv(STORY[:4]), ASSIGN_CSV)
    with pytest.raises(GateFailed):
        pipeline.run(spark, bad, wh, snapshot_id="20260601T000000Z")
    assert contracts.read_source(spark, f"{wh}/marts", "fct_funnel", "20260601T000000Z").count() == 15


def test_increments_equal_a_whole_build(spark, scratch_dir, source):
    wh, one = os.path.join(scratch_dir, "steps"), os.path.join(scratch_dir, "once")
    lines = events_csv().splitlines()
    days = [lines[1:6], [*lines[6:], "w99,nobody,signup,not a time,,,,,{}", "cut,off"], lines[4:9]]
    for k, day in enumerate(days):
        src = write_snapshot(os.path.join(scratch_dir, f"day{k}"), USERS_CSV, "\n".join([lines[0], *day]) + "\n", ASSIGN_CSV)
        res = pipeline.run_increment(spark, src, wh, snapshot_id=f"day-{k}", enforce_gate=k > 0)
    assert contracts.read_source(spark, f"{wh}/increments", "raw_events_rejected", "day-1").count() == 2
    assert res.rejected == {"dim_users": 0, "raw_events": 0, "ab_test_assignments": 0} and res.churn_auc is None
    pipeline.run(spark, source, one)
    for name in (*pipeline.MART_NAMES, *pipeline.REPORT_NAMES, "int_user_activity", "user_behavior"):
        a, b = (contracts.read_source(spark, f"{root}/marts", name) for root in (wh, one))
        assert sorted(map(str, a.select(*sorted(a.columns)).collect())) == sorted(map(str, b.select(*sorted(b.columns)).collect())), name


def test_model_fit_after_a_load_in_the_same_session(spark, scratch_dir, source):
    from tidemark.operators.churn import fit_churn_model

    pipeline.run(spark, source, os.path.join(scratch_dir, "wh"))
    rows = spark.range(200).select(
        F.col("id").cast("string").alias("user_id"), (F.col("id") % 9).alias("session_count"), (F.col("id") % 4).alias("feature_events"),
        (F.col("id") % 13).alias("days_since_active"), (F.col("id") % 5).alias("revenue_total"),
        F.when((F.col("id") % 13 > 7) & (F.col("id") % 7 > 0), 1).otherwise(0).alias("churned"),
    )
    assert fit_churn_model(rows)["auc"] > 0.8


def test_verify_warehouse_after_build(spark, scratch_dir, source):
    wh = os.path.join(scratch_dir, "wh")
    pipeline.run(spark, source, wh, snapshot_id="20260601T000000Z")
    out = pipeline.verify_warehouse(spark, wh)
    assert out["counts"]["raw_events"] == 11 and out["counts"]["fct_funnel"] == 15
    assert len(out["checks"]) == 6 and all(out["checks"].values())


def test_command_line_build_verify_and_contract_failure(spark, scratch_dir, source, capsys):
    wh = os.path.join(scratch_dir, "wh")
    assert pipeline.main(["build", source, wh, "--snapshot-id", "20260601T000000Z"]) == 0
    assert pipeline.main(["verify", wh]) == 0
    assert '"funnel_has_five_rows_per_user": true' in capsys.readouterr().out
    bad = write_snapshot(os.path.join(scratch_dir, "bad"), USERS_CSV + USERS_CSV.splitlines()[1] + "\n", events_csv(), ASSIGN_CSV)
    assert pipeline.main(["build", bad, wh, "--snapshot-id", "20260602T000000Z"]) == 1
    assert "duplicate key" in capsys.readouterr().out
    assert contracts.current_snapshot(spark, f"{wh}/raw") == "20260601T000000Z"

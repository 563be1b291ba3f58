import pytest
from pyspark.sql import functions as F

from tidemark.operators import intermediate, marts, quality


def _failures(df):
    return {(r["model"], r["column_name"], r["test"]): r["failures"] for r in df.collect()}


@pytest.fixture()
def models(sample):
    ev, users, asg = sample["events"], sample["users"], sample["assignments"]
    steps = intermediate.user_funnel_steps(ev)
    return {
        "stg_raw_events": ev,
        "stg_dim_users": users,
        "stg_ab_test_assignments": asg,
        "fct_funnel": marts.fct_funnel(steps),
        "fct_cohort_retention": marts.fct_cohort_retention(users, ev),
        "fct_ab_tests": marts.fct_ab_tests(asg, ev),
        "fct_feature_engagement": marts.fct_feature_engagement(ev),
    }


def _suite(m, **override):
    m = {**m, **override}
    return quality.product_data_tests(
        m["stg_raw_events"], m["stg_dim_users"], m["stg_ab_test_assignments"], m["fct_funnel"],
        m["fct_cohort_retention"], m["fct_ab_tests"], m["fct_feature_engagement"],
    )


def test_suite_has_25_tests_and_sample_passes(models):
    got = _failures(_suite(models))
    assert len(got) == 25
    tests = [k[2] for k in got]
    assert (tests.count("not_null"), tests.count("unique"), tests.count("accepted_values"), tests.count("relationships")) == (15, 2, 6, 2)
    assert all(v == 0 for v in got.values())


def test_seeded_bad_rows_are_reported(spark, models):
    ev = models["stg_raw_events"]
    bad_ev = ev.unionAll(ev.limit(1)).unionAll(
        ev.limit(1).select(
            F.lit("evX").alias("event_id"), F.lit("nobody").alias("user_id"), F.lit("bogus").alias("event_name"),
            *[c for c in ev.columns[3:]],
        )
    )
    got = _failures(_suite(models, stg_raw_events=bad_ev))
    assert got[("stg_raw_events", "event_id", "unique")] == 1
    assert got[("stg_raw_events", "user_id", "relationships")] == 1
    assert got[("stg_raw_events", "event_name", "accepted_values")] == 1
    users = models["stg_dim_users"]
    null_user = users.limit(1).select(F.lit(None).cast("string").alias("user_id"), *users.columns[1:])
    got = _failures(_suite(models, stg_dim_users=users.unionAll(null_user)))
    assert got[("stg_dim_users", "user_id", "not_null")] == 1
    # a NULL child key is ignored by the relationship test
    asg = models["stg_ab_test_assignments"]
    null_child = asg.limit(1).select("experiment_id", F.lit(None).cast("string").alias("user_id"), "variant", "assigned_ts")
    got = _failures(_suite(models, stg_ab_test_assignments=asg.unionAll(null_child)))
    assert got[("stg_ab_test_assignments", "user_id", "relationships")] == 0
    assert got[("stg_ab_test_assignments", "user_id", "not_null")] == 1


def test_singular_duplicate_grain(models):
    assert quality.singular_tests(models["stg_raw_events"], models["fct_ab_tests"], models["fct_funnel"]).count() == 0
    doubled = models["fct_ab_tests"].unionAll(models["fct_ab_tests"])
    rows = quality.singular_tests(models["stg_raw_events"], doubled, models["fct_funnel"]).collect()
    assert {(r["check"], r["records"]) for r in rows} == {("no_duplicate_assignment_grain", 2)}


def test_reconciliation_fails_engagement_on_sample(sample_raw, models):
    tables = {
        "raw_events": sample_raw["raw_events"],
        "dim_users": sample_raw["dim_users"],
        "ab_test_assignments": sample_raw["ab_test_assignments"],
        **{k: v for k, v in models.items() if k in quality.RECONCILIATION_TABLES},
    }
    checks = {r["check"]: r["passed"] for r in quality.reconciliation(tables).collect()}
    assert len(checks) == 6
    assert checks["engagement_mart_is_not_empty"] is False
    assert checks["funnel_has_five_rows_per_user"] is True
    assert checks["staging_event_count_matches_source"] is True
    with pytest.raises(quality.GateFailed, match="engagement_mart_is_not_empty"):
        quality.gate(quality.reconciliation(tables))


def test_non_empty(models):
    rows = {r["model"]: r["passed"] for r in quality.non_empty(
        {"fct_funnel": models["fct_funnel"], "fct_feature_engagement": models["fct_feature_engagement"]}).collect()}
    assert rows == {"fct_funnel": True, "fct_feature_engagement": False}


def test_user_without_events_fails_funnel_row_check(spark, sample_raw, models):
    from tidemark.operators import staging

    extra = spark.createDataFrame(
        [("pia", "2026-02-18T00:00:00+00:00", "team", "direct", "SE")], sample_raw["dim_users"].schema
    )
    raw_users = sample_raw["dim_users"].unionAll(extra)
    tables = {
        "raw_events": sample_raw["raw_events"],
        "dim_users": raw_users,
        "stg_dim_users": staging.stage_users(raw_users),
        "ab_test_assignments": sample_raw["ab_test_assignments"],
        **{k: v for k, v in models.items() if k in quality.RECONCILIATION_TABLES and k != "stg_dim_users"},
    }
    checks = {r["check"]: (r["expected"], r["actual"], r["passed"]) for r in quality.reconciliation(tables).collect()}
    assert checks["funnel_has_five_rows_per_user"] == (25, 20, False)
    assert checks["staging_user_count_matches_source"] == (5, 5, True)


def test_render_markdown(spark, sample):
    from tidemark.operators.report import daily_metrics, render_markdown

    text = render_markdown(daily_metrics(sample["users"], sample["events"], sample["assignments"]))
    assert text.startswith("# Product metrics of the day")
    assert "- biggest_dropoff_step: **teammate_invited**" in text
    assert "- biggest_dropoff: **100.0%**" in text
    assert "- users: **4**" in text and "- events: **17**" in text and "- experiments: **2**" in text


def _metrics(report):
    return {r["metric"]: (r["value"], r["display"]) for r in report.collect()}


def test_report_with_an_empty_arm_or_one_step(spark, sample):
    from tidemark.operators.report import daily_metrics

    one_arm = sample["assignments"].filter("variant = 'control'")
    got = _metrics(daily_metrics(sample["users"], sample["events"], one_arm))
    assert got["treatment_rate"] == (None, "n/a") and got["p_value"] == (None, "n/a")
    assert got["control_rate"][1] == "66.67%"
    single = _metrics(daily_metrics(sample["users"], sample["events"], sample["assignments"], ["signup"]))
    assert single["biggest_dropoff_step"] == (None, "Not enough data for drop-off analysis")
    assert "biggest_dropoff" not in single and single["signup:users"] == (3.0, "3")
    nothing = _metrics(daily_metrics(sample["users"], sample["events"].limit(0), sample["assignments"]))
    assert nothing["events"] == (0.0, "0") and not any(":" in m for m in nothing)


def test_report_reads_events_once(spark):
    from tidemark.plans.driver_queries import order_world
    from tidemark.operators.report import daily_metrics

    from .conftest import SMOKE_DIR

    w = order_world(spark, SMOKE_DIR)
    users = spark.createDataFrame([(1,)], "user_id long")
    asg = spark.createDataFrame([("e", 1, "control")], "experiment_id string, user_id long, variant string")
    plan = daily_metrics(users, w["events"], asg)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_display_formats_round_half_to_even(spark):
    from tidemark.functions import fmt

    values = [0.0, 1 / 16, 0.0025, 0.1774, 0.5, 1.0, -0.0375, 0.99995, 1e-9, 2 / 3, *[i / 1600 for i in range(400)]]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    rows = df.select("v", fmt.percent(F.col("v"), 1).alias("p1"), fmt.percent(F.col("v"), 2).alias("p2"), fmt.shown(fmt.percent(F.col("v"), 1)).alias("s")).collect()
    for r in rows[:-1]:
        assert (r["p1"].replace(",", ""), r["p2"].replace(",", "")) == (f"{r['v']:.1%}", f"{r['v']:.2%}")
    assert rows[-1]["p1"] is None and rows[-1]["s"] == "n/a"

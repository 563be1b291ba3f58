import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import intermediate, marts
from tidemark.operators.churn import behavior_table

T = dt.datetime


def _by_user(df):
    return {r["user_id"]: r.asDict() for r in df.collect()}


def test_user_activity(sample):
    out = _by_user(intermediate.user_activity(sample["events"], "2026-03-01 00:00:00"))
    got = {u: (r["session_count"], r["feature_events"], float(r["revenue_total"]), r["churned_flag"], r["days_since_active"]) for u, r in out.items()}
    assert got == {
        "lena": (2, 0, 30.25, 0, 16),  # last seen 02-12 07:30
        "marco": (1, 0, 0.0, 0, 19),  # 02-09 02:00
        "nia": (1, 0, 0.0, 1, 2),  # 02-26 06:00
        "oki": (1, 0, 0.0, 0, 8),  # 02-20 10:00
    }
    assert out["lena"]["first_event_ts"] == T(2026, 2, 3, 8, 15) and out["marco"]["last_event_ts"] == T(2026, 2, 9, 2, 0)


def test_user_activity_negative_days_and_default_reference(spark):
    ev = spark.createDataFrame(
        [("a", "session_started", T(2026, 8, 1, 23, 0), 0), ("b", "churned", T(2026, 7, 20, 12, 0), 0)],
        "user_id string, event_name string, event_ts timestamp_ntz, revenue int",
    )
    out = _by_user(intermediate.user_activity(ev, "2026-07-26 00:00:00"))
    assert out["a"]["days_since_active"] == -6  # -6d23h truncates toward zero
    assert out["b"]["churned_flag"] == 1 and out["b"]["days_since_active"] == 5
    latest = _by_user(intermediate.user_activity(ev, None))
    assert latest["a"]["days_since_active"] == 0 and latest["b"]["days_since_active"] == 12
    clipped = _by_user(behavior_table(ev, "2026-07-26 00:00:00"))
    assert clipped["a"]["days_since_active"] == 0


def test_feature_prefix_literal_vs_like(spark):
    ev = spark.createDataFrame(
        [("a", "featureXused", T(2026, 1, 1), 0), ("a", "feature_export_used", T(2026, 1, 2), 0)],
        "user_id string, event_name string, event_ts timestamp_ntz, revenue int",
    )
    lit = _by_user(intermediate.user_activity(ev, "2026-07-26 00:00:00"))["a"]["feature_events"]
    like = _by_user(intermediate.user_activity(ev, "2026-07-26 00:00:00", feature_match="like"))["a"]["feature_events"]
    assert (lit, like) == (1, 2)
    assert marts.fct_feature_engagement(ev).count() == 1
    assert marts.fct_feature_engagement(ev, feature_match="like").count() == 2


def test_funnel_steps_and_fct_funnel(sample):
    wide = intermediate.user_funnel_steps(sample["events"])
    steps = _by_user(wide)
    assert steps["lena"]["onboarding_started_ts"] == T(2026, 2, 3, 8, 50)  # the first of two
    assert steps["nia"]["first_project_created_ts"] == T(2026, 2, 13, 16, 0)
    assert steps["marco"]["onboarding_completed_ts"] is None and steps["oki"]["signup_ts"] is None
    f = marts.fct_funnel(wide)
    assert f.columns == ["user_id", "stage", "converted_at", "dropped"]
    assert f.count() == 20
    dropped = {r["user_id"]: r["n"] for r in f.filter("dropped").groupBy("user_id").agg(F.count("*").alias("n")).collect()}
    assert dropped == {"lena": 2, "marco": 3, "nia": 1, "oki": 5}


def test_cohort_mart(sample):
    rows = sorted(tuple(r) for r in marts.fct_cohort_retention(sample["users"], sample["events"]).collect())
    assert rows == [(dt.date(2026, 2, 2), 1, 2), (dt.date(2026, 2, 9), 1, 1), (dt.date(2026, 2, 9), 2, 1)]


def test_ab_mart(sample):
    rows = marts.fct_ab_tests(sample["assignments"], sample["events"]).collect()
    got = {(r["experiment_id"], r["user_id"]): (r["variant"], r["converted"], float(r["revenue"])) for r in rows}
    assert got == {
        ("tour", "lena"): ("control", 1, 30.25),
        ("tour", "marco"): ("treatment", 0, 0.0),
        ("tour", "nia"): ("treatment", 1, 0.0),
        ("price", "lena"): ("treatment", 1, 30.25),
        ("price", "nia"): ("control", 1, 0.0),
        ("price", "oki"): ("control", 0, 0.0),
    }


def test_ab_mart_two_experiments_and_no_events(spark, sample):
    asg = spark.createDataFrame(
        [("e1", "lena", "control", T(2026, 1, 1)), ("e2", "lena", "treatment", T(2026, 1, 1)), ("e1", "ghost", "control", T(2026, 1, 1))],
        "experiment_id string, user_id string, variant string, assigned_ts timestamp_ntz",
    )
    out = marts.fct_ab_tests(asg, sample["events"])
    assert out.filter("user_id = 'lena'").count() == 2
    ghost = out.filter("user_id = 'ghost'").first()
    assert ghost["converted"] == 0 and float(ghost["revenue"]) == 0.0


def test_engagement_empty_on_sample(sample):
    assert marts.fct_feature_engagement(sample["events"]).count() == 0


def test_behavior_table_own_reference_time(sample):
    out = _by_user(behavior_table(sample["events"]))
    assert {u: r["days_since_active"] for u, r in out.items()} == {"lena": 13, "marco": 17, "nia": 0, "oki": 5}

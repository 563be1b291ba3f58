"""A user holding most events: results must equal a brute-force computation on the same rows."""

import datetime as dt

import pandas as pd
import pytest

from tidemark.operators import cohort, intermediate, quality
from tidemark.operators.funnel import funnel

HOT = "hot"


@pytest.fixture(scope="module")
def skewed(spark):
    rows = []
    names = ["signup", "session_started", "feature_collab_used", "subscription_payment", "onboarding_started"]
    for i in range(3000):  # the hot user: 3000 events spread over 10 weeks
        rows.append((f"h{i}", HOT, names[i % 5], dt.datetime(2026, 1, 5) + dt.timedelta(hours=7 * i % 1680), 1.5))
    for u in range(40):
        for j in range(u % 4 + 1):
            rows.append((f"u{u}-{j}", f"u{u}", names[(u + j) % 5], dt.datetime(2026, 1, 5 + u % 20, j), 2.0))
    pdf = pd.DataFrame(rows, columns=["event_id", "user_id", "event_name", "event_ts", "revenue"])
    sdf = spark.createDataFrame(pdf, "event_id string, user_id string, event_name string, event_ts timestamp_ntz, revenue double")
    return pdf, sdf.repartition(8)


def test_activity_matches_brute_force(skewed):
    pdf, sdf = skewed
    got = {r["user_id"]: r for r in intermediate.user_activity(sdf, "2026-07-26 00:00:00").collect()}
    for user, g in pdf.groupby("user_id"):
        assert got[user]["session_count"] == (g.event_name == "session_started").sum()
        assert got[user]["feature_events"] == g.event_name.str.startswith("feature_").sum()
        assert got[user]["revenue_total"] == pytest.approx(g.loc[g.event_name == "subscription_payment", "revenue"].sum())
    assert len(got) == pdf.user_id.nunique()


def test_funnel_counts_match_brute_force(skewed):
    pdf, sdf = skewed
    got = {r["step"]: r["users"] for r in funnel(sdf).collect()}
    for step, n in got.items():
        assert n == pdf.loc[pdf.event_name == step, "user_id"].nunique()


def test_retention_with_hot_user(spark, skewed):
    pdf, sdf = skewed
    users = spark.createDataFrame(
        [(u, dt.datetime(2026, 1, 5)) for u in pdf.user_id.unique()], "user_id string, signup_ts timestamp_ntz"
    )
    got = {(r["period_number"]): (r["retained"], r["users"]) for r in cohort.retention(sdf, users).collect()}
    s = pdf[pdf.event_name == "session_started"].copy()
    s["period"] = (s.event_ts.dt.to_period("W").dt.start_time - pd.Timestamp("2026-01-05")).dt.days // 7
    expected = s.groupby("period").user_id.nunique().to_dict()
    assert {k: v[0] for k, v in got.items()} == expected
    assert all(v[1] == pdf.user_id.nunique() for v in got.values())


def test_checks_with_hot_key(spark, skewed):
    pdf, sdf = skewed
    parents = spark.createDataFrame([(u,) for u in pdf.user_id.unique() if u != HOT], "user_id string")
    rel = quality.relationship_check(sdf, "events", "user_id", parents, "user_id").first()["failures"]
    assert rel == (pdf.user_id == HOT).sum()
    dup = sdf.unionAll(sdf.filter(f"user_id = '{HOT}'").limit(5))
    assert quality.unique_check(dup, "events", "event_id").first()["failures"] == 5
    grain = {r["event_id"]: r["records"] for r in quality.duplicate_grain(dup, ["event_id"]).collect()}
    assert len(grain) == 5 and set(grain.values()) == {2}

from __future__ import annotations

import os
import sys
import tempfile
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="tidemark-tests-")
    session = build_session(
        "local[4]", app_name="tidemark-tests", shuffle_partitions=4, extra_conf={"spark.local.dir": scratch}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="tidemark-test-run-")


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


EVENT_COLS = "event_id string, user_id string, event_name string, event_ts string, session_id string, " \
    "experiment_id string, variant string, revenue decimal(20,6), properties string"


@pytest.fixture()
def sample_raw(spark):
    """Four users in two signup weeks, seventeen events with offsets, ties and repeats, two experiments."""
    users = spark.createDataFrame(
        [
            ("lena", "2026-02-03T09:15:00+01:00", "pro", "paid_search", "DE"),
            ("marco", "2026-02-05T22:40:00-03:00", "team", "direct", "IN"),
            ("nia", "2026-02-10T12:00:00+00:00", "free", "referral", "GB"),
            ("oki", "2026-02-16T00:30:00+02:00", "enterprise", "linkedin_ads", "CA"),  # Sunday 22:30 in UTC
        ],
        "user_id string, signup_ts string, plan string, channel string, country string",
    )
    rows = [
        ("a01", "lena", "signup", "2026-02-03T08:15:00Z", 0),
        ("a02", "lena", "onboarding_started", "2026-02-03T08:50:00Z", 0),
        ("a03", "lena", "onboarding_started", "2026-02-04T10:00:00Z", 0),
        ("a04", "lena", "onboarding_completed", "2026-02-04T10:20:00Z", 0),
        ("a05", "lena", "session_started", "2026-02-11T07:00:00Z", 0),
        ("a06", "lena", "session_started", "2026-02-12T07:00:00Z", 0),
        ("a07", "lena", "subscription_payment", "2026-02-12T07:30:00Z", 30.25),
        ("a08", "marco", "signup", "2026-02-06T01:40:00Z", 0),
        ("a09", "marco", "session_started", "2026-02-08T23:30:00-02:00", 0),  # Monday in UTC
        ("a10", "marco", "onboarding_started", "2026-02-09T02:00:00Z", 0),
        ("a11", "nia", "signup", "2026-02-10T12:00:00Z", 0),
        ("a12", "nia", "onboarding_started", "2026-02-10T12:05:00Z", 0),
        ("a13", "nia", "onboarding_completed", "2026-02-10T12:09:00Z", 0),
        ("a14", "nia", "first_project_created", "2026-02-13T16:00:00Z", 0),
        ("a15", "nia", "session_started", "2026-02-25T06:00:00Z", 0),
        ("a16", "nia", "churned", "2026-02-26T06:00:00Z", 0),
        ("a17", "oki", "session_started", "2026-02-20T10:00:00Z", None),  # never signed up by event
    ]
    events = spark.createDataFrame(
        [(i, u, n, t, f"visit-{i}", None, None, r if r is None else float(r), "{}") for i, u, n, t, r in rows],
        EVENT_COLS.replace("decimal(20,6)", "double"),
    )
    assignments = spark.createDataFrame(
        [
            ("tour", "lena", "control", "2026-02-03T08:15:00Z"),
            ("tour", "marco", "treatment", "2026-02-06T01:40:00Z"),
            ("tour", "nia", "treatment", "2026-02-10T12:00:00Z"),
            ("price", "lena", "treatment", "2026-02-04T00:00:00Z"),
            ("price", "nia", "control", "2026-02-11T00:00:00Z"),
            ("price", "oki", "control", "2026-02-16T00:00:00Z"),
        ],
        "experiment_id string, user_id string, variant string, assigned_ts string",
    )
    return {"dim_users": users, "raw_events": events, "ab_test_assignments": assignments}


@pytest.fixture()
def sample(sample_raw):
    from tidemark.operators import staging

    return {
        "users": staging.stage_users(sample_raw["dim_users"]),
        "events": staging.stage_events(sample_raw["raw_events"]),
        "assignments": staging.stage_assignments(sample_raw["ab_test_assignments"]),
    }

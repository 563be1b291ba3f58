import datetime as dt

import pytest

from tidemark.operators.cohort import cohort_sizes, heatmap, period_numbers, retention

D = dt.date


def _rows(df):
    return [tuple(r) for r in df.collect()]


FIRST, SECOND = D(2026, 2, 2), D(2026, 2, 9)


def test_weekly(sample):
    out = retention(sample["events"], sample["users"], "weekly")
    assert out.columns == ["cohort_period", "period_number", "retained", "users", "retention_rate"]
    # lena and marco came back a week later; of the second week oki after one and nia after two
    assert _rows(out) == [(FIRST, 1, 2, 2, 1.0), (SECOND, 1, 1, 2, 0.5), (SECOND, 2, 1, 2, 0.5)]


def test_monthly(sample):
    assert _rows(retention(sample["events"], sample["users"], "monthly")) == [(D(2026, 2, 1), 0, 4, 4, 1.0)]


def test_heatmap(sample):
    table = retention(sample["events"], sample["users"], "weekly")
    assert period_numbers(table) == [1, 2]
    hm = heatmap(table, period_numbers(table))
    assert hm.columns == ["cohort_period", "1", "2"]
    assert _rows(hm) == [("2026-02-02", 1.0, 0.0), ("2026-02-09", 0.5, 0.5)]


def test_heatmap_fills_missing_cells(spark):
    users = spark.createDataFrame([("a", "2026-01-05T00:00:00Z"), ("b", "2026-01-12T00:00:00Z")], "user_id string, signup_ts string")
    ev = spark.createDataFrame(
        [("a", "session_started", "2026-01-19T00:00:00Z"), ("b", "session_started", "2026-01-12T10:00:00Z")],
        "user_id string, event_name string, event_ts string",
    )
    hm = heatmap(retention(ev, users, "weekly"), periods=[0, 1, 2])
    assert _rows(hm) == [("2026-01-05", 0.0, 0.0, 1.0), ("2026-01-12", 1.0, 0.0, 0.0)]


def test_cohort_size_counts_inactive_users(spark):
    users = spark.createDataFrame(
        [("a", "2026-01-05T00:00:00Z"), ("b", "2026-01-06T00:00:00Z"), ("c", "2026-01-07T00:00:00Z")],
        "user_id string, signup_ts string",
    )
    ev = spark.createDataFrame([("a", "session_started", "2026-01-13T00:00:00Z")], "user_id string, event_name string, event_ts string")
    assert _rows(retention(ev, users)) == [(D(2026, 1, 5), 1, 1, 3, pytest.approx(1 / 3))]
    assert _rows(cohort_sizes(users)) == [(D(2026, 1, 5), 3)]


def test_edges_before_signup_sunday_and_bad_timestamp(spark):
    users = spark.createDataFrame([("a", "2026-01-11T23:00:00Z")], "user_id string, signup_ts string")  # a Sunday
    ev = spark.createDataFrame(
        [
            ("a", "session_started", "2026-01-01T00:00:00Z"),  # before the signup week: dropped
            ("a", "session_started", "2026-01-12T00:00:00Z"),  # next Monday: period 1
            ("a", "session_started", "not a time"),  # unparseable: dropped
        ],
        "user_id string, event_name string, event_ts string",
    )
    assert _rows(retention(ev, users)) == [(D(2026, 1, 5), 1, 1, 1, 1.0)]


def test_offset_converted_to_utc(spark):
    users = spark.createDataFrame([("a", "2026-01-01T00:00:00+02:00")], "user_id string, signup_ts string")
    ev = spark.createDataFrame([("a", "session_started", "2026-01-01T00:00:00Z")], "user_id string, event_name string, event_ts string")
    # 2025-12-31 22:00 UTC: month cohort is December 2025, January activity is period 1
    assert _rows(retention(ev, users, "monthly")) == [(D(2025, 12, 1), 1, 1, 1, 1.0)]


def test_unknown_period_rejected(sample):
    with pytest.raises(ValueError):
        retention(sample["events"], sample["users"], "daily")


def test_empty_retention_and_heatmap(spark):
    ev = spark.createDataFrame([], "user_id string, event_name string, event_ts string")
    users = spark.createDataFrame([("a", "2026-01-01T00:00:00Z")], "user_id string, signup_ts string")
    assert retention(ev, users).count() == 0
    hm = heatmap(retention(ev, users), period_numbers(retention(ev, users)))
    assert hm.columns == ["cohort_period"] and hm.count() == 0

import pytest
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.operators.funnel import biggest_dropoff, funnel

# three users signed up and started, lena and nia completed, nia made a project, nobody invited
EXPECTED = [
    ("signup", 3, 1.0, 0.0),
    ("onboarding_started", 3, 1.0, 0.0),
    ("onboarding_completed", 2, 2 / 3, 1 - 2 / 3),
    ("first_project_created", 1, 0.5, 0.5),
    ("teammate_invited", 0, 0.0, 1.0),
]


def _rows(df):
    return [tuple(r) for r in df.collect()]


def test_funnel_counts_each_user_once_per_step(sample):
    out = funnel(sample["events"])
    assert out.columns == ["step", "users", "conversion_from_previous", "dropoff_from_previous"]
    assert _rows(out) == EXPECTED


def test_biggest_dropoff(sample):
    assert _rows(biggest_dropoff(sample["events"])) == [("teammate_invited", 1.0, 0.0)]


@pytest.mark.parametrize("steps", [None, []])
def test_default_steps(sample, steps):
    assert [r[0] for r in _rows(funnel(sample["events"], steps))] == list(K.DEFAULT_FUNNEL_STEPS)


def test_custom_and_unknown_steps(sample):
    out = _rows(funnel(sample["events"], ["onboarding_completed", "no_such_step", "signup"]))
    assert out == [
        ("onboarding_completed", 2, 1.0, 0.0),
        ("no_such_step", 0, 0.0, 1.0),
        ("signup", 3, 1.0, 0.0),
    ]


def test_one_step_has_no_biggest_dropoff(sample):
    assert biggest_dropoff(sample["events"], ["signup"]).count() == 0


def test_empty_events_give_empty_funnel(sample):
    empty = sample["events"].filter(F.lit(False))
    out = funnel(empty)
    assert out.count() == 0
    assert out.columns == ["step", "users", "conversion_from_previous", "dropoff_from_previous"]
    assert biggest_dropoff(empty).count() == 0


def test_funnel_is_unordered(spark):
    # a user who completes onboarding without a signup still counts for that step
    ev = spark.createDataFrame(
        [("x", "onboarding_completed", "2026-01-01T00:00:00Z")], "user_id string, event_name string, event_ts string"
    )
    out = dict((r[0], r[1]) for r in _rows(funnel(ev)))
    assert out["signup"] == 0 and out["onboarding_completed"] == 1


def test_tie_goes_to_earlier_step(spark):
    ev = spark.createDataFrame(
        [("a", "s1", "t"), ("b", "s1", "t"), ("a", "s2", "t"), ("a", "s3", "t")],
        "user_id string, event_name string, event_ts string",
    )
    # s2: 1/2 -> dropoff .5 ; s3: 1/1 -> 0 ; s4: 0 -> dropoff 1.0
    assert _rows(biggest_dropoff(ev, ["s1", "s2", "s3", "s4"]))[0][0] == "s4"
    assert _rows(biggest_dropoff(ev, ["s1", "s2", "s1", "s2"]))[0][0] == "s2"

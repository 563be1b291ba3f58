"""The incremental build equals a full build, whatever the order and repetition of its batches."""

import random
from collections import Counter

from pyspark.sql import functions as F

from tidemark.plans import incremental, pipeline

MODELS = ("int_user_activity", "int_user_funnel_steps", "fct_funnel", "fct_cohort_retention", "fct_ab_tests", "fct_feature_engagement")


def rows(df):
    return Counter(tuple(str(v) for v in r) for r in df.select(*sorted(df.columns)).collect())


def test_days_in_any_order_equal_a_full_build(spark, sample, sample_raw, scratch_dir):
    days = [r[0] for r in sample["events"].select("event_date").distinct().collect()]
    random.Random(4).shuffle(days)
    for day in [*days, days[0]]:
        assert incremental.add_events(spark, scratch_dir, sample["events"].filter(F.col("event_date") == day)) == [day]
    for as_of in ("2026-03-01", None):
        got = incremental.models(spark, scratch_dir, sample["users"], sample["assignments"], as_of)
        want = pipeline.build_models(sample_raw, as_of)
        for name in MODELS:
            assert got[name].columns == want[name].columns and rows(got[name]) == rows(want[name]), name
    assert rows(got["stg_raw_events"]) == rows(want["stg_raw_events"])


def test_late_and_corrected_events_touch_their_dates_only(spark, sample, scratch_dir):
    events = sample["events"]
    late = F.col("event_id").isin("a04", "a09")
    incremental.add_events(spark, scratch_dir, events.filter(~late))
    untouched = {f.split("/events/")[1] for f in spark.read.parquet(f"{scratch_dir}/events").inputFiles()}
    dates = incremental.add_events(spark, scratch_dir, events.filter(late))
    assert len(dates) == 2
    after = {f.split("/events/")[1] for f in spark.read.parquet(f"{scratch_dir}/events").inputFiles()}
    changed = {f.split("/")[0] for f in untouched ^ after}
    assert changed == {f"event_date={d}" for d in dates}
    models = incremental.models(spark, scratch_dir, sample["users"], sample["assignments"])
    assert models["stg_raw_events"].count() == 17

    corrected = events.filter("event_id = 'a07'").withColumn("revenue", F.lit(99).cast(events.schema["revenue"].dataType))
    incremental.add_events(spark, scratch_dir, corrected)
    models = incremental.models(spark, scratch_dir, sample["users"], sample["assignments"])
    assert models["stg_raw_events"].count() == 17
    assert {r[0]: float(r[1]) for r in models["int_user_activity"].select("user_id", "revenue_total").collect()}["lena"] == 99.0


def test_a_date_can_lose_its_features(spark, sample, scratch_dir):
    one = sample["events"].filter("event_id = 'a14'").withColumn("event_name", F.lit("feature_export_used"))
    incremental.add_events(spark, scratch_dir, one)
    read = lambda: incremental.models(spark, scratch_dir, sample["users"], sample["assignments"])
    assert read()["fct_feature_engagement"].count() == 1
    incremental.add_events(spark, scratch_dir, one.withColumn("event_name", F.lit("session_started")))
    assert read()["fct_feature_engagement"].count() == 0
    assert incremental.add_events(spark, scratch_dir, one.limit(0)) == []


def test_state_grows_with_users_and_days_not_events(spark, sample):
    many = sample["events"].crossJoin(spark.range(200))
    days = incremental.user_days(many, incremental.Rules())
    assert days.count() == sample["events"].select("user_id", "event_date").distinct().count()

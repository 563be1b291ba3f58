"""Positions, bitmaps, bucketed models and rejected rows."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import bitmaps, cohort, marts
from tidemark.operators.position import global_position
from tidemark.plans.driver_queries import A, bucketed_orders
from tidemark.sources import bucketed, quarantine
from tidemark.sources.schemas import CONTRACTS

from .conftest import SMOKE_DIR, ts
from .test_plans import plan


def test_positions_with_ties_and_a_hot_value(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, 1.0, 1.0, 1.0, rng.random()]), f"x{i % 3}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, v double, t string").repartition(5)
    out = global_position(df, ["v", "id"], partitions=7)
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    assert [tuple(r) for r in out.orderBy("position").collect()] == [(*r, k) for k, r in enumerate(want, 1)]
    sizes = [n for _, n in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 3000
    assert global_position(df.limit(0), ["v", "id"]).collect() == []
    windows = re.findall(r"Window \[.*", plan(out))
    assert windows and all("windowspecdefinition(_part#" in w for w in windows)  # no window over all rows


def test_bitmaps_merge_days_and_later_users(spark, sample):
    first = bitmaps.number_users(sample["users"].filter("user_id <> 'marco'")).cache()
    numbers = bitmaps.number_users(sample["users"], known=first).cache()
    assert dict(numbers.select("user_id", "number").collect()) == {"lena": 1, "nia": 2, "oki": 3, "marco": 4}
    names = ["session_started", "feature_export_used", "subscription_payment"]
    # days arrive one by one, one of them twice
    days = None
    for date in ["2026-02-11", "2026-02-12", "2026-02-25", "2026-02-20", "2026-02-09", "2026-02-08", "2026-02-12"]:
        day = bitmaps.daily_bitmaps(sample["events"].filter(F.col("event_date") == date), numbers, names)
        days = day if days is None else days.unionByName(day)
    for period in ("weekly", "monthly"):
        got = bitmaps.retention_of(days, bitmaps.cohort_bitmaps(numbers, period), period)
        want = cohort.retention(sample["events"], sample["users"], period, names)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []


def test_bitmaps_of_several_blocks(spark):
    n = 100_000
    users = spark.range(n).select("id", F.expr("timestamp_ntz'2026-01-05 00:00:00' + make_dt_interval(id % 21)").alias("signup_ts"))
    users = users.withColumnRenamed("id", "user_id")
    numbers = bitmaps.number_users(users).cache()
    assert numbers.agg(F.min("number"), F.max("number"), F.countDistinct("number")).first() == (1, n, n)
    events = users.filter("user_id % 3 = 0").select(
        "user_id", F.lit("session_started").alias("event_name"), F.expr("signup_ts + interval 9 days").alias("event_ts")
    )
    got = bitmaps.retention_of(bitmaps.daily_bitmaps(events, numbers), bitmaps.cohort_bitmaps(numbers, "weekly"), "weekly")
    want = cohort.retention(events, users, "weekly")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []


def test_bounds_come_from_footers(spark):
    from tidemark.sources.io import footer_bounds

    out = footer_bounds(spark, f"{SMOKE_DIR}/lineitem.parquet", ["l_orderkey"])
    assert "PushedAggregation: [COUNT(*), MIN(l_orderkey), MAX(l_orderkey)]" in plan(out)
    lineitem = spark.read.parquet(f"{SMOKE_DIR}/lineitem.parquet")
    assert out.first() == lineitem.agg(F.count("*"), F.min("l_orderkey"), F.max("l_orderkey")).first()


def exchanges(p: str) -> list[str]:
    return re.findall(r"Exchange (\w+)", p)


def test_bucketed_models_join_without_an_exchange(spark):
    m = bucketed_orders(spark, SMOKE_DIR)
    out = marts.fct_ab_tests(m["order_assignments"], m["order_events"], A.ORDER_CONVERSION_EVENTS, A.ORDER_PAYMENT_EVENT)
    # without the size of these small tables, which would be broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(plan(out)) == []
        assert out.count() == m["order_assignments"].count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_definitions_outlive_the_session(spark, scratch_dir):
    users = spark.createDataFrame([("a", 1), ("b", 2), ("it's", None)], "user_id string, `odd name` int")
    bucketed.save_model(users, scratch_dir, "dim", ["user_id"], 2)
    bucketed.save_model(users.filter("user_id <> 'b'"), scratch_dir, "dim", ["user_id"], 4)
    bucketed.save_view(spark, scratch_dir, "named", "SELECT user_id FROM dim WHERE `odd name` IS NOT NULL")
    other = spark.newSession()
    for name in bucketed.definitions(spark, scratch_dir):
        other.sql(f"DROP VIEW IF EXISTS {name}")
    models = bucketed.open_models(other, scratch_dir)
    assert sorted(models) == ["dim", "named"]
    assert sorted(r[0] for r in other.table("dim").collect()) == ["a", "it's"]
    assert [r[0] for r in models["named"].collect()] == ["a"]
    assert len(bucketed.drop_old_versions(spark, scratch_dir, "dim")) == 1
    assert bucketed.open_models(spark.newSession(), scratch_dir)["dim"].count() == 2
    assert bucketed.definitions(spark, os.path.join(scratch_dir, "none")) == {}


@pytest.mark.parametrize(("n_bytes", "buckets"), [(0, 1), (1 << 28, 1), ((1 << 28) + 1, 2), (5 << 28, 8), (100 << 40, 1 << 19)])
def test_bucket_counts_are_powers_of_two(n_bytes, buckets):
    assert bucketed.bucket_count(n_bytes) == buckets


def test_rejected_rows_keep_their_cells_and_reasons(spark, scratch_dir):
    path = os.path.join(scratch_dir, "raw_events.csv")
    with open(path, "w") as fh:
        fh.write(
            "event_id,user_id,event_name,event_ts,session_id,experiment_id,variant,revenue,properties,shoe\n"
            'ok,u1,signup,2026-05-04T07:30:00+02:00,,,,1.5,"{""a"": 1}",42\n'
            "bad time,u1,signup,yesterday,,,,,,\n"
            "two faults,,signup,2026-05-04T07:30:00Z,,,,0.1234567,,7\n"
            "short,u1\n"
            "long,u1,signup,2026-05-04T07:30:00Z,,,,,,1,2,3\n"
            ",,,,,,,,,\n"
        )
    accepted, rejected = quarantine.read_csv_split(spark, path, CONTRACTS["raw_events"])
    row = accepted.collect()
    assert [r["event_id"] for r in row] == ["ok"] and row[0]["event_ts"] == ts("2026-05-04T05:30:00")
    assert accepted.columns == CONTRACTS["raw_events"].schema.fieldNames()
    got = {r["record"]: r["reasons"] for r in rejected.collect()}
    assert got.pop("short,u1") == ["line"] and got.pop("long,u1,signup,2026-05-04T07:30:00Z,,,,,,1,2,3") == ["line"]
    by_id = {r["id"]: r["reasons"] for r in rejected.select(F.get_json_object("record", "$.event_id").alias("id"), "reasons").collect()}
    assert by_id["bad time"] == ["event_ts"] and by_id["two faults"] == ["user_id", "revenue"]
    assert len(got) == 3 and sorted(map(tuple, got.values()))[0] == ("event_id", "user_id", "event_name", "event_ts")

"""Incremental daily build (R4, M1-M6): marts from mergeable per-user state, one partition of state per event date.

A warehouse folder holds three tables partitioned by ``event_date``:

* ``events``: staged events, each id once;
* ``user_days``: per user and day the sums, minima, maxima and flags of M1, M2 and M5;
* ``feature_days``: per user, day and feature the usage count of M6.

:func:`add_events` takes any batch: a new day, a day that was loaded before, or late events of old days. Only the dates in
the batch are read, merged by event id and rewritten (dynamic partition overwrite), so the cost follows the batch and not
the history. Adding the same events again changes nothing, and an update that died on the way is repaired by adding its
batch once more. The models of :func:`models` merge the state: every value is a sum, minimum, maximum or distinct
(user, week) pair, so days can be combined in any order and equal a build over all events.

Marts cost one pass over the state, which has a row per user and active day however many events a day has. An event id
keeps its date: of two versions of an id on one date the one added later stays. One update runs at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.time import as_of_literal, week_start, whole_days_between
from tidemark.operators import marts
from tidemark.operators.intermediate import step_column
from tidemark.operators.predicates import feature_predicate
from tidemark.sources.io import path_exists


@dataclass(frozen=True)
class Rules:
    """The event names that the models know."""

    session_event: str = K.SESSION_EVENT
    feature_prefix: str = K.FEATURE_PREFIX
    payment_event: str = K.PAYMENT_EVENT
    churn_event: str = K.CHURN_EVENT
    funnel_steps: Sequence[str] = tuple(K.DEFAULT_FUNNEL_STEPS)
    conversion_events: Sequence[str] = tuple(K.CONVERSION_EVENTS)
    feature_match: str = "prefix"


def user_days(events: DataFrame, rules: Rules) -> DataFrame:
    """One row per date and user: everything M1, M2, M4 and M5 need of that day."""
    name = F.col("event_name")
    paid = F.when(name == rules.payment_event, F.col("revenue"))
    return events.groupBy("event_date", "user_id").agg(
        F.count_if(name == rules.session_event).alias("session_count"),
        F.count_if(feature_predicate(rules.feature_prefix, rules.feature_match)).alias("feature_events"),
        F.min("event_ts").alias("first_event_ts"),
        F.max("event_ts").alias("last_event_ts"),
        F.sum(F.coalesce(paid, F.lit(0))).alias("revenue_total"),
        F.max(F.when(name == rules.churn_event, 1).otherwise(0)).alias("churned_flag"),
        F.max(F.when(name.isin(*rules.conversion_events), 1).otherwise(0)).alias("converted"),
        *[F.min(F.when(name == s, F.col("event_ts"))).alias(step_column(s)) for s in rules.funnel_steps],
    )


def feature_days(events: DataFrame, rules: Rules) -> DataFrame:
    used = events.filter(feature_predicate(rules.feature_prefix, rules.feature_match))
    return used.groupBy("event_date", "user_id", F.col("event_name").alias("feature_event")).agg(
        F.count(F.lit(1)).alias("usage_count")
    )


def _on_dates(df: DataFrame, dates: list) -> DataFrame:
    day = F.col("event_date")
    known = [d for d in dates if d is not None]
    wanted = day.isin(known) if known else F.lit(False)
    return df.filter(wanted | day.isNull() if None in dates else wanted)


def _replace_dates(df: DataFrame, path: str) -> None:
    """Rewrite the date partitions that ``df`` has; the others stay. Dates are spread evenly, a hot one over many files."""
    writer = df.hint("rebalance", "event_date").write.mode("overwrite").partitionBy("event_date")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def _table(spark: SparkSession, root: str, name: str) -> DataFrame:
    # partition values are read with the type they were written in
    return spark.read.parquet(f"{root.rstrip('/')}/{name}").withColumn("event_date", F.col("event_date").cast("date"))


def _state(events: DataFrame, root: str, name: str, like: DataFrame) -> DataFrame:
    """A stored state table with the columns of ``like``; it may have no rows."""
    return events.sparkSession.read.schema(like.schema).parquet(f"{root.rstrip('/')}/{name}")


def add_events(spark: SparkSession, root: str, staged_events: DataFrame, rules: Rules | None = None) -> list:
    """Merge staged events into the warehouse folder ``root`` and refresh the state of their dates, which are returned."""
    root, rules = root.rstrip("/"), rules or Rules()
    batch_path = f"{root}/_batches/{uuid.uuid4().hex}"
    staged_events.dropDuplicates(["event_id"]).write.parquet(f"{batch_path}/new")
    new = spark.read.parquet(f"{batch_path}/new")
    # one row per date of the batch
    dates = [r[0] for r in new.select("event_date").distinct().collect()]
    if not dates:
        return []
    merged = new
    if path_exists(spark, f"{root}/events"):
        stored = _on_dates(_table(spark, root, "events"), dates).select(*new.columns)
        merged = stored.join(new.select("event_id"), "event_id", "left_anti").select(*new.columns).unionByName(new)
    merged.write.parquet(f"{batch_path}/merged")
    merged = spark.read.schema(new.schema).parquet(f"{batch_path}/merged")
    _replace_dates(merged, f"{root}/events")
    _replace_dates(user_days(merged, rules), f"{root}/user_days")
    features = feature_days(merged, rules)
    if path_exists(spark, f"{root}/feature_days"):
        old = spark.read.schema(features.schema).parquet(f"{root}/feature_days")
        # a date may have lost its last feature event to a newer version: an empty partition cannot be overwritten
        lost = _on_dates(old, dates).select("event_date").distinct()
        gone = lost.join(features.select("event_date").distinct(), "event_date", "left_anti")
        blank = [F.lit(None).cast(features.schema[c].dataType).alias(c) for c in features.columns if c != "event_date"]
        features = features.unionByName(gone.select("event_date", *blank))
        # the folder is read by this plan, so its rows are stored before it is written
        features.write.parquet(f"{batch_path}/features")
        features = spark.read.parquet(f"{batch_path}/features")
    _replace_dates(features, f"{root}/feature_days")
    from tidemark.sources.io import hadoop_path

    fs, p = hadoop_path(spark, batch_path)
    fs.delete(p, True)
    return dates


def user_activity(days: DataFrame, as_of: str | datetime | None) -> DataFrame:
    """M1 from the state."""
    reference: Column = days.select(F.max("last_event_ts")).scalar() if as_of is None else as_of_literal(as_of)
    merged = days.groupBy("user_id").agg(
        F.sum("session_count").alias("session_count"),
        F.sum("feature_events").alias("feature_events"),
        F.min("first_event_ts").alias("first_event_ts"),
        F.max("last_event_ts").alias("last_event_ts"),
        F.sum("revenue_total").alias("revenue_total"),
        F.max("churned_flag").alias("churned_flag"),
    )
    return merged.withColumn("days_since_active", whole_days_between(reference, F.col("last_event_ts")))


def funnel_steps(days: DataFrame, steps: Sequence[str]) -> DataFrame:
    """M2 from the state."""
    return days.groupBy("user_id").agg(*[F.min(step_column(s)).alias(step_column(s)) for s in steps])


def models(
    spark: SparkSession,
    root: str,
    users: DataFrame,
    assignments: DataFrame,
    as_of: str | datetime | None = K.DEFAULT_AS_OF,
    rules: Rules | None = None,
) -> dict[str, DataFrame]:
    """M1-M6 from the stored state, with the staged events as stored."""
    rules = rules or Rules()
    events = _table(spark, root, "events")
    days = _state(events, root, "user_days", user_days(events, rules))
    features = _state(events, root, "feature_days", feature_days(events, rules)).filter(F.col("usage_count").isNotNull())
    steps = funnel_steps(days, rules.funnel_steps)
    active = days.filter(F.col("session_count") > 0).select("user_id", week_start("event_date").alias("active_week"))
    conversion = days.groupBy("user_id").agg(F.max("converted").alias("converted"), F.sum("revenue_total").alias("revenue"))
    usage = features.groupBy("user_id", week_start("event_date").alias("week_start"), "feature_event")
    return {
        "stg_raw_events": events,
        "stg_dim_users": users,
        "stg_ab_test_assignments": assignments,
        "int_user_activity": user_activity(days, as_of),
        "int_user_funnel_steps": steps,
        "fct_funnel": marts.fct_funnel(steps, rules.funnel_steps),
        "fct_cohort_retention": marts.cohort_retention_of(users, active.distinct()),
        "fct_ab_tests": marts.ab_tests_of(assignments, conversion),
        "fct_feature_engagement": usage.agg(F.sum("usage_count").alias("usage_count")),
    }

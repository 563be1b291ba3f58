"""Marts (M3-M6): funnel status, weekly cohort retention, experiment outcomes, feature usage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.time import week_start, weeks_between
from tidemark.operators.intermediate import step_column
from tidemark.operators.predicates import feature_predicate


def fct_funnel(funnel_steps: DataFrame, steps: Sequence[str] = K.DEFAULT_FUNNEL_STEPS) -> DataFrame:
    """M3 ``fct_funnel``: one row per user and stage with ``converted_at`` and ``dropped``.

    The five-way ``UNION ALL`` of the SQL form is an unpivot: Spark plans it as one
    ``Expand`` over a single scan of the step table.
    """
    wide = funnel_steps.select("user_id", *[F.col(step_column(s)).alias(s) for s in steps])
    long = wide.unpivot(
        "user_id", [F.col(f"`{s}`") for s in steps], "stage", "converted_at"
    )
    return long.select(
        "user_id", "stage", "converted_at", F.col("converted_at").isNull().alias("dropped")
    )


def fct_cohort_retention(
    users: DataFrame, events: DataFrame, session_event: str = K.SESSION_EVENT
) -> DataFrame:
    """M4 ``fct_cohort_retention``: retained users per signup week and weeks since signup.

    Sessions are reduced to distinct (user, week) pairs before the join, so the join carries
    at most one row per user and active week however many sessions a user has.
    """
    activity = (
        events.filter(F.col("event_name") == session_event)
        .select("user_id", week_start("event_ts").alias("active_week"))
        .distinct()
    )
    return cohort_retention_of(users, activity)


def cohort_retention_of(users: DataFrame, activity: DataFrame) -> DataFrame:
    """M4 from distinct (user_id, active_week) pairs."""
    signups = users.select("user_id", week_start("signup_ts").alias("cohort_week"))
    cohort_activity = (
        signups.join(activity, "user_id")
        .filter(F.col("active_week") >= F.col("cohort_week"))
        .select(
            "cohort_week",
            weeks_between("active_week", "cohort_week").alias("period_number"),
            "user_id",
        )
    )
    return cohort_activity.groupBy("cohort_week", "period_number").agg(
        F.countDistinct("user_id").alias("retained_users")
    )


def user_conversion(
    events: DataFrame,
    conversion_events: Sequence[str] = K.CONVERSION_EVENTS,
    payment_event: str = K.PAYMENT_EVENT,
) -> DataFrame:
    """Per-user conversion flag (any conversion event) and payment revenue (A4, A5).

    Only conversion and payment rows can change either value, so the rest are filtered out
    before the shuffle (the predicate reaches the Parquet scan); users without such rows get
    0 / 0 from the caller's left join, exactly as when every event is aggregated.
    """
    name = F.col("event_name")
    relevant = events.filter(name.isin(*conversion_events, payment_event))
    return relevant.groupBy("user_id").agg(
        F.max(F.when(name.isin(*conversion_events), 1).otherwise(0)).alias("converted"),
        F.sum(F.when(name == payment_event, F.col("revenue")).otherwise(F.lit(0))).alias("revenue"),
    )


def fct_ab_tests(
    assignments: DataFrame,
    events: DataFrame,
    conversion_events: Sequence[str] = K.CONVERSION_EVENTS,
    payment_event: str = K.PAYMENT_EVENT,
) -> DataFrame:
    """M5 ``fct_ab_tests``: assignment grain with conversion and revenue, 0 when no events.

    The conversion side is aggregated to one row per user first; its hash partitioning on
    ``user_id`` is reused by the join. The conversion is not required to follow
    ``assigned_ts`` (same meaning as the SQL model).
    """
    return ab_tests_of(assignments, user_conversion(events, conversion_events, payment_event))


def ab_tests_of(assignments: DataFrame, conversion: DataFrame) -> DataFrame:
    """M5 from one row per user with ``converted`` and ``revenue``."""
    joined = assignments.join(conversion, "user_id", "left")
    return joined.select(
        "experiment_id",
        "user_id",
        "variant",
        F.coalesce(F.col("converted"), F.lit(0)).alias("converted"),
        F.coalesce(F.col("revenue"), F.lit(0).cast(conversion.schema["revenue"].dataType)).alias("revenue"),
        "assigned_ts",
    )


def fct_feature_engagement(
    events: DataFrame, feature_prefix: str = K.FEATURE_PREFIX, feature_match: str = "prefix"
) -> DataFrame:
    """M6 ``fct_feature_engagement``: feature event counts per user and week."""
    return (
        events.filter(feature_predicate(feature_prefix, feature_match))
        .groupBy(
            "user_id",
            week_start("event_ts").alias("week_start"),
            F.col("event_name").alias("feature_event"),
        )
        .agg(F.count(F.lit(1)).alias("usage_count"))
    )

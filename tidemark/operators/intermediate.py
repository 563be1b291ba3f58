"""Intermediate models (M1, M2): one row per user."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.time import as_of_literal, whole_days_between
from tidemark.operators.predicates import feature_predicate


def reference_time(events: DataFrame, as_of: str | datetime | None) -> Column:
    """The as-of instant, or the latest event time when ``as_of`` is None (scalar subquery)."""
    if as_of is None:
        return events.select(F.max("event_ts")).scalar()
    return as_of_literal(as_of)


def user_activity(
    events: DataFrame,
    as_of: str | datetime | None = K.DEFAULT_AS_OF,
    session_event: str = K.SESSION_EVENT,
    feature_prefix: str = K.FEATURE_PREFIX,
    payment_event: str = K.PAYMENT_EVENT,
    churn_event: str = K.CHURN_EVENT,
    feature_match: str = "prefix",
) -> DataFrame:
    """M1 ``int_user_activity``: counts, first/last activity, revenue, churn flag, inactivity days.

    One hash aggregation keyed by ``user_id`` (partial aggregation before the shuffle, so a
    user holding a third of all events still ships one row per map task).
    ``days_since_active`` is NOT clipped and may be negative when events follow ``as_of``.
    """
    name = F.col("event_name")
    base = events.groupBy("user_id").agg(
        F.count_if(name == session_event).alias("session_count"),
        F.count_if(feature_predicate(feature_prefix, feature_match)).alias("feature_events"),
        F.min("event_ts").alias("first_event_ts"),
        F.max("event_ts").alias("last_event_ts"),
        F.sum(F.when(name == payment_event, F.col("revenue")).otherwise(F.lit(0))).alias("revenue_total"),
        F.max(F.when(name == churn_event, 1).otherwise(0)).alias("churned_flag"),
    )
    return base.select(
        "user_id",
        "session_count",
        "feature_events",
        "first_event_ts",
        "last_event_ts",
        "revenue_total",
        "churned_flag",
        whole_days_between(reference_time(events, as_of), F.col("last_event_ts")).alias("days_since_active"),
    )


def step_column(step: str) -> str:
    return f"{step}_ts"


def user_funnel_steps(events: DataFrame, steps: Sequence[str] = K.DEFAULT_FUNNEL_STEPS) -> DataFrame:
    """M2 ``int_user_funnel_steps``: first time of each step per user (NULL when never done).

    Every user with any event gets a row; the step columns are conditional minima in one
    aggregation, so the table is built in a single pass over ``user_id, event_name, event_ts``.
    """
    name = F.col("event_name")
    return events.groupBy("user_id").agg(
        *[F.min(F.when(name == s, F.col("event_ts"))).alias(step_column(s)) for s in steps]
    )

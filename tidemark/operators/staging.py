"""Staging views (P1-P3): project, cast and default the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import utc_column
from tidemark.sources.schemas import REVENUE_TYPE


def stage_events(raw_events: DataFrame, strict: bool = True) -> DataFrame:
    """Typed events with ``event_date`` and NULL revenue replaced by 0."""
    ts = utc_column(raw_events, "event_ts", strict)
    return raw_events.select(
        "event_id",
        "user_id",
        "event_name",
        ts.alias("event_ts"),
        ts.cast("date").alias("event_date"),
        "session_id",
        "experiment_id",
        "variant",
        F.coalesce(F.col("revenue"), F.lit(0)).cast(REVENUE_TYPE).alias("revenue"),
        "properties",
    )


def stage_users(raw_users: DataFrame, strict: bool = True) -> DataFrame:
    """Typed users with ``signup_date``."""
    ts = utc_column(raw_users, "signup_ts", strict)
    return raw_users.select(
        "user_id",
        ts.alias("signup_ts"),
        ts.cast("date").alias("signup_date"),
        "plan",
        "channel",
        "country",
    )


def stage_assignments(raw_assignments: DataFrame, strict: bool = True) -> DataFrame:
    """Typed experiment assignments."""
    return raw_assignments.select(
        "experiment_id",
        "user_id",
        "variant",
        utc_column(raw_assignments, "assigned_ts", strict).alias("assigned_ts"),
    )

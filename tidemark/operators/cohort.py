"""Cohort retention analytics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.time import period_start, periods_between, utc_column

RETENTION_COLUMNS = ("cohort_period", "period_number", "retained", "users", "retention_rate")


def session_filter(session_event: str | Sequence[str] | None) -> Column:
    """One session event name, a list of names, or ``None`` for every event."""
    if session_event is None:
        return F.lit(True)
    if isinstance(session_event, str):
        return F.col("event_name") == session_event
    return F.col("event_name").isin(*session_event)


def _valid_users(users: DataFrame, period: str) -> DataFrame:
    ts = utc_column(users, "signup_ts", strict=False)
    return (
        users.select("user_id", ts.alias("signup_ts"))
        .dropna(subset=["user_id", "signup_ts"])
        .select("user_id", period_start("signup_ts", period).alias("cohort_period"))
    )


def cohort_sizes(users: DataFrame, period: str = "weekly") -> DataFrame:
    """Distinct valid users per signup cohort, active or not."""
    return (
        _valid_users(users, period)
        .groupBy("cohort_period")
        .agg(F.countDistinct("user_id").alias("users"))
    )


def retention(
    events: DataFrame,
    users: DataFrame,
    period: str = "weekly",
    session_event: str | Sequence[str] | None = K.SESSION_EVENT,
    sort: bool = True,
) -> DataFrame:
    """Retained users and retention rate per cohort and period since signup.

    ``period`` is ``"weekly"`` (Monday weeks) or ``"monthly"``. Timestamps are parsed
    leniently: unparseable values become NULL and those rows are dropped. Sessions are
    reduced to distinct (user, active period) pairs before the join with users.
    ``sort=False`` skips the final ordering (O1) for consumers that re-aggregate.
    """
    valid_users = _valid_users(users, period)
    ts = utc_column(events, "event_ts", strict=False)
    sessions = (
        events.filter(session_filter(session_event))
        .select("user_id", ts.alias("event_ts"))
        .dropna(subset=["user_id", "event_ts"])
        .select("user_id", period_start("event_ts", period).alias("active_period"))
        .distinct()
    )
    retained = (
        sessions.join(valid_users, "user_id")
        .select(
            "cohort_period",
            periods_between("active_period", "cohort_period", period).alias("period_number"),
            "user_id",
        )
        .filter(F.col("period_number") >= 0)
        .groupBy("cohort_period", "period_number")
        .agg(F.countDistinct("user_id").alias("retained"))
    )
    sizes = valid_users.groupBy("cohort_period").agg(F.countDistinct("user_id").alias("users"))
    result = retained.join(sizes, "cohort_period", "left").select(
        "cohort_period",
        "period_number",
        "retained",
        "users",
        (F.col("retained") / F.col("users")).alias("retention_rate"),
    )
    return result.orderBy("cohort_period", "period_number") if sort else result


def period_numbers(retention_table: DataFrame) -> list[int]:
    """The period numbers present in a (stored) retention table: at most one per week or month of the data."""
    return [r["period_number"] for r in retention_table.select("period_number").distinct().orderBy("period_number").collect()]


def heatmap(retention_table: DataFrame, periods: Sequence[int]) -> DataFrame:
    """Cohort x period matrix of mean retention rate, missing cells 0.0.

    The cohort label is text; ``periods`` names the columns (:func:`period_numbers` of a stored table gives all of them).
    The input is the aggregated retention table (cohorts x periods), never event rows, and building the matrix runs no job.
    """
    base = retention_table.select(
        F.col("cohort_period").cast("string").alias("cohort_period"), "period_number", "retention_rate"
    )
    pivoted = base.groupBy("cohort_period").pivot("period_number", list(periods)).agg(F.avg("retention_rate"))
    return pivoted.fillna(0.0, subset=[str(p) for p in periods]).orderBy("cohort_period")

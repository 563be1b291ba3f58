"""Mergeable exact distinct counts (A7, A8, N4): cohort retention from bitmaps of dense user numbers.

Users are numbered without gaps in order of signup (:func:`tidemark.operators.position.global_position`), so a set of users
is a few bitmaps of 32,768 bits, and a cohort, being a stretch of signups, touches few of them. A day's active users are
stored once; any longer period is the OR of its days and is counted exactly, however often a user was active, without
another look at events or user ids. Retained users are the AND of a period's bitmap with a cohort's.

A stored day is at most one bitmap (4 KB) per 32,768 users. New users get the next free numbers; numbers never change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.time import period_start, periods_between, utc_column
from tidemark.operators.cohort import session_filter
from tidemark.operators.position import global_position


def number_users(users: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(user_id, signup_ts, number) of the valid users; ``known`` keeps the numbers it has and others follow."""
    ts = utc_column(users, "signup_ts", strict=False)
    valid = users.select("user_id", ts.alias("signup_ts")).dropna().groupBy("user_id").agg(F.min("signup_ts").alias("signup_ts"))
    if known is None:
        return global_position(valid, ["signup_ts", "user_id"], "number")
    taken = known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    new = global_position(valid.join(known, "user_id", "left_anti"), ["signup_ts", "user_id"], "number")
    return known.unionByName(new.withColumn("number", F.col("number") + F.lit(taken)))


def _bitmaps(numbered: DataFrame, *keys: str) -> DataFrame:
    """One bitmap of ``number`` per key and block of numbers."""
    return numbered.groupBy(*keys, F.bitmap_bucket_number("number").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users")
    )


def daily_bitmaps(
    events: DataFrame, numbers: DataFrame, session_event: str | Sequence[str] | None = K.SESSION_EVENT
) -> DataFrame:
    """(event_date, block, users): who was active on a day. Events are reduced to distinct users and days before the join."""
    ts = utc_column(events, "event_ts", strict=False)
    active = (
        events.filter(session_filter(session_event))
        .select("user_id", ts.cast("date").alias("event_date"))
        .dropna()
        .distinct()
    )
    return _bitmaps(active.join(numbers.select("user_id", "number"), "user_id"), "event_date")


def cohort_bitmaps(numbers: DataFrame, period: str) -> DataFrame:
    """(cohort_period, block, members)."""
    cohorts = numbers.select("number", period_start("signup_ts", period).alias("cohort_period"))
    return _bitmaps(cohorts, "cohort_period").withColumnRenamed("users", "members")


def retention_of(days: DataFrame, cohorts: DataFrame, period: str) -> DataFrame:
    """N4 from stored bitmaps: the columns of :func:`tidemark.operators.cohort.retention`."""
    active = days.groupBy(period_start("event_date", period).alias("active_period"), "block").agg(
        F.bitmap_or_agg("users").alias("users")
    )
    both = active.join(cohorts, "block").filter(F.col("active_period") >= F.col("cohort_period"))
    sides = F.explode(F.array("users", "members")).alias("side")
    met = both.select("cohort_period", "active_period", "block", sides)
    cells = met.groupBy("cohort_period", "active_period", "block").agg(F.bitmap_and_agg("side").alias("kept"))
    retained = (
        cells.groupBy("cohort_period", periods_between("active_period", "cohort_period", period).alias("period_number"))
        .agg(F.sum(F.bitmap_count("kept")).alias("retained"))
        .filter(F.col("retained") > 0)
    )
    sizes = cohorts.groupBy("cohort_period").agg(F.sum(F.bitmap_count("members")).alias("users"))
    rate = (F.col("retained") / F.col("users")).alias("retention_rate")
    return retained.join(sizes, "cohort_period").select("cohort_period", "period_number", "retained", "users", rate)

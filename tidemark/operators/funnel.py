"""Funnel analytics.

The funnel is unordered, as in the product: a user counts for a step whether or not they
did the earlier steps. Counting is one aggregation over the step events; the step-to-step
carry (conversion and drop-off against the previous step) is a ``lag`` over the step
relation, which has one row per requested step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import constants as K


def resolve_steps(steps: Sequence[str] | None) -> list[str]:
    """``None`` or an empty list means the default five activation steps."""
    return list(steps) if steps else list(K.DEFAULT_FUNNEL_STEPS)


def _step_relation(events: DataFrame, steps: list[str]) -> DataFrame:
    """The requested steps as a relation (step_index, step), built JVM-side from literals."""
    rows = F.array(
        *[F.struct(F.lit(i).alias("step_index"), F.lit(s).alias("step")) for i, s in enumerate(steps)]
    )
    return events.sparkSession.range(1).select(F.inline(rows))


def funnel_with_index(events: DataFrame, steps: Sequence[str] | None = None) -> DataFrame:
    """N1 with the step position kept: step_index, step, users, conversion and drop-off.

    A step no user did counts 0; the step after a 0 (and the first step) gets conversion
    1.0 and drop-off 0.0 (F14).
    """
    steps = resolve_steps(steps)
    # Distinct users per step: planned as a partial aggregate on (event_name, user_id) and
    # a final count per step, so no single task sees every user of a popular step.
    counts = (
        events.filter(F.col("event_name").isin(*steps))
        .groupBy(F.col("event_name").alias("step"))
        .agg(F.countDistinct("user_id").alias("users"))
    )
    # `counts` has at most len(steps) rows: a broadcast bounded by the argument, not the data.
    # No events at all gives an empty funnel (uncorrelated EXISTS, no extra join).
    stepped = (
        _step_relation(events, steps)
        .filter(events.select("event_name").exists())
        .join(F.broadcast(counts), "step", "left")
        .select("step_index", "step", F.coalesce(F.col("users"), F.lit(0).cast("long")).alias("users"))
    )
    with_prev = stepped.withColumn("_prev", F.lag("users").over(Window.orderBy("step_index")))
    prev = F.col("_prev")
    no_previous = prev.isNull() | (prev == 0)
    conversion = F.when(no_previous, F.lit(1.0)).otherwise(F.col("users") / prev)
    dropoff = F.when(no_previous, F.lit(0.0)).otherwise(F.lit(1.0) - conversion)
    return with_prev.select(
        "step_index",
        "step",
        "users",
        conversion.alias("conversion_from_previous"),
        dropoff.alias("dropoff_from_previous"),
    )


def funnel(events: DataFrame, steps: Sequence[str] | None = None) -> DataFrame:
    """Step, users, conversion_from_previous, dropoff_from_previous, in step order."""
    return (
        funnel_with_index(events, steps)
        .orderBy("step_index")
        .select("step", "users", "conversion_from_previous", "dropoff_from_previous")
    )


def biggest_dropoff(events: DataFrame, steps: Sequence[str] | None = None) -> DataFrame:
    """The step (first step excluded) with the largest drop-off; ties go to the earlier step.

    Empty when the funnel has fewer than two steps or no events.
    """
    return (
        funnel_with_index(events, steps)
        .filter(F.col("step_index") > 0)
        .orderBy(F.desc("dropoff_from_previous"), F.asc("step_index"))
        .limit(1)
        .select(
            "step",
            F.col("dropoff_from_previous").alias("dropoff"),
            F.col("conversion_from_previous").alias("conversion"),
        )
    )

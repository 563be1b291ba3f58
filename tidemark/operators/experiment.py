"""Experiment evaluation.

Every statistic is computed from per-arm sufficient statistics (n, conversions, revenue mean,
variance and count) produced by ONE aggregation over the assignment-grain table; Spark's
partial aggregation means no arm or experiment is ever gathered into one task. What follows
the aggregation touches one row per experiment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import constants as K
from tidemark.functions.stats import normal_quantile, normal_two_sided_p, with_student_t_two_sided_p


class EmptyArmError(ValueError):
    """Raised in strict mode when an experiment has no control or no treatment rows."""


def conversion_flags(
    assignments: DataFrame, events: DataFrame, conversion_events: Sequence[str] = K.CONVERSION_EVENTS
) -> DataFrame:
    """Assignments with ``converted`` = 1 when the user has any conversion event.

    Set membership as a left join on the distinct converted users (not a driver-side set).
    """
    converted_users = (
        events.filter(F.col("event_name").isin(*conversion_events))
        .select("user_id")
        .distinct()
        .withColumn("_hit", F.lit(1))
    )
    return assignments.join(converted_users, "user_id", "left").select(
        *assignments.columns, F.col("_hit").isNotNull().cast("int").alias("converted")
    )


def arm_statistics(
    outcomes: DataFrame,
    by: Sequence[str] = ("experiment_id",),
    control: str = K.CONTROL,
    treatment: str = K.TREATMENT,
    revenue_col: str | None = "revenue",
) -> DataFrame:
    """Sufficient statistics per experiment and arm, in one aggregation."""
    variant = F.col("variant")
    is_c, is_t = variant == control, variant == treatment
    aggs = [
        F.count_if(is_c).alias("n_control"),
        F.count_if(is_t).alias("n_treatment"),
        F.coalesce(F.sum(F.when(is_c, F.col("converted"))), F.lit(0)).cast("long").alias("control_converted"),
        F.coalesce(F.sum(F.when(is_t, F.col("converted"))), F.lit(0)).cast("long").alias("treatment_converted"),
    ]
    if revenue_col is not None:
        rev = F.col(revenue_col).cast("double")
        rev = F.when(~F.isnan(rev), rev)  # NaN omitted, like NULL
        # A decimal revenue is averaged as an exact decimal sum (no rounding drift over
        # billions of rows); the variance uses Spark's numerically stable moment aggregate.
        exact = isinstance(outcomes.schema[revenue_col].dataType, T.DecimalType)
        mean_src = F.col(revenue_col) if exact else rev
        for arm, cond in (("control", is_c), ("treatment", is_t)):
            arm_rev = F.when(cond, rev)
            aggs += [
                F.count(arm_rev).alias(f"{arm}_revenue_n"),
                F.avg(F.when(cond, mean_src)).cast("double").alias(f"{arm}_revenue_mean"),
                F.var_samp(arm_rev).alias(f"{arm}_revenue_var"),
            ]
    grouped = outcomes.groupBy(*by) if by else outcomes.groupBy()
    return grouped.agg(*aggs)


def _div(a: Column, b: Column) -> Column:
    # ANSI division by zero raises; degenerate statistics become NULL instead.
    return F.try_divide(a.cast("double"), b.cast("double"))


def evaluate_experiments(
    outcomes: DataFrame,
    alpha: float = K.DEFAULT_ALPHA,
    pooled: bool = False,
    control: str = K.CONTROL,
    treatment: str = K.TREATMENT,
    revenue_col: str | None = "revenue",
    strict: bool = False,
) -> DataFrame:
    """One result row per experiment (``pooled=True``: one row for all experiments).

    ``outcomes`` has ``experiment_id, variant, converted`` and optionally revenue (the
    ``fct_ab_tests`` mart or :func:`conversion_flags`). Two-proportion z-test with pooled
    variance, the uplift interval on the pooled standard error, the minimum detectable effect
    at 80 % power with the factor 2, and a Welch t-test on revenue when a revenue column is given.
    """
    by = () if pooled else ("experiment_id",)
    stats = arm_statistics(outcomes, by, control, treatment, revenue_col)
    if strict:
        empty = stats.filter((F.col("n_control") == 0) | (F.col("n_treatment") == 0)).limit(1).collect()
        if empty:
            raise EmptyArmError("Control and treatment arrays must be non-empty.")
    return evaluate_statistics(stats, alpha, pooled, revenue_col)


def evaluate_statistics(
    stats: DataFrame,
    alpha: float = K.DEFAULT_ALPHA,
    pooled: bool = False,
    revenue_col: str | None = "revenue",
    carry: Sequence[str] = (),
) -> DataFrame:
    """X1-X9 from sufficient statistics already taken (:func:`arm_statistics`); ``carry`` names further columns to keep."""
    # All statistics are column expressions over the one-row-per-experiment aggregate;
    # shared subexpressions are evaluated once by Catalyst.
    z_crit = F.lit(normal_quantile(1 - alpha / 2))
    z_power = F.lit(normal_quantile(K.POWER))
    n_c, n_t = F.col("n_control"), F.col("n_treatment")
    c_conv, t_conv = F.col("control_converted"), F.col("treatment_converted")
    c_rate, t_rate = _div(c_conv, n_c), _div(t_conv, n_t)
    pooled_rate = _div(c_conv + t_conv, n_c + n_t)
    inv_n = _div(F.lit(1.0), n_c) + _div(F.lit(1.0), n_t)
    pq = pooled_rate * (F.lit(1.0) - pooled_rate)
    se = F.sqrt(pq * inv_n)
    uplift = t_rate - c_rate
    exp_id = F.lit("all").alias("experiment_id") if pooled else F.col("experiment_id")
    cols = [
        exp_id,
        n_c,
        n_t,
        c_conv,
        t_conv,
        c_rate.alias("control_rate"),
        t_rate.alias("treatment_rate"),
        uplift.alias("uplift"),
        F.when(se > 0, (c_rate - t_rate) / se).alias("z_stat"),
        (uplift - z_crit * se).alias("ci_low"),
        (uplift + z_crit * se).alias("ci_high"),
        ((z_crit + z_power) * F.sqrt(F.lit(2.0) * pq * inv_n)).alias("mde"),
    ]
    cols += list(carry)
    if revenue_col is not None:
        cols += _welch_columns()
    tested = stats.select(*cols).withColumn("p_value", normal_two_sided_p("z_stat"))
    if revenue_col is not None:
        tested = with_student_t_two_sided_p(tested, "revenue_t_stat", "revenue_df", "revenue_p_value")
    significant = F.coalesce(F.col("p_value") < F.lit(alpha), F.lit(False))
    recommendation = (
        F.when(significant & (F.col("uplift") > 0), F.lit(K.RECOMMEND_SHIP))
        .when(significant & (F.col("uplift") < 0), F.lit(K.RECOMMEND_STOP))
        .otherwise(F.lit(K.RECOMMEND_CONTINUE))
    )
    out_cols = [
        "experiment_id",
        "n_control",
        "n_treatment",
        "control_converted",
        "treatment_converted",
        "control_rate",
        "treatment_rate",
        "uplift",
        "z_stat",
        "p_value",
        significant.alias("significant"),
        "ci_low",
        "ci_high",
        F.struct(F.col("ci_low").alias("low"), F.col("ci_high").alias("high")).alias("confidence_interval"),
        "mde",
        recommendation.alias("recommendation"),
    ]
    if revenue_col is not None:
        out_cols += ["revenue_t_stat", "revenue_df", "revenue_p_value"]
    return tested.select(*out_cols, *carry)


def flat_results(results: DataFrame) -> DataFrame:
    """X9 as a stored table: every column, the interval struct as two columns."""
    return results.select(
        *[c for c in results.columns if c != "confidence_interval"],
        F.col("confidence_interval.low").alias("interval_low"),
        F.col("confidence_interval.high").alias("interval_high"),
    )


def _welch_columns() -> list[Column]:
    """Welch's unequal-variance t statistic and degrees of freedom (control vs treatment)."""
    n1, n2 = F.col("control_revenue_n").cast("double"), F.col("treatment_revenue_n").cast("double")
    q1 = _div(F.col("control_revenue_var"), n1)
    q2 = _div(F.col("treatment_revenue_var"), n2)
    se2 = q1 + q2
    t = F.when(se2 > 0, (F.col("control_revenue_mean") - F.col("treatment_revenue_mean")) / F.sqrt(se2))
    dof = F.when(
        se2 > 0,
        se2 * se2 / (_div(q1 * q1, n1 - F.lit(1.0)) + _div(q2 * q2, n2 - F.lit(1.0))),
    )
    return [t.alias("revenue_t_stat"), dof.alias("revenue_df")]


def variant_comparison(outcomes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """X11: conversion rate per variant (pooled over experiments unless ``by`` is given)."""
    return outcomes.groupBy(*by, "variant").agg(F.avg(F.col("converted").cast("double")).alias("conversion_rate"))

"""Data-quality checks and reconciliation (Q1-Q10).

Checks return relations, never booleans computed on the driver: one row per check with the
number of failing rows/keys. Column-level checks of one table (not_null, accepted_values)
are fused into a single aggregation so each table is scanned once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K

CHECK_COLUMNS = ("model", "column_name", "test", "failures")


class GateFailed(RuntimeError):
    """A failed check blocks publication."""


def column_checks(
    df: DataFrame,
    model: str,
    not_null: Sequence[str] = (),
    accepted_values: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Q1 + Q3 in one scan: NULL counts, and non-NULL values outside the accepted set."""
    accepted_values = dict(accepted_values or {})
    specs = [(c, "not_null", F.count_if(F.col(c).isNull())) for c in not_null]
    specs += [
        (c, "accepted_values", F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*values)))
        for c, values in accepted_values.items()
    ]
    if not specs:
        raise ValueError("no checks given")
    wide = df.agg(*[agg.alias(f"_c{i}") for i, (_, _, agg) in enumerate(specs)])
    rows = F.array(
        *[
            F.struct(
                F.lit(model).alias("model"),
                F.lit(c).alias("column_name"),
                F.lit(test).alias("test"),
                F.col(f"_c{i}").cast("long").alias("failures"),
            )
            for i, (c, test, _) in enumerate(specs)
        ]
    )
    return wide.select(F.inline(rows))


def unique_check(df: DataFrame, model: str, column: str) -> DataFrame:
    """Q2: number of non-NULL key values that occur more than once."""
    dupes = (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )
    return dupes.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit("unique").alias("test"), "failures"
    )


def relationship_check(
    child: DataFrame, model: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (left anti join).

    Child keys are pre-aggregated to (key, rows) first: partial aggregation collapses a hot
    key map-side, so the anti join shuffles one row per distinct key, never the raw rows.
    """
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    child_keys = (
        child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
    )
    orphans = child_keys.join(keys, column, "left_anti")
    return orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("failures")).select(
        F.lit(model).alias("model"),
        F.lit(column).alias("column_name"),
        F.lit("relationships").alias("test"),
        "failures",
    )


def duplicate_grain(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q5-Q7/A10 (and S7): offending key combinations with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("records")).filter(F.col("records") > 1)


def duplicate_grain_report(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Q5-Q7 as one relation: check, key (text, ``|``-joined), records."""
    parts = [
        duplicate_grain(df, keys).select(
            F.lit(name).alias("check"),
            F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key"),
            "records",
        )
        for name, (df, keys) in tables.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(model, row_count) for each table, as one relation (one job, all scans)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("model"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def non_empty(marts: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each mart with ``passed`` = at least one row."""
    return row_counts(marts).withColumn("passed", F.col("row_count") > 0)


RECONCILIATION_TABLES = (
    "raw_events",
    "stg_raw_events",
    "dim_users",
    "stg_dim_users",
    "ab_test_assignments",
    "fct_ab_tests",
    "fct_funnel",
    "fct_cohort_retention",
    "fct_feature_engagement",
)


def reconciliation(tables: Mapping[str, DataFrame], funnel_stages: int = 5) -> DataFrame:
    """Q9: source-to-mart count checks as (check, comparison, expected, actual, passed).

    ``tables`` holds the nine models of :data:`RECONCILIATION_TABLES`.
    """
    missing = [t for t in RECONCILIATION_TABLES if t not in tables]
    if missing:
        raise ValueError(f"reconciliation needs tables: {missing}")
    return reconciliation_of(row_counts({t: tables[t] for t in RECONCILIATION_TABLES}), funnel_stages)


def reconciliation_of(counts: DataFrame, funnel_stages: int = 5) -> DataFrame:
    """Q9 from counts already taken (:func:`row_counts`). The funnel must have ``funnel_stages`` rows per user."""
    wide = counts.groupBy().pivot("model", list(RECONCILIATION_TABLES)).agg(F.first("row_count"))

    def check(name: str, comparison: str, expected, actual):
        passed = (actual == expected) if comparison == "equals" else (actual >= expected)
        return F.struct(
            F.lit(name).alias("check"),
            F.lit(comparison).alias("comparison"),
            expected.cast("long").alias("expected"),
            actual.cast("long").alias("actual"),
            passed.alias("passed"),
        )

    c = F.col
    rows = F.array(
        check(K.CHECK_EVENTS, "equals", c("raw_events"), c("stg_raw_events")),
        check(K.CHECK_USERS, "equals", c("dim_users"), c("stg_dim_users")),
        check(K.CHECK_ASSIGNMENTS, "equals", c("ab_test_assignments"), c("fct_ab_tests")),
        check(K.CHECK_FUNNEL, "equals", c("dim_users") * F.lit(funnel_stages), c("fct_funnel")),
        check(K.CHECK_COHORT, "at_least", F.lit(1), c("fct_cohort_retention")),
        check(K.CHECK_ENGAGEMENT, "at_least", F.lit(1), c("fct_feature_engagement")),
    )
    return wide.select(F.inline(rows))


def gate(checks: DataFrame, passed_col: str = "passed", name_col: str = "check") -> None:
    """Q10: raise :class:`GateFailed` naming every failed check (collects failures only)."""
    failed = [r[name_col] for r in checks.filter(~F.col(passed_col)).select(name_col).collect()]
    if failed:
        raise GateFailed(f"{K.GATE_FAILED}: {', '.join(failed)}")


def product_data_tests(
    stg_events: DataFrame,
    stg_users: DataFrame,
    stg_assignments: DataFrame,
    fct_funnel: DataFrame,
    fct_cohort_retention: DataFrame,
    fct_ab_tests: DataFrame,
    fct_feature_engagement: DataFrame,
    funnel_steps: Sequence[str] | None = None,
) -> DataFrame:
    """The product's 25 generic data tests (15 not_null, 2 unique, 6 accepted_values,
    2 relationships) as one relation of (model, column_name, test, failures)."""
    steps = list(funnel_steps) if funnel_steps else list(K.DEFAULT_FUNNEL_STEPS)
    parts = [
        column_checks(
            stg_events, "stg_raw_events", not_null=["event_id", "user_id", "event_name"],
            accepted_values={"event_name": K.EVENT_NAMES},
        ),
        unique_check(stg_events, "stg_raw_events", "event_id"),
        relationship_check(stg_events, "stg_raw_events", "user_id", stg_users, "user_id"),
        column_checks(
            stg_users, "stg_dim_users", not_null=["user_id"],
            accepted_values={"plan": K.PLANS, "channel": K.CHANNELS},
        ),
        unique_check(stg_users, "stg_dim_users", "user_id"),
        column_checks(
            stg_assignments, "stg_ab_test_assignments", not_null=["user_id"],
            accepted_values={"variant": K.VARIANTS},
        ),
        relationship_check(stg_assignments, "stg_ab_test_assignments", "user_id", stg_users, "user_id"),
        column_checks(fct_funnel, "fct_funnel", not_null=["user_id"], accepted_values={"stage": steps}),
        column_checks(
            fct_cohort_retention, "fct_cohort_retention", not_null=["cohort_week", "period_number", "retained_users"]
        ),
        column_checks(
            fct_ab_tests, "fct_ab_tests", not_null=["experiment_id", "user_id"], accepted_values={"variant": K.VARIANTS}
        ),
        column_checks(
            fct_feature_engagement, "fct_feature_engagement",
            not_null=["user_id", "week_start", "feature_event", "usage_count"],
        ),
    ]
    return reduce(DataFrame.unionAll, parts)


def singular_tests(stg_events: DataFrame, fct_ab_tests: DataFrame, fct_funnel: DataFrame) -> DataFrame:
    """Q5-Q7: the three duplicate-grain tests as one relation of offending keys."""
    return duplicate_grain_report(
        {
            "no_duplicate_event_ids": (stg_events, ["event_id"]),
            "no_duplicate_assignment_grain": (fct_ab_tests, ["experiment_id", "user_id"]),
            "no_duplicate_funnel_grain": (fct_funnel, ["user_id", "stage"]),
        }
    )

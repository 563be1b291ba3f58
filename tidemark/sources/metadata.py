"""Model metadata published with the data (S14): layer, grain, owner, consumers, and column descriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OWNER = "product-analytics"
DASHBOARD, REPORT = "product_metrics_dashboard", "daily_metrics_report"

# model, layer, materialization, grain, what it holds, consumers
MODELS = (
    ("stg_raw_events", "staging", "view", "event_id", "Events with UTC times, dates and a revenue that is never missing", ""),
    ("stg_dim_users", "staging", "view", "user_id", "Users with their signup time and date", ""),
    ("stg_ab_test_assignments", "staging", "view", "experiment_id, user_id", "Which arm a user was put in, and when", ""),
    ("int_user_activity", "intermediate", "view", "user_id", "Counts, revenue, first and last activity of a user", ""),
    ("int_user_funnel_steps", "intermediate", "view", "user_id", "When a user first did each activation step", ""),
    ("fct_funnel", "marts", "table", "user_id, stage", "Whether and when a user reached a stage", f"{DASHBOARD}, {REPORT}"),
    ("fct_cohort_retention", "marts", "table", "cohort_week, period_number", "How many of a signup week came back k weeks later", DASHBOARD),
    ("fct_ab_tests", "marts", "table", "experiment_id, user_id", "Conversion and revenue of every assigned user", REPORT),
    ("fct_feature_engagement", "marts", "table", "user_id, week_start, feature_event", "How often a user used a feature in a week", DASHBOARD),
)

COLUMNS = {
    "user_id": "user the row is about",
    "stage": "activation step",
    "converted_at": "first time of the step; missing if never done",
    "dropped": "true if the step was never done",
    "cohort_week": "Monday of the signup week",
    "period_number": "whole weeks since the signup week",
    "retained_users": "distinct users with a session in that week",
    "experiment_id": "experiment",
    "variant": "arm",
    "converted": "1 if the user converted",
    "revenue": "payments of the user",
    "week_start": "Monday of the week",
    "feature_event": "feature used",
    "usage_count": "uses in the week",
    "days_since_active": "whole days from last activity to the reference time",
}

METADATA_SCHEMA = "model string, layer string, materialized string, grain string, owner string, description string, consumers string"


def model_metadata(spark: SparkSession) -> DataFrame:
    """The model catalogue as a table (a fixed description, not data)."""
    rows = [(name, layer, kind, grain, OWNER, text, users) for name, layer, kind, grain, text, users in MODELS]
    return spark.createDataFrame(rows, METADATA_SCHEMA)


def described(df: DataFrame, model: str) -> DataFrame:
    """``df`` with its known columns' descriptions as column metadata (stored in Parquet and shown by the catalog)."""
    return df.select(
        *[
            F.col(f"`{c}`").alias(c, metadata={"comment": COLUMNS[c], "model": model}) if c in COLUMNS else F.col(f"`{c}`")
            for c in df.columns
        ]
    )

"""Typed raw-table definitions (S4) and table contracts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

REVENUE_TYPE = T.DecimalType(20, 6)

RAW_EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType(), nullable=False),
        T.StructField("user_id", T.StringType(), nullable=False),
        T.StructField("event_name", T.StringType(), nullable=False),
        T.StructField("event_ts", T.TimestampNTZType(), nullable=False),
        T.StructField("session_id", T.StringType()),
        T.StructField("experiment_id", T.StringType()),
        T.StructField("variant", T.StringType()),
        T.StructField("revenue", REVENUE_TYPE),
        T.StructField("properties", T.StringType()),
    ]
)

DIM_USERS_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType(), nullable=False),
        T.StructField("signup_ts", T.TimestampNTZType(), nullable=False),
        T.StructField("plan", T.StringType(), nullable=False),
        T.StructField("channel", T.StringType(), nullable=False),
        T.StructField("country", T.StringType(), nullable=False),
    ]
)

AB_ASSIGNMENTS_SCHEMA = T.StructType(
    [
        T.StructField("experiment_id", T.StringType(), nullable=False),
        T.StructField("user_id", T.StringType(), nullable=False),
        T.StructField("variant", T.StringType(), nullable=False),
        T.StructField("assigned_ts", T.TimestampNTZType(), nullable=False),
    ]
)


@dataclass(frozen=True)
class TableContract:
    """Required columns, key columns and NOT NULL columns of one raw table."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]

    @property
    def required(self) -> frozenset[str]:
        return frozenset(self.schema.fieldNames())

    @property
    def not_null(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.schema.fields if not f.nullable)

    @property
    def text_schema(self) -> T.StructType:
        """Schema used to read CSV text: timestamps stay text until the strict UTC parse."""
        return T.StructType(
            [
                T.StructField(f.name, T.StringType(), f.nullable)
                if isinstance(f.dataType, T.TimestampNTZType)
                else f
                for f in self.schema.fields
            ]
        )


# Load order matters only for reporting; the publish is all-or-nothing.
CONTRACTS: dict[str, TableContract] = {
    "dim_users": TableContract("dim_users", DIM_USERS_SCHEMA, ("user_id",)),
    "raw_events": TableContract("raw_events", RAW_EVENTS_SCHEMA, ("event_id",)),
    "ab_test_assignments": TableContract(
        "ab_test_assignments", AB_ASSIGNMENTS_SCHEMA, ("experiment_id", "user_id")
    ),
}

"""Product tables derived from the driver's TPC-H-like tables.

The driver's data has no users/assignments tables of this product, so these views map its
columns onto the product's raw schema. Two "worlds" are used:

* product events: ``events`` rows become product events; users are customers with their
  first ``signup`` event; assignments split users by id parity.
* order events: ``orders`` rows become events named by order priority; users are customers
  with their first order. The funnel runs over priorities (not every customer has each one).

Three experiments split the users by id: ``parity`` and ``thirds`` have both arms, ``one_arm`` has control users only.

Every view is a lazy DataFrame over the parquet scan, so filters and column pruning reach it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: adapter parameters for the driver's tables ---
CHURN_SINCE = "2024-01-30 00:00:00"
FUNNEL_STEPS = ("signup", "view", "click", "purchase")
SESSION_EVENT = "view"
PAYMENT_EVENT = "purchase"
FEATURE_PREFIX = "cl"
CHURN_EVENT = "churned"
AS_OF = "2024-01-30 12:00:00"  # inside the data: some users were active after it
SIGNUP_EVENT = "signup"
EXPERIMENTS = ("parity", "thirds", "one_arm")
ORDER_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
ORDER_FUNNEL_STEPS = ("5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT")
ORDER_CONVERSION_EVENTS = ("1-URGENT",)
ORDER_PAYMENT_EVENT = "1-URGENT"
PRODUCT_CONVERSION_EVENTS = ("purchase",)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's table ``name``; the files are listed anew at every call."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


def product_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw product events; an ``error`` on the last day is the churn event."""
    e = table(spark, sf_dir, "events")
    name = F.when(
        (F.col("event_type") == "error") & (F.col("ts") >= _ts(CHURN_SINCE)), F.lit(CHURN_EVENT)
    ).otherwise(F.col("event_type"))
    return e.select(
        "event_id",
        "user_id",
        name.alias("event_name"),
        F.col("ts").alias("event_ts"),
        F.lit(None).cast("string").alias("session_id"),
        F.lit(None).cast("string").alias("experiment_id"),
        F.lit(None).cast("string").alias("variant"),
        F.col("value").alias("revenue"),
        F.col("props").alias("properties"),
    )


def _with_geography(spark: SparkSession, sf_dir: str, first: DataFrame) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        customer.join(first, customer["c_custkey"] == first["_uid"])
        .join(nation, customer["c_nationkey"] == nation["n_nationkey"], "left")
        .join(region, nation["n_regionkey"] == region["r_regionkey"], "left")
        .select(
            F.col("c_custkey").alias("user_id"),
            F.col("signup_ts"),
            F.col("c_mktsegment").alias("plan"),
            F.col("r_name").alias("channel"),
            F.col("n_name").alias("country"),
        )
    )


def event_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of the product-events world: customers with their first signup event."""
    first = (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type") == SIGNUP_EVENT)
        .groupBy(F.col("user_id").alias("_uid"))
        .agg(F.min("ts").alias("signup_ts"))
    )
    return _with_geography(spark, sf_dir, first)


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw order events: one event per order, named by order priority."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("event_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("event_name"),
        F.col("o_orderdate").alias("event_ts"),
        F.lit(None).cast("string").alias("session_id"),
        F.lit(None).cast("string").alias("experiment_id"),
        F.lit(None).cast("string").alias("variant"),
        F.col("o_totalprice").alias("revenue"),
        F.lit(None).cast("string").alias("properties"),
    )


def order_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of the order world: customers with their first order (customers without orders dropped)."""
    first = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("_uid"))
        .agg(F.min("o_orderdate").alias("signup_ts"))
    )
    return _with_geography(spark, sf_dir, first)


def split_assignments(users: DataFrame) -> DataFrame:
    """The three experiments, assigned at signup: one row per experiment and user, from one scan of the users."""
    parity, thirds, one_arm = EXPERIMENTS
    uid = F.col("user_id")

    def assigned(experiment: str, variant):
        return F.struct(F.lit(experiment).alias("experiment_id"), variant.alias("variant"))

    rows = F.array(
        assigned(parity, F.when(uid % 2 == 0, F.lit("control")).otherwise(F.lit("treatment"))),
        assigned(thirds, F.when(uid % 3 == 0, F.lit("control")).otherwise(F.lit("treatment"))),
        F.when(uid % 5 == 0, assigned(one_arm, F.lit("control"))),
    )
    present = F.filter(rows, lambda r: r.isNotNull())
    return users.select("user_id", F.col("signup_ts").alias("assigned_ts"), F.inline(present)).select(
        "experiment_id", "user_id", "variant", "assigned_ts"
    )

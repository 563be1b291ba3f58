"""Registered queries over the driver's tables (Spark side).

Each query builds the adapter views of :mod:`tidemark.sources.adapter`, runs library
operators on them and returns a lazy DataFrame. Output doubles are rounded to 9 decimal
places (and decimals shown as doubles) so results compare exactly with the SQL oracle in
:mod:`tidemark.plans.oracle`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import fmt
from tidemark.functions.time import lenient_utc, strict_utc
from tidemark.operators import (
    bitmaps,
    churn,
    cohort,
    experiment,
    funnel,
    intermediate,
    marts,
    position,
    quality,
    report,
    staging,
)
from tidemark.plans import incremental
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import adapter as A
from tidemark.sources import bucketed, contracts, io, quarantine
from tidemark.sources.schemas import CONTRACTS, TableContract

QueryFn = Callable[[SparkSession, str], DataFrame]


def edge(df: DataFrame, scale: int = 9, scales: dict[str, int] | None = None) -> DataFrame:
    """Decimals become doubles; doubles are rounded to ``scale`` places (per-column override)."""
    scales = scales or {}
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        if isinstance(f.dataType, (T.DecimalType, T.DoubleType)):
            c = F.round(c, scales.get(f.name, scale))
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ---- the two adapter worlds -------------------------------------------------------------


class _World(dict):
    """A dict of adapter views whose entries are built on first access (lazy, per query)."""

    def __init__(self, builders):
        super().__init__()
        self._builders = builders

    def __missing__(self, key):
        value = self._builders[key](self)
        self[key] = value
        return value


def product_world(spark: SparkSession, d: str) -> _World:
    return _World(
        {
            "raw_events": lambda w: A.product_events(spark, d),
            "events": lambda w: staging.stage_events(w["raw_events"]),
            "raw_users": lambda w: A.event_users(spark, d),
            "users": lambda w: staging.stage_users(w["raw_users"]),
            "raw_assignments": lambda w: A.split_assignments(w["raw_users"]),
            "assignments": lambda w: staging.stage_assignments(w["raw_assignments"]),
        }
    )


def order_world(spark: SparkSession, d: str) -> _World:
    return _World(
        {
            "raw_users": lambda w: A.order_users(spark, d),
            "raw_events": lambda w: A.order_events(spark, d),
            "events": lambda w: staging.stage_events(w["raw_events"]),
            "users": lambda w: staging.stage_users(w["raw_users"]),
            "assignments": lambda w: staging.stage_assignments(A.split_assignments(w["raw_users"])),
        }
    )


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return order_world(spark, d)["events"]


def _fct_ab(spark: SparkSession, d: str) -> DataFrame:
    w = order_world(spark, d)
    return marts.fct_ab_tests(w["assignments"], w["events"], A.ORDER_CONVERSION_EVENTS, A.ORDER_PAYMENT_EVENT)


def _evaluated(spark: SparkSession, d: str, revenue: bool = False) -> DataFrame:
    # the revenue (Welch) test is only built for the query that reports it
    return experiment.evaluate_experiments(_fct_ab(spark, d), revenue_col="revenue" if revenue else None)


def _product_marts(spark: SparkSession, d: str) -> _World:
    w = product_world(spark, d)
    return _World(
        {
            "raw_events": lambda m: w["raw_events"],
            "stg_raw_events": lambda m: w["events"],
            "dim_users": lambda m: w["raw_users"],
            "stg_dim_users": lambda m: w["users"],
            "ab_test_assignments": lambda m: w["raw_assignments"],
            "fct_ab_tests": lambda m: marts.fct_ab_tests(
                w["assignments"], w["events"], A.PRODUCT_CONVERSION_EVENTS, A.PAYMENT_EVENT
            ),
            "fct_funnel": lambda m: marts.fct_funnel(
                intermediate.user_funnel_steps(w["events"], A.FUNNEL_STEPS), A.FUNNEL_STEPS
            ),
            "fct_cohort_retention": lambda m: marts.fct_cohort_retention(w["users"], w["events"], A.SESSION_EVENT),
            "fct_feature_engagement": lambda m: marts.fct_feature_engagement(w["events"], A.FEATURE_PREFIX),
        }
    )


# ---- staging, intermediate, marts -----------------------------------------------------------


def q_stg_events(spark, d):
    return edge(product_world(spark, d)["events"])


def q_stg_users(spark, d):
    return edge(product_world(spark, d)["users"])


def q_stg_assignments(spark, d):
    return edge(product_world(spark, d)["assignments"])


def q_int_user_activity(spark, d):
    ev = product_world(spark, d)["events"]
    return edge(
        intermediate.user_activity(
            ev, A.AS_OF, A.SESSION_EVENT, A.FEATURE_PREFIX, A.PAYMENT_EVENT, A.CHURN_EVENT
        )
    )


def q_int_funnel_steps(spark, d):
    return edge(intermediate.user_funnel_steps(_orders(spark, d), A.ORDER_FUNNEL_STEPS))


def q_fct_funnel(spark, d):
    steps = intermediate.user_funnel_steps(_orders(spark, d), A.ORDER_FUNNEL_STEPS)
    return edge(marts.fct_funnel(steps, A.ORDER_FUNNEL_STEPS))


def q_fct_cohort_weekly(spark, d):
    w = product_world(spark, d)
    return edge(marts.fct_cohort_retention(w["users"], w["events"], A.SESSION_EVENT))


def q_fct_ab_tests(spark, d):
    return edge(_fct_ab(spark, d))


def q_fct_feature_engagement(spark, d):
    return edge(marts.fct_feature_engagement(product_world(spark, d)["events"], A.FEATURE_PREFIX))


LIKE_PREFIX = "c_"


def q_fct_feature_engagement_like(spark, d):
    """The SQL form, where ``_`` in the prefix matches any one character."""
    return edge(marts.fct_feature_engagement(product_world(spark, d)["events"], LIKE_PREFIX, feature_match="like"))


# ---- funnel and retention analytics -------------------------------------------------------------

CUSTOM_STEPS = ("3-MEDIUM", "1-URGENT", "5-LOW")
ZERO_STEPS = ("5-LOW", "4-NOT SPECIFIED", "CANCELLED", "2-HIGH", "1-URGENT")


def q_funnel(spark, d):
    return edge(funnel.funnel(_orders(spark, d), A.ORDER_FUNNEL_STEPS))


def q_funnel_custom_steps(spark, d):
    return edge(funnel.funnel(_orders(spark, d), CUSTOM_STEPS))


def q_funnel_zero_step(spark, d):
    return edge(funnel.funnel(_orders(spark, d), ZERO_STEPS))


def q_biggest_dropoff(spark, d):
    return edge(funnel.biggest_dropoff(_orders(spark, d), A.ORDER_FUNNEL_STEPS))


def q_retention_weekly(spark, d):
    w = product_world(spark, d)
    return edge(cohort.retention(w["events"], w["users"], "weekly", A.SESSION_EVENT))


def q_retention_monthly(spark, d):
    w = order_world(spark, d)
    return edge(cohort.retention(w["events"], w["users"], "monthly", None))


def q_cohort_sizes_monthly(spark, d):
    return edge(cohort.cohort_sizes(order_world(spark, d)["users"], "monthly"))


def q_retention_heatmap(spark, d):
    w = product_world(spark, d)
    # the aggregated table, a row per cohort and week, names its own columns; stored, so that events are read once
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/retention-{uuid.uuid4().hex}"
    cohort.retention(w["events"], w["users"], "weekly", A.SESSION_EVENT, sort=False).write.parquet(path)
    stored = spark.read.parquet(path)
    return edge(cohort.heatmap(stored, cohort.period_numbers(stored)))


def q_behavior_table(spark, d):
    ev = product_world(spark, d)["events"]
    return edge(
        churn.behavior_table(ev, None, A.SESSION_EVENT, A.FEATURE_PREFIX, A.PAYMENT_EVENT, A.CHURN_EVENT)
    )


# ---- experiments ---------------------------------------------------------------------------------


def q_ab_rates(spark, d):
    return edge(
        _evaluated(spark, d).select(
            "experiment_id",
            "n_control",
            "n_treatment",
            "control_converted",
            "treatment_converted",
            "control_rate",
            "treatment_rate",
            "uplift",
        )
    )


def q_ab_ci_mde(spark, d):
    return edge(_evaluated(spark, d).select("experiment_id", "ci_low", "ci_high", "mde"))


def q_ab_pvalue(spark, d):
    return edge(_evaluated(spark, d).select("experiment_id", "z_stat", "p_value"))


def q_ab_decision(spark, d):
    return edge(_evaluated(spark, d).select("experiment_id", "p_value", "significant", "recommendation"))


def q_ab_revenue_welch(spark, d):
    return edge(
        _evaluated(spark, d, revenue=True).select("experiment_id", "revenue_t_stat", "revenue_df", "revenue_p_value"),
        scales={"revenue_df": 6},
    )


def q_ab_results(spark, d):
    """Every column of the per-experiment result, the interval struct flattened; one experiment has an empty arm."""
    return edge(experiment.flat_results(_evaluated(spark, d, revenue=True)), scales={"revenue_df": 6})


def q_ab_variant_comparison(spark, d):
    return edge(experiment.variant_comparison(_fct_ab(spark, d)))


def q_ab_pooled(spark, d):
    w = order_world(spark, d)
    flags = experiment.conversion_flags(w["assignments"], w["events"], A.ORDER_CONVERSION_EVENTS)
    return edge(
        experiment.evaluate_experiments(flags, pooled=True, revenue_col=None).select(
            "experiment_id",
            "control_rate",
            "treatment_rate",
            "uplift",
            "p_value",
            "significant",
            "ci_low",
            "ci_high",
            "mde",
            "recommendation",
        )
    )


# ---- data quality ---------------------------------------------------------------------------------

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
ORDER_STATUSES = ("F", "O", "P")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def _union(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def q_dq_not_null(spark, d):
    t = lambda n: A.table(spark, d, n)
    return _union(
        [
            quality.column_checks(t("events"), "events", not_null=["event_id", "user_id", "event_type", "ts"]),
            quality.column_checks(t("orders"), "orders", not_null=["o_orderkey", "o_custkey", "o_orderdate"]),
            quality.column_checks(t("customer"), "customer", not_null=["c_custkey", "c_mktsegment"]),
        ]
    )


def _customer_orders(spark, d):
    """Every customer with the first order date, missing for customers without orders."""
    first = A.table(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
    customer = A.table(spark, d, "customer").select("c_custkey")
    return customer.join(first, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "first_order")


def q_dq_known_failures(spark, d):
    """Q1, Q4: checks on tables known to break them: customers without a first order, keys declared on wrong parents."""
    t = lambda n: A.table(spark, d, n)
    return _union(
        [
            quality.column_checks(_customer_orders(spark, d), "customer_orders", not_null=["c_custkey", "first_order"]),
            quality.relationship_check(t("customer"), "customer", "c_custkey", t("supplier"), "s_suppkey"),
            quality.relationship_check(t("customer"), "customer", "c_custkey", t("orders"), "o_custkey"),
        ]
    )


def q_contract_violations(spark, d):
    """S7/S8 on whole tables: a key that repeats (order key of lines), a column with NULLs, and a table that holds."""
    field = lambda n, kind, ok: T.StructField(n, kind, nullable=ok)
    lines = TableContract(
        "lineitem", T.StructType([field("l_orderkey", T.LongType(), False), field("l_shipdate", T.DateType(), False)]), ("l_orderkey",)
    )
    firsts = TableContract(
        "customer_orders",
        T.StructType([field("c_custkey", T.LongType(), False), field("first_order", T.TimestampType(), False)]),
        ("c_custkey",),
    )
    events = TableContract(
        "events", T.StructType([field("event_id", T.LongType(), False), field("ts", T.TimestampNTZType(), False)]), ("event_id",)
    )
    return _union(
        [
            contracts.contract_violations(A.table(spark, d, "lineitem"), lines),
            contracts.contract_violations(_customer_orders(spark, d), firsts),
            contracts.contract_violations(A.table(spark, d, "events"), events),
        ]
    )


BAD_TEXT = "no time"


def q_text_parsing(spark, d):
    """Events as CSV text with an offset in their times, every ninth unreadable, read back tolerantly.

    ``strict_ts`` is the strict parse of the readable ones.
    """
    e = A.table(spark, d, "events")
    bad = F.col("event_id") % 9 == 0
    text = F.when(bad, F.lit(BAD_TEXT)).otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+05:30")))
    line = F.to_csv(F.struct(F.col("event_id").cast("string"), text.alias("event_ts"), F.col("event_type")), {"escape": '"'})
    cells = e.select(F.from_csv(line, "event_id string, event_ts string, event_name string", {"escape": '"'}).alias("c")).select("c.*")
    return cells.select(
        F.col("event_id").cast("long").alias("event_id"),
        "event_name",
        lenient_utc(F.col("event_ts")).alias("event_ts"),
        F.when(F.col("event_ts") != BAD_TEXT, strict_utc(F.when(F.col("event_ts") != BAD_TEXT, F.col("event_ts")))).alias("strict_ts"),
    )


def q_display_formats(spark, d):
    """ties and missing figures as text (quantities over powers of two give exact ties)."""
    q = A.table(spark, d, "lineitem").select(F.col("l_quantity").cast("double").alias("quantity")).distinct()
    share = F.nullif(F.col("quantity"), F.lit(7.0))
    return q.select(
        "quantity",
        fmt.percent(share / 16, 1).alias("one_place"),
        fmt.percent(-share / 32, 2).alias("two_places"),
        fmt.fixed(share / 64, 4).alias("four_places"),
        fmt.shown(fmt.percent(share / 3, 1)).alias("shown"),
        fmt.thousands(F.col("quantity") * 12345).alias("thousands"),
    )


def q_dq_unique(spark, d):
    t = lambda n: A.table(spark, d, n)
    return _union(
        [
            quality.unique_check(t("events"), "events", "event_id"),
            quality.unique_check(t("orders"), "orders", "o_orderkey"),
            quality.unique_check(t("customer"), "customer", "c_custkey"),
            quality.unique_check(t("lineitem"), "lineitem", "l_orderkey"),
        ]
    )


def q_dq_accepted_values(spark, d):
    t = lambda n: A.table(spark, d, n)
    return _union(
        [
            quality.column_checks(t("events"), "events", accepted_values={"event_type": EVENT_TYPES}),
            quality.column_checks(
                t("orders"),
                "orders",
                accepted_values={"o_orderpriority": A.ORDER_PRIORITIES, "o_orderstatus": ORDER_STATUSES},
            ),
            quality.column_checks(t("customer"), "customer", accepted_values={"c_mktsegment": SEGMENTS}),
            quality.column_checks(
                product_world(spark, d)["events"], "stg_raw_events", accepted_values={"event_name": A.FUNNEL_STEPS}
            ),
        ]
    )


def q_dq_relationships(spark, d):
    t = lambda n: A.table(spark, d, n)
    return _union(
        [
            quality.relationship_check(t("events"), "events", "user_id", t("customer"), "c_custkey"),
            quality.relationship_check(t("orders"), "orders", "o_custkey", t("customer"), "c_custkey"),
            quality.relationship_check(t("lineitem"), "lineitem", "l_orderkey", t("orders"), "o_orderkey"),
            quality.relationship_check(t("customer"), "customer", "c_nationkey", t("nation"), "n_nationkey"),
        ]
    )


def q_dq_duplicate_grain(spark, d):
    m = _product_marts(spark, d)
    return quality.duplicate_grain_report(
        {
            "no_duplicate_event_ids": (m["stg_raw_events"], ["event_id"]),
            "no_duplicate_assignment_grain": (_fct_ab(spark, d), ["experiment_id", "user_id"]),
            "no_duplicate_funnel_grain": (m["fct_funnel"], ["user_id", "stage"]),
            "lineitem_grain": (A.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]),
        }
    )


def q_dq_non_empty(spark, d):
    m = _product_marts(spark, d)
    return quality.non_empty(
        {
            "fct_funnel": m["fct_funnel"],
            "fct_cohort_retention": m["fct_cohort_retention"],
            "fct_ab_tests": _fct_ab(spark, d),
        }
    )


def q_dq_reconciliation(spark, d):
    m = _product_marts(spark, d)
    tables = {name: m[name] for name in quality.RECONCILIATION_TABLES}
    return quality.reconciliation(tables, funnel_stages=len(A.FUNNEL_STEPS))


def q_contract_duplicate_keys(spark, d):
    return quality.duplicate_grain(A.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


# ---- report ----------------------------------------------------------------------------------------


def q_topline(spark, d):
    w = product_world(spark, d)
    return report.topline(w["users"], w["events"], w["assignments"])


def q_daily_metrics(spark, d):
    w = order_world(spark, d)
    return edge(
        report.daily_metrics(
            w["users"], w["events"], w["assignments"], A.ORDER_FUNNEL_STEPS, A.ORDER_CONVERSION_EVENTS
        )
    )


# ---- churn -------------------------------------------------------------------------------------------


def _behavior(spark, d):
    ev = product_world(spark, d)["events"]
    return churn.behavior_table(ev, None, A.SESSION_EVENT, A.FEATURE_PREFIX, A.PAYMENT_EVENT, A.CHURN_EVENT)


def q_churn_features(spark, d):
    data = churn.training_set(_behavior(spark, d))
    return edge(data.drop("features"))


def q_churn_split(spark, d):
    data = churn.split_assignment(churn.training_columns(_behavior(spark, d)))
    return data.select("user_id", F.col("label").cast("int").alias("churned"), "split")


def q_churn_auc(spark, d):
    """C6 on the held-out rows for fixed whole-number weights, so that another engine gets the same scores and ties."""
    data = churn.stored_training_table(_behavior(spark, d)).filter(F.col("split") == "test")
    score = F.col("days_since_active") * 40 - F.col("session_count") * 2 - F.col("feature_events")
    return edge(churn.auc_table(data.withColumn("score", score)))


def q_churn_model(spark, d):
    """The fitted coefficients and the AUC of the held-out rows."""
    return edge(churn.churn_model_table(_behavior(spark, d)), 6)


def q_churn_scores(spark, d):
    """Every user's churn probability."""
    scores = churn.fit_churn_model(_behavior(spark, d))["scores"]
    out = scores.select("user_id", F.col("label").cast("int").alias("churned"), "split", "churn_probability")
    return edge(out, 6)


# ---- incremental build -------------------------------------------------------------------------------


def _scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _incremental_models(spark, d):
    """The product world, added in three batches: half of all events, the other half (late for every date), the first again."""
    w, root = product_world(spark, d), _scratch(spark, "incremental")
    rules = incremental.Rules(
        A.SESSION_EVENT, A.FEATURE_PREFIX, A.PAYMENT_EVENT, A.CHURN_EVENT, A.FUNNEL_STEPS, A.PRODUCT_CONVERSION_EVENTS
    )
    even = F.col("event_id") % 2 == 0
    for batch in (w["events"].filter(even), w["events"].filter(~even), w["events"].filter(even)):
        incremental.add_events(spark, root, batch, rules)
    return incremental.models(spark, root, w["users"], w["assignments"], A.AS_OF, rules)


def q_incremental_marts(spark, d):
    """Every model of the incremental build in one relation (mart, user_id, key, moment, n, amount)."""
    m = _incremental_models(spark, d)
    none = F.lit(None)

    def rows(mart, key, user=none, at=none, n=none, amount=none):
        return m[mart].select(
            F.lit(mart).alias("mart"),
            user.cast("long").alias("user_id"),
            key.cast("string").alias("key"),
            at.cast("timestamp_ntz").alias("moment"),
            n.cast("long").alias("n"),
            F.round(amount.cast("double"), 9).alias("amount"),
        )

    c = F.col
    text = lambda *cols: F.concat_ws(":", *[c(x).cast("string") for x in cols])
    activity = text("session_count", "feature_events", "churned_flag", "days_since_active")
    parts = [
        rows("int_user_activity", activity, c("user_id"), c("last_event_ts"), c("session_count"), c("revenue_total")),
        rows("fct_funnel", c("stage"), c("user_id"), c("converted_at"), c("dropped").cast("int")),
        rows("fct_cohort_retention", text("cohort_week", "period_number"), n=c("retained_users")),
        rows("fct_ab_tests", text("experiment_id", "variant"), c("user_id"), c("assigned_ts"), c("converted"), c("revenue")),
        rows("fct_feature_engagement", text("feature_event", "week_start"), c("user_id"), n=c("usage_count")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- positions and bitmaps ---------------------------------------------------------------------------


def q_event_positions(spark, d):
    """Every event's place in time, ties by id."""
    return position.global_position(A.table(spark, d, "events").select("event_id", "ts"), ["ts", "event_id"])


def _bitmap_retention(spark, world, period, session_event):
    numbers_at, days_at, cohorts_at = (_scratch(spark, n) for n in ("numbers", "days", "cohorts"))
    bitmaps.number_users(world["users"]).write.parquet(numbers_at)
    numbers = spark.read.parquet(numbers_at)
    bitmaps.daily_bitmaps(world["events"], numbers, session_event).write.parquet(days_at)
    bitmaps.cohort_bitmaps(numbers, period).write.parquet(cohorts_at)
    return edge(bitmaps.retention_of(spark.read.parquet(days_at), spark.read.parquet(cohorts_at), period))


def q_retention_weekly_bitmaps(spark, d):
    """N4 from stored daily bitmaps."""
    return _bitmap_retention(spark, product_world(spark, d), "weekly", A.SESSION_EVENT)


def q_retention_monthly_bitmaps(spark, d):
    return _bitmap_retention(spark, order_world(spark, d), "monthly", None)


def bucketed_orders(spark, d):
    """The order world's assignments and events, stored in buckets by user."""
    w, root = order_world(spark, d), _scratch(spark, "bucketed")
    n = bucketed.bucket_count(bucketed.column_bytes(w["events"].select("event_id", "user_id", "event_name", "event_ts", "revenue")))
    events = w["events"].select("event_id", "user_id", "event_name", "event_ts", "revenue")
    bucketed.save_model(events, root, "order_events", ["user_id"], n)
    bucketed.save_model(w["assignments"], root, "order_assignments", ["user_id"], n)
    return bucketed.open_models(spark, root)


def q_fct_ab_tests_bucketed(spark, d):
    """M5 over stored buckets: neither the conversion aggregate nor its join needs an exchange."""
    m = bucketed_orders(spark, d)
    return edge(marts.fct_ab_tests(m["order_assignments"], m["order_events"], A.ORDER_CONVERSION_EVENTS, A.ORDER_PAYMENT_EVENT))


# ---- round trips ---------------------------------------------------------------------------------------

BOUNDED = (("events", "event_id"), ("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("customer", "c_custkey"))


def q_table_bounds(spark, d):
    """Counts and key ranges of whole tables from Parquet footers; no data page is read."""
    rows = [(t, *io.footer_bounds(spark, f"{d.rstrip('/')}/{t}.parquet", [k]).first()) for t, k in BOUNDED]
    return spark.createDataFrame(rows, "name string, n_rows long, least long, greatest long")


def _raw_events(spark, d):
    """The product's raw events with text ids and exact revenue, as a file would hold them."""
    raw = product_world(spark, d)["raw_events"]
    ids = {c: F.col(c).cast("string") for c in ("event_id", "user_id")}
    return raw.withColumns({**ids, "revenue": F.coalesce("revenue", F.lit(0)).cast("decimal(20,6)")})


def q_csv_round_trip(spark, d):
    """Events exported in order of time, read again under the contract."""
    path = _scratch(spark, "csv")
    io.export_csv(_raw_events(spark, d), path, ("event_ts", "event_id"))
    out = io.read_csv_table(spark, path, CONTRACTS["raw_events"])
    ids = [F.col(c).cast("long").alias(c) for c in ("event_id", "user_id")]
    return edge(out.select(*ids, "event_name", "event_ts", "revenue", "properties"))


def q_snapshot_round_trip(spark, d):
    """The raw tables validated and published, counted by the receipt and read from the commit."""
    w, root, receipt = product_world(spark, d), _scratch(spark, "snapshot"), {}
    frames = {"raw_events": _raw_events(spark, d), "dim_users": w["raw_users"], "ab_test_assignments": w["raw_assignments"]}
    contracts.publish_snapshot(spark, frames, root, receipt=receipt)
    out = None
    for name, key in (("raw_events", "event_id"), ("dim_users", "user_id"), ("ab_test_assignments", "user_id")):
        stored = contracts.read_source(spark, root, name)
        row = stored.agg(
            F.lit(name).alias("name"),
            F.lit(receipt[name]).cast("long").alias("receipt"),
            F.count("*").alias("stored"),
            F.sum(F.col(key).cast("long")).alias("key_sum"),
            F.count_if(F.col(key).isNull()).alias("nulls"),
        )
        out = row if out is None else out.unionByName(row)
    return out


# ---- quarantine ----------------------------------------------------------------------------------------


def q_quarantine(spark, d):
    """S3: CSV lines with planted faults; every line is either accepted or rejected with its reasons."""
    e, i = A.table(spark, d, "events"), F.col("event_id")
    none = F.lit(None).cast("string")
    text = e.select(
        i.cast("string").alias("event_id"),
        F.when(i % 13 == 0, none).otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.col("event_type").alias("event_name"),
        F.when(i % 11 == 0, F.lit("yesterday")).otherwise(F.col("ts").cast("string")).alias("event_ts"),
        *[none.alias(c) for c in ("session_id", "experiment_id", "variant")],
        F.when(i % 7 == 0, F.lit("12 USD")).otherwise(F.lit("1.25")).alias("revenue"),
        F.col("props").alias("properties"),
    )
    accepted, rejected = quarantine.split_rows(text, CONTRACTS["raw_events"])
    bad = rejected.select(F.get_json_object("record", "$.event_id").cast("long").alias("event_id"), F.array_join("reasons", ",").alias("reasons"))
    return accepted.select(F.col("event_id").cast("long").alias("event_id"), F.lit("").alias("reasons")).unionByName(bad)


QUERIES: dict[str, QueryFn] = {
    "stg_events": q_stg_events,
    "stg_users": q_stg_users,
    "stg_assignments": q_stg_assignments,
    "int_user_activity": q_int_user_activity,
    "int_funnel_steps": q_int_funnel_steps,
    "fct_funnel": q_fct_funnel,
    "fct_cohort_weekly": q_fct_cohort_weekly,
    "fct_ab_tests": q_fct_ab_tests,
    "fct_feature_engagement": q_fct_feature_engagement,
    "fct_feature_engagement_like": q_fct_feature_engagement_like,
    "funnel": q_funnel,
    "funnel_custom_steps": q_funnel_custom_steps,
    "funnel_zero_step": q_funnel_zero_step,
    "biggest_dropoff": q_biggest_dropoff,
    "retention_weekly": q_retention_weekly,
    "retention_monthly": q_retention_monthly,
    "cohort_sizes_monthly": q_cohort_sizes_monthly,
    "retention_heatmap": q_retention_heatmap,
    "behavior_table": q_behavior_table,
    "ab_rates": q_ab_rates,
    "ab_ci_mde": q_ab_ci_mde,
    "ab_pvalue": q_ab_pvalue,
    "ab_decision": q_ab_decision,
    "ab_revenue_welch": q_ab_revenue_welch,
    "ab_results": q_ab_results,
    "ab_variant_comparison": q_ab_variant_comparison,
    "ab_pooled": q_ab_pooled,
    "dq_not_null": q_dq_not_null,
    "dq_unique": q_dq_unique,
    "dq_accepted_values": q_dq_accepted_values,
    "dq_relationships": q_dq_relationships,
    "dq_duplicate_grain": q_dq_duplicate_grain,
    "dq_non_empty": q_dq_non_empty,
    "dq_reconciliation": q_dq_reconciliation,
    "dq_known_failures": q_dq_known_failures,
    "contract_violations": q_contract_violations,
    "text_parsing": q_text_parsing,
    "display_formats": q_display_formats,
    "contract_duplicate_keys": q_contract_duplicate_keys,
    "topline": q_topline,
    "daily_metrics": q_daily_metrics,
    "churn_features": q_churn_features,
    "churn_split": q_churn_split,
    "churn_auc": q_churn_auc,
    "churn_model": q_churn_model,
    "churn_scores": q_churn_scores,
    "incremental_marts": q_incremental_marts,
    "fct_ab_tests_bucketed": q_fct_ab_tests_bucketed,
    "quarantine": q_quarantine,
    "table_bounds": q_table_bounds,
    "csv_round_trip": q_csv_round_trip,
    "snapshot_round_trip": q_snapshot_round_trip,
    "event_positions": q_event_positions,
    "retention_weekly_bitmaps": q_retention_weekly_bitmaps,
    "retention_monthly_bitmaps": q_retention_monthly_bitmaps,
}

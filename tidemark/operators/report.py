"""Report tables (R1-R3): topline figures, the daily metrics table and chart data.

The daily report is a small relation ``(line, section, metric, value, display)`` assembled
from distributed aggregates; only rendering it as text collects (about twenty rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions import fmt
from tidemark.operators.cohort import retention
from tidemark.operators.experiment import conversion_flags, evaluate_statistics, variant_comparison
from tidemark.operators.funnel import funnel, resolve_steps

def topline(users: DataFrame, events: DataFrame, assignments: DataFrame) -> DataFrame:
    """Distinct users, event rows and distinct experiments, as one row of scalar subqueries."""
    spark = events.sparkSession
    return spark.range(1).select(
        users.select(F.countDistinct("user_id")).scalar().alias("users"),
        events.select(F.count(F.lit(1))).scalar().alias("events"),
        assignments.select(F.countDistinct("experiment_id")).scalar().alias("experiments"),
    )


def _row(line: int, section: str, metric: Column, value: Column, display: Column) -> Column:
    return F.struct(
        F.lit(line).alias("line"),
        F.lit(section).alias("section"),
        metric.alias("metric"),
        value.cast("double").alias("value"),
        display.alias("display"),
    )


def daily_metrics(
    users: DataFrame,
    events: DataFrame,
    assignments: DataFrame,
    funnel_steps: Sequence[str] | None = None,
    conversion_events: Sequence[str] = K.CONVERSION_EVENTS,
    alpha: float = K.DEFAULT_ALPHA,
) -> DataFrame:
    """R2: the daily metrics report as a table (experiments pooled, as in the report).

    Events are scanned once: one row per user (event count, a flag per step and for conversion), joined to the user's
    number of assignments per arm, is summed to a single row from which every line of the report is generated.
    """
    steps = resolve_steps(funnel_steps)
    name, known = F.col("event_name"), F.col("user_id").isNotNull()
    did = lambda cond: F.max(F.when(cond, 1).otherwise(0))
    per_user = events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        *[did(name == s).alias(f"step_{i}") for i, s in enumerate(steps)],
        did(name.isin(*conversion_events)).alias("converted"),
    )
    arms = assignments.groupBy("user_id").agg(
        F.count_if(F.col("variant") == K.CONTROL).alias("arms_control"),
        F.count_if(F.col("variant") == K.TREATMENT).alias("arms_treatment"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    hit = F.coalesce(F.col("converted"), F.lit(0))
    summed = per_user.join(arms, "user_id", "full_outer").agg(
        total(F.col("n_events")).alias("events"),
        F.array(*[total(F.when(known, F.col(f"step_{i}"))) for i in range(len(steps))]).alias("reached"),
        total(F.col("arms_control")).alias("n_control"),
        total(F.col("arms_treatment")).alias("n_treatment"),
        total(F.col("arms_control") * hit).alias("control_converted"),
        total(F.col("arms_treatment") * hit).alias("treatment_converted"),
    )
    tested = evaluate_statistics(summed, alpha, pooled=True, revenue_col=None, carry=["events", "reached"])
    row = tested.withColumns(
        {
            "users": users.select(F.countDistinct("user_id")).scalar(),
            "experiments": assignments.select(F.countDistinct("experiment_id")).scalar(),
        }
    )
    c = F.col
    topline_lines = F.array(
        _row(1, "topline", F.lit("users"), c("users"), fmt.thousands(c("users"))),
        _row(2, "topline", F.lit("events"), c("events"), fmt.thousands(c("events"))),
        _row(3, "topline", F.lit("experiments"), c("experiments"), c("experiments").cast("string")),
    )
    experiment_lines = F.array(
        *[
            _row(1000 + i, "experiment", F.lit(metric), c(metric), fmt.shown(display(c(metric), digits)))
            for i, (metric, display, digits) in enumerate(
                [("control_rate", fmt.percent, 2), ("treatment_rate", fmt.percent, 2), ("uplift", fmt.percent, 2),
                 ("p_value", fmt.fixed, 4), ("ci_low", fmt.percent, 2), ("ci_high", fmt.percent, 2), ("mde", fmt.percent, 2)]
            )
        ],
        _row(1007, "experiment", F.lit("recommendation"), F.lit(None), c("recommendation")),
    )
    return row.withColumn("funnel", _funnel_table(steps)).select(
        F.inline(F.concat(topline_lines, _dropoff_lines(), F.flatten(F.transform("funnel", _step_lines)), experiment_lines))
    )


def _funnel_table(steps: Sequence[str]) -> Column:
    """The funnel as an array of one struct per step, from the users that reached each; empty if there are no events."""
    reached = F.col("reached")

    def step(label: Column, i: Column) -> Column:
        users, before = F.get(reached, i), F.get(reached, i - 1)
        none = before.isNull() | (before == 0)
        conversion = F.when(none, F.lit(1.0)).otherwise(users / before)
        return F.struct(
            i.alias("step_index"),
            label.alias("step"),
            users.alias("users"),
            conversion.alias("conversion"),
            F.when(none, F.lit(0.0)).otherwise(F.lit(1.0) - conversion).alias("dropoff"),
        )

    table = F.transform(F.array(*[F.lit(s) for s in steps]), step)
    return F.when(F.col("events") > 0, table).otherwise(F.slice(table, 1, 0))


def _dropoff_lines() -> Column:
    """The step that loses most (ties: the earlier one), or one line saying that there is none."""
    later = F.transform(
        F.filter("funnel", lambda r: r["step_index"] > 0),
        lambda r: F.struct(r["dropoff"].alias("dropoff"), (-r["step_index"]).alias("order"), r["step"].alias("step")),
    )
    worst = F.array_max(later)
    found = F.array(
        _row(10, "funnel", F.lit("biggest_dropoff_step"), F.lit(None), worst["step"]),
        _row(11, "funnel", F.lit("biggest_dropoff"), worst["dropoff"], fmt.percent(worst["dropoff"], 1)),
    )
    none = F.array(_row(10, "funnel", F.lit("biggest_dropoff_step"), F.lit(None), F.lit(K.NO_DROPOFF)))
    return F.when(F.size(later) > 0, found).otherwise(none)


def _step_lines(r: Column) -> Column:
    def line(offset: int, suffix: str, value: Column, display: Column) -> Column:
        return F.struct(
            (F.lit(100 + offset) + r["step_index"] * 3).alias("line"),
            F.lit("funnel").alias("section"),
            F.concat(r["step"], F.lit(suffix)).alias("metric"),
            value.cast("double").alias("value"),
            display.alias("display"),
        )

    return F.array(
        line(0, ":users", r["users"], fmt.thousands(r["users"])),
        line(1, ":conversion_from_previous", r["conversion"], fmt.percent(r["conversion"], 1)),
        line(2, ":dropoff_from_previous", r["dropoff"], fmt.percent(r["dropoff"], 1)),
    )


def render_markdown(report: DataFrame, title: str = "Product metrics of the day") -> str:
    """Text form of :func:`daily_metrics` (collects the ~20 report rows only)."""
    lines = [f"# {title}", ""]
    section = None
    for r in report.orderBy("line").collect():
        if r["section"] != section:
            section = r["section"]
            lines += ["", f"## {section.title()}"]
        lines.append(f"- {r['metric']}: **{r['display']}**")
    return "\n".join(lines) + "\n"


def chart_tables(
    users: DataFrame,
    events: DataFrame,
    assignments: DataFrame,
    funnel_steps: Sequence[str] | None = None,
    conversion_events: Sequence[str] = K.CONVERSION_EVENTS,
) -> dict[str, DataFrame]:
    """The data behind the funnel bars, the weekly retention (long, with sizes and rates) and the variant bars."""
    return {
        "funnel": funnel(events, funnel_steps),
        "retention": retention(events, users, "weekly", sort=False),
        "variant_comparison": variant_comparison(conversion_flags(assignments, events, conversion_events)),
    }

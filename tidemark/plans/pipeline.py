"""Batch pipeline in dependency order.

ingest CSV snapshot -> store, validate contracts, publish raw snapshot (all-or-nothing) -> one attempt holding staged
events, marts, the gate (data tests, singular tests, non-empty and reconciliation checks), report tables and the model
catalogue -> one commit. A run that fails anywhere leaves what was published before in place.

Actions happen only here: writes of stored layers, the gates (which collect failures only) and the handful of report rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.operators import churn, cohort, experiment, intermediate, marts, quality, report, staging
from tidemark.plans import incremental
from tidemark.sources import contracts, io, quarantine
from tidemark.sources.metadata import MODELS, described, model_metadata
from tidemark.sources.schemas import CONTRACTS


@dataclass
class PipelineResult:
    snapshot_id: str
    loaded: dict[str, int]
    checks: list[dict] = field(default_factory=list)
    data_test_failures: list[dict] = field(default_factory=list)
    report_rows: list[dict] = field(default_factory=list)
    rejected: dict[str, int] = field(default_factory=dict)
    churn_auc: float | None = None  # None where the data have too few churned or too few active users


def build_models(
    raw: dict[str, DataFrame],
    as_of: str | datetime | None = K.DEFAULT_AS_OF,
    funnel_steps=K.DEFAULT_FUNNEL_STEPS,
    staged_events: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Staging -> intermediate -> marts as lazy DataFrames (views are expanded by Catalyst).

    ``staged_events`` is a stored copy of the staged events (see :func:`run`); without it
    the staging view is expanded into every model.
    """
    ev = staged_events if staged_events is not None else staging.stage_events(raw["raw_events"])
    users = staging.stage_users(raw["dim_users"])
    asg = staging.stage_assignments(raw["ab_test_assignments"])
    steps = intermediate.user_funnel_steps(ev, funnel_steps)
    return {
        "stg_raw_events": ev,
        "stg_dim_users": users,
        "stg_ab_test_assignments": asg,
        "int_user_activity": intermediate.user_activity(ev, as_of),
        "int_user_funnel_steps": steps,
        "fct_funnel": marts.fct_funnel(steps, funnel_steps),
        "fct_cohort_retention": marts.fct_cohort_retention(users, ev),
        "fct_ab_tests": marts.fct_ab_tests(asg, ev),
        "fct_feature_engagement": marts.fct_feature_engagement(ev),
    }


MART_NAMES = ("fct_funnel", "fct_cohort_retention", "fct_ab_tests", "fct_feature_engagement")
REPORT_NAMES = ("daily_metrics", "funnel", "retention", "retention_heatmap", "variant_comparison", "ab_results")


def register(models: dict[str, DataFrame]) -> None:
    """Each catalogued model as a temporary view: lazy for staging and intermediate ones, over the stored table for marts."""
    for name, df in models.items():
        if name in {m[0] for m in MODELS}:
            df.createOrReplaceTempView(name)


def run(
    spark: SparkSession,
    source_root: str,
    warehouse_root: str,
    as_of: str | datetime | None = K.DEFAULT_AS_OF,
    snapshot_id: str | None = None,
    strict: bool = True,
    enforce_gate: bool = True,
) -> PipelineResult:
    """Run the whole daily build from a CSV snapshot folder into ``warehouse_root``."""
    wh = warehouse_root.rstrip("/")
    raw_text = io.read_csv_snapshot(spark, source_root, strict)
    loaded: dict[str, int] = {}
    snapshot_id = contracts.publish_snapshot(spark, raw_text, f"{wh}/raw", snapshot_id, receipt=loaded)
    raw = contracts.read_snapshot(spark, f"{wh}/raw", snapshot_id)
    result = PipelineResult(snapshot_id, loaded)
    models: dict[str, DataFrame] = {}

    def build_marts(stored: dict[str, DataFrame]) -> dict[str, DataFrame]:
        # Five models read the staged events: stored once, by event date, so each scans Parquet with date pruning.
        models.update(build_models(raw, as_of, staged_events=stored["stg_raw_events"]))
        return _described(models)

    contracts.publish_snapshot(
        spark,
        {"stg_raw_events": staging.stage_events(raw["raw_events"])},
        f"{wh}/marts",
        snapshot_id,
        validate=False,
        then=(build_marts, *_later_steps(spark, raw, models, result, as_of, enforce_gate)),
        partition_by={"stg_raw_events": ["event_date"]},
    )
    return _finish(spark, wh, models, result)


def run_increment(
    spark: SparkSession,
    source_root: str,
    warehouse_root: str,
    as_of: str | datetime | None = K.DEFAULT_AS_OF,
    snapshot_id: str | None = None,
    enforce_gate: bool = True,
) -> PipelineResult:
    """The daily build from new events only: ``raw_events.csv`` holds a day, late events or a repeat, the other two tables
    are whole.

    Rows that break the contract are published beside the accepted ones as ``<table>_rejected``. Accepted events are merged
    into the state under ``<warehouse_root>/state`` (only their dates are rewritten) and all marts are built from the state,
    gated and committed as in :func:`run`. A run that fails in the gate publishes no marts; adding its events again, with
    or without corrections, is safe.
    """
    wh = warehouse_root.rstrip("/")
    tables: dict[str, DataFrame] = {}
    for name, contract in CONTRACTS.items():
        accepted, rejected = quarantine.read_csv_split(spark, f"{source_root.rstrip('/')}/{name}.csv", contract)
        tables.update({name: accepted, f"{name}_rejected": rejected})
    receipt: dict[str, int] = {}
    snapshot_id = contracts.publish_snapshot(spark, tables, f"{wh}/increments", snapshot_id, receipt=receipt)
    raw = contracts.read_snapshot(spark, f"{wh}/increments", snapshot_id)
    result = PipelineResult(snapshot_id, {n: receipt[n] for n in CONTRACTS})
    result.rejected = {n: receipt[f"{n}_rejected"] for n in CONTRACTS}
    incremental.add_events(spark, f"{wh}/state", staging.stage_events(raw["raw_events"]))
    users, assignments = staging.stage_users(raw["dim_users"]), staging.stage_assignments(raw["ab_test_assignments"])
    models = incremental.models(spark, f"{wh}/state", users, assignments, as_of)
    whole = {**raw, "raw_events": models["stg_raw_events"]}
    contracts.publish_snapshot(
        spark,
        _described(models),
        f"{wh}/marts",
        snapshot_id,
        validate=False,
        then=_later_steps(spark, whole, models, result, as_of, enforce_gate),
    )
    return _finish(spark, wh, models, result)


def _described(models: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: described(models[name], name) for name in (*MART_NAMES, "int_user_activity")}


def _later_steps(spark: SparkSession, raw: dict, models: dict, result: PipelineResult, as_of, enforce_gate: bool) -> tuple:
    """Gate, report tables, churn and the heatmap, each from the tables stored before it."""

    def gate(stored: dict[str, DataFrame]) -> dict[str, DataFrame]:
        result.data_test_failures, result.checks, failed = _check(raw, models, stored)
        if failed and enforce_gate:
            raise quality.GateFailed(f"{K.GATE_FAILED}: {', '.join(failed)}")
        return {}

    def report_tables(stored: dict[str, DataFrame]) -> dict[str, DataFrame]:
        users, events = models["stg_dim_users"], models["stg_raw_events"]
        return {
            "model_metadata": model_metadata(spark).coalesce(1),
            "daily_metrics": report.daily_metrics(users, events, models["stg_ab_test_assignments"]).coalesce(1),
            "ab_results": experiment.flat_results(experiment.evaluate_experiments(stored["fct_ab_tests"])),
            "user_behavior": churn.behavior_table(events, as_of),
            **report.chart_tables(users, events, models["stg_ab_test_assignments"]),
        }

    def churn_tables(stored: dict[str, DataFrame]) -> dict[str, DataFrame]:
        try:
            fitted = churn.fit_churn_model(stored["user_behavior"])
        except churn.ChurnModelError:
            return {}
        result.churn_auc = fitted["auc"]
        return {"churn_scores": fitted["scores"], "churn_model": churn.model_row(spark, fitted).coalesce(1)}

    def edge_tables(stored: dict[str, DataFrame]) -> dict[str, DataFrame]:
        # the stored retention table has a row per cohort and period
        periods = cohort.period_numbers(stored["retention"])
        return {"retention_heatmap": cohort.heatmap(stored["retention"], periods)}

    return gate, report_tables, churn_tables, edge_tables


def _finish(spark: SparkSession, wh: str, models: dict[str, DataFrame], result: PipelineResult) -> PipelineResult:
    register({**models, **{n: contracts.read_source(spark, f"{wh}/marts", n, result.snapshot_id) for n in MART_NAMES}})
    daily = contracts.read_source(spark, f"{wh}/marts", "daily_metrics", result.snapshot_id)
    result.report_rows = [r.asDict() for r in daily.orderBy("line").collect()]
    return result


def _check(
    raw: dict[str, DataFrame], models: dict[str, DataFrame], stored: dict[str, DataFrame]
) -> tuple[list[dict], list[dict], list[str]]:
    """Failed data tests, reconciliation checks and the names of everything that failed (Q1-Q9; failures only are collected)."""
    data_tests = quality.product_data_tests(
        models["stg_raw_events"], models["stg_dim_users"], models["stg_ab_test_assignments"],
        stored["fct_funnel"], stored["fct_cohort_retention"], stored["fct_ab_tests"], stored["fct_feature_engagement"],
    )
    failures = [r.asDict() for r in data_tests.filter(F.col("failures") > 0).collect()]
    dupes = quality.singular_tests(models["stg_raw_events"], stored["fct_ab_tests"], stored["fct_funnel"])
    dupe_checks = [r["check"] for r in dupes.select("check").distinct().collect()]
    counted = _stored_counts(raw, models["stg_raw_events"], models["stg_dim_users"], stored)
    checks = [r.asDict() for r in quality.reconciliation_of(counted).collect()]
    must_hold_rows = ("fct_funnel", "fct_cohort_retention", "fct_ab_tests")
    empty = [r["model"] for r in counted.collect() if r["model"] in must_hold_rows and r["row_count"] == 0]
    failed = [c["check"] for c in checks if not c["passed"]]
    failed += [f"{name}:non_empty" for name in empty]
    failed += [f"{d['model']}.{d['column_name']}:{d['test']}" for d in failures]
    return failures, checks, failed + dupe_checks


def _stored_counts(
    raw: dict[str, DataFrame], stg_events: DataFrame, stg_users: DataFrame, stored: dict[str, DataFrame]
) -> DataFrame:
    """The nine row counts, taken once: a small local relation."""
    tables = {
        "raw_events": raw["raw_events"],
        "stg_raw_events": stg_events,
        "dim_users": raw["dim_users"],
        "stg_dim_users": stg_users,
        "ab_test_assignments": raw["ab_test_assignments"],
        **{n: stored[n] for n in MART_NAMES},
    }
    counts = quality.row_counts(tables)
    return counts.sparkSession.createDataFrame(counts.collect(), counts.schema)


def verify_warehouse(spark: SparkSession, warehouse_root: str, snapshot_id: str | None = None) -> dict:
    """Q9/Q10 on a stored warehouse: the nine counts and six checks, as ``{"counts", "checks"}``.

    Raises :class:`quality.GateFailed` naming the failed checks. Reads the committed raw and
    mart snapshots (the newest ones unless ``snapshot_id`` is given); the tables are counted once.
    """
    wh = warehouse_root.rstrip("/")
    snapshot_id = snapshot_id or contracts.current_snapshot(spark, f"{wh}/marts")
    if snapshot_id is None:
        raise FileNotFoundError(f"no committed marts under {wh}")
    raw = contracts.read_snapshot(spark, f"{wh}/raw", snapshot_id)
    stored = {n: contracts.read_source(spark, f"{wh}/marts", n, snapshot_id) for n in (*MART_NAMES, "stg_raw_events")}
    counted = _stored_counts(raw, stored["stg_raw_events"], staging.stage_users(raw["dim_users"]), stored)
    counts = {r["model"]: r["row_count"] for r in counted.collect()}
    checks = {r["check"]: r["passed"] for r in quality.reconciliation_of(counted).collect()}
    failed = [name for name, ok in checks.items() if not ok]
    if failed:
        raise quality.GateFailed(f"{K.GATE_FAILED}: {', '.join(failed)}")
    return {"counts": counts, "checks": checks}


def main(argv: list[str] | None = None) -> int:
    """``spark-submit tidemark/plans/pipeline.py build|verify ...``: prints one JSON document."""
    import argparse
    import json

    from tidemark.operators.report import render_markdown
    from tidemark.session import build_session

    parser = argparse.ArgumentParser(prog="tidemark-pipeline")
    sub = parser.add_subparsers(dest="command", required=True)
    build = sub.add_parser("build", help="load, validate, publish, build, check and report")
    build.add_argument("source", help="folder with dim_users.csv, raw_events.csv, ab_test_assignments.csv")
    build.add_argument("warehouse", help="warehouse root (shared storage)")
    build.add_argument("--as-of", default=K.DEFAULT_AS_OF)
    build.add_argument("--snapshot-id")
    add = sub.add_parser("add", help="the same from new events only, merged into the stored state")
    add.add_argument("source", help="folder with raw_events.csv (new or late events) and the other two tables whole")
    add.add_argument("warehouse", help="warehouse root (shared storage)")
    add.add_argument("--as-of", default=K.DEFAULT_AS_OF)
    add.add_argument("--snapshot-id")
    verify = sub.add_parser("verify", help="reconcile source and mart counts of a stored warehouse")
    verify.add_argument("warehouse")
    verify.add_argument("--snapshot-id")
    args = parser.parse_args(argv)

    spark = build_session()
    try:
        if args.command in ("build", "add"):
            step = run if args.command == "build" else run_increment
            res = step(spark, args.source, args.warehouse, args.as_of, args.snapshot_id)
            report = contracts.read_source(spark, f"{args.warehouse.rstrip('/')}/marts", "daily_metrics", res.snapshot_id)
            done = {"snapshot_id": res.snapshot_id, "loaded": res.loaded, "rejected": res.rejected, "checks": res.checks}
            print(json.dumps(done, default=str))
            print(render_markdown(report))
        else:
            print(json.dumps(verify_warehouse(spark, args.warehouse, args.snapshot_id), indent=2, sort_keys=True))
    except (quality.GateFailed, contracts.ContractError) as exc:
        print(str(exc))
        return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

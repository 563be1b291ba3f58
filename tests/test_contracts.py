import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.quality import GateFailed
from tidemark.sources import contracts, io
from tidemark.sources.contracts import ContractError
from tidemark.sources.schemas import CONTRACTS

USERS_CSV = """user_id,signup_ts,plan,channel,country
ada,2026-05-04T09:30:00+02:00,team,direct,SE
bo,2026-05-05T20:00:00-04:00,enterprise,paid_search,NA
cy,2026-05-12T06:00:00Z,free,referral,IN
"""
EVENTS_CSV = """event_id,user_id,event_name,event_ts,session_id,experiment_id,variant,revenue,properties
m-1,ada,signup,2026-05-04T07:30:00Z,q1,,,,"{""note"": ""said \\""hi\\"", twice""}"
m-2,bo,subscription_payment,2026-05-07T23:45:00-04:00,q2,,,18.125,"{}"
m-3,cy,session_started,2026-05-20T00:10:00+05:30,q3,,,0.000001,
m-4,cy,churned,2026-05-21T00:00:00Z,,,,,{}
"""
ASSIGN_CSV = """experiment_id,user_id,variant,assigned_ts
banner,ada,treatment,2026-05-04T07:30:00Z
banner,bo,control,2026-05-06T00:00:00Z
banner,cy,treatment,2026-05-12T06:00:00Z
"""


def write_snapshot(root, users=USERS_CSV, events=EVENTS_CSV, assignments=ASSIGN_CSV):
    os.makedirs(root, exist_ok=True)
    for name, text in (("dim_users", users), ("raw_events", events), ("ab_test_assignments", assignments)):
        with open(os.path.join(root, f"{name}.csv"), "w") as fh:
            fh.write(text)
    return root


def test_csv_read_escape_types_and_tokens(spark, scratch_dir):
    raw = io.read_csv_snapshot(spark, write_snapshot(os.path.join(scratch_dir, "src")))
    ev = {r["event_id"]: r for r in raw["raw_events"].collect()}
    assert ev["m-1"]["properties"].startswith('{"note": "said') and ev["m-3"]["properties"] is None
    assert str(ev["m-2"]["event_ts"]) == "2026-05-08 03:45:00"  # -04:00 to UTC
    assert str(ev["m-3"]["event_ts"]) == "2026-05-19 18:40:00"  # +05:30 to UTC
    assert ev["m-4"]["revenue"] is None and float(ev["m-2"]["revenue"]) == 18.125
    users = {r["user_id"]: r["country"] for r in raw["dim_users"].collect()}
    assert users["bo"] == "NA"  # only the empty field is NULL


def test_missing_column_and_extra_column(spark, scratch_dir):
    root = write_snapshot(os.path.join(scratch_dir, "src"), users="user_id,plan,signup_ts\nada,free,2026-05-04T00:00:00Z\n")
    with pytest.raises(ContractError, match=r"dim_users is missing columns: \['channel', 'country'\]"):
        io.read_csv_snapshot(spark, root)
    lines = USERS_CSV.splitlines()
    wider = "\n".join([lines[0] + ",shoe"] + [x + ",42" for x in lines[1:]]) + "\n"
    root2 = write_snapshot(os.path.join(scratch_dir, "src2"), users=wider)
    contract = CONTRACTS["dim_users"]
    text = io.read_csv_text(spark, f"{root2}/dim_users.csv", contract)
    assert io.extra_columns(text.columns, contract) == ["shoe"]
    assert io.to_contract_types(text, contract).columns == ["user_id", "signup_ts", "plan", "channel", "country"]


def test_strict_values_fail_and_tolerant_read_reports(spark, scratch_dir):
    root = write_snapshot(os.path.join(scratch_dir, "src"), assignments=ASSIGN_CSV.replace("2026-05-06T00:00:00Z", "last week"))
    with pytest.raises(Exception):
        io.read_csv_snapshot(spark, root)["ab_test_assignments"].collect()
    tolerant = io.read_csv_snapshot_tolerant(spark, root)
    assert tolerant["ab_test_assignments"].filter(F.col("assigned_ts").isNull()).count() == 1
    contract = CONTRACTS["ab_test_assignments"]
    text = io.read_csv_text(spark, f"{root}/ab_test_assignments.csv", contract, strict=False)
    assert [tuple(r) for r in io.conversion_failures(text, contract).collect()] == [("ab_test_assignments", "assigned_ts", 1)]
    empty_root = os.path.join(scratch_dir, "nothing")
    os.makedirs(empty_root)
    t = io.read_csv_snapshot_tolerant(spark, empty_root)
    assert t["raw_events"].count() == 0 and "event_ts" in t["raw_events"].columns


def test_revenue_beyond_six_decimals_is_not_rounded_in_silence(spark, scratch_dir):
    root = write_snapshot(os.path.join(scratch_dir, "src"), events=EVENTS_CSV.replace("18.125", "18.1234567"))
    with pytest.raises(Exception, match="more than 6 decimals"):
        io.read_csv_snapshot(spark, root)["raw_events"].collect()
    contract = CONTRACTS["raw_events"]
    text = io.read_csv_text(spark, f"{root}/raw_events.csv", contract, strict=False)
    assert {r["column"]: r["failures"] for r in io.conversion_failures(text, contract).collect()} == {"event_ts": 0, "revenue": 1}


def test_line_breaks_in_cells_are_an_option(spark, scratch_dir):
    broken = EVENTS_CSV.replace('"{}"', '"two\nlines"')
    root = write_snapshot(os.path.join(scratch_dir, "src"), events=broken)
    got = io.read_csv_table(spark, f"{root}/raw_events.csv", CONTRACTS["raw_events"], line_breaks=True)
    assert {r["event_id"]: r["properties"] for r in got.collect()}["m-2"] == "two\nlines" and got.count() == 4
    with pytest.raises(Exception):
        io.read_csv_table(spark, f"{root}/raw_events.csv", CONTRACTS["raw_events"]).collect()


def test_duplicate_and_null_keys_rejected(spark):
    columns = "user_id string, signup_ts string, plan string, channel string, country string"
    times = [f"2026-0{m}-11T0{m}:00:00Z" for m in range(1, 6)]
    thrice = spark.createDataFrame([(u, t, "team", "direct", "IN") for u, t in zip("xyxzx", times, strict=True)], columns)
    with pytest.raises(ContractError, match="duplicate key"):
        contracts.validate_frame(thrice, "dim_users")
    assert contracts.contract_violations(thrice, CONTRACTS["dim_users"]).first()["failures"] == 1
    asg = "experiment_id string, user_id string, variant string, assigned_ts string"
    nulls = spark.createDataFrame([("k", "v", None, "2026-05-05T00:00:00Z"), ("k", None, "control", None)], asg)
    with pytest.raises(ContractError, match=r"NULL values in NOT NULL columns: \['assigned_ts', 'user_id', 'variant'\]"):
        contracts.validate_frame(nulls, "ab_test_assignments")
    pairs = spark.createDataFrame([("k", "v", "control", "t"), ("l", "v", "control", "t"), ("k", "v", "treatment", "t")], asg)
    with pytest.raises(ContractError, match=r"\['experiment_id', 'user_id'\]"):
        contracts.validate_frame(pairs, "ab_test_assignments")


def _blocked(stored):
    raise GateFailed("blocked")


def test_failed_load_leaves_previous_snapshot(spark, scratch_dir):
    wh = os.path.join(scratch_dir, "wh")
    good = io.read_csv_snapshot(spark, write_snapshot(os.path.join(scratch_dir, "good")))
    first = contracts.publish_snapshot(spark, good, wh, "20260501T000000Z")
    assert contracts.current_snapshot(spark, wh) == first
    again = io.read_csv_snapshot(
        spark, write_snapshot(os.path.join(scratch_dir, "bad"), assignments=ASSIGN_CSV + ASSIGN_CSV.splitlines()[1] + "\n")
    )
    with pytest.raises(ContractError):
        contracts.publish_snapshot(spark, again, wh, "20260502T000000Z")
    with pytest.raises(GateFailed):
        contracts.publish_snapshot(spark, good, wh, "20260503T000000Z", gate=_blocked)
    assert contracts.current_snapshot(spark, wh) == first
    assert contracts.read_source(spark, wh, "raw_events").count() == 4
    with pytest.raises(FileNotFoundError):
        contracts.read_source(spark, wh, "raw_events", "20260503T000000Z")
    second = contracts.publish_snapshot(spark, good, wh, "20260504T000000Z")
    assert contracts.current_snapshot(spark, wh) == second


def test_repeating_an_id_is_all_or_nothing(spark, scratch_dir):
    wh = os.path.join(scratch_dir, "wh")
    users = lambda n: {"extra": spark.createDataFrame([(i,) for i in range(n)], "k int")}
    contracts.publish_snapshot(spark, users(3), wh, "day", validate=False)
    before = contracts.read_source(spark, wh, "extra", "day")
    with pytest.raises(GateFailed):
        contracts.publish_snapshot(spark, users(9), wh, "day", gate=_blocked, validate=False)
    assert contracts.read_source(spark, wh, "extra", "day").count() == 3
    contracts.publish_snapshot(spark, users(5), wh, "day", validate=False)
    assert contracts.read_source(spark, wh, "extra", "day").count() == 5
    assert before.count() == 3  # what a reader holds is not overwritten
    assert contracts.committed_snapshots(spark, wh) == ["day"]


def test_later_tables_share_the_commit(spark, scratch_dir):
    wh = os.path.join(scratch_dir, "wh")
    base = {"t": spark.range(4)}
    derived = lambda stored: {"u": stored["t"].filter("id > 1")}
    contracts.publish_snapshot(spark, base, wh, "one", validate=False, then=[derived])
    assert contracts.read_source(spark, wh, "u").count() == 2
    with pytest.raises(GateFailed):
        contracts.publish_snapshot(spark, base, wh, "two", validate=False, then=[derived, _blocked])
    assert contracts.current_snapshot(spark, wh) == "one"


def test_write_table_receipt_and_export(spark, scratch_dir, sample):
    path = os.path.join(scratch_dir, "ev")
    assert io.write_table(sample["events"], path, partition_by=["event_date"]) == 17
    assert io.write_table(sample["events"].limit(3), path, mode="append", partition_by=["event_date"]) == 3
    assert spark.read.parquet(path).count() == 20
    out = os.path.join(scratch_dir, "csv")
    io.export_csv(sample["events"].select("event_id", "event_ts", "properties"), out)
    ids = [r["event_id"] for r in io.csv_reader(spark).csv(out).collect()]
    assert ids == [f"a{i:02d}" for i in (1, 2, 3, 4, 8, 9, 10, 11, 12, 13, 5, 6, 7, 14, 17, 15, 16)]


def test_partitioned_write_merges_small_dates_and_splits_a_hot_one(spark, scratch_dir):
    rows = spark.range(0, 60_000, 1, 64).select(
        "id",
        F.md5(F.col("id").cast("string")).alias("filler"),
        F.when(F.col("id") % 2 == 0, F.lit("2026-01-01")).otherwise(F.concat(F.lit("2026-02-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0"))).alias("d"),
    )
    saved = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        path = os.path.join(scratch_dir, "t")
        assert io.write_table(rows, path, partition_by=["d"]) == 60_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", saved)
    files = {d: len([f for f in os.listdir(os.path.join(path, d)) if f.startswith("part-")]) for d in os.listdir(path) if d.startswith("d=")}
    assert len(files) == 15 and files["d=2026-01-01"] > 1
    assert sum(files.values()) < 64


def test_unfinished_commit_is_ignored(spark, scratch_dir):
    wh = os.path.join(scratch_dir, "wh")
    contracts.publish_snapshot(spark, {"t": spark.range(2)}, wh, "one", validate=False)
    # a publisher that died before its rename leaves a draft
    with open(os.path.join(wh, "_commits", ".20260505T000000Z"), "w") as fh:
        fh.write("two\t2026")
    assert contracts.current_snapshot(spark, wh) == "one"


def test_of_two_publishers_of_an_id_one_wins(spark, scratch_dir):
    wh = os.path.join(scratch_dir, "wh")
    publish = lambda n, i, gate=None: contracts.publish_snapshot(spark, {"t": spark.range(n)}, wh, i, gate, validate=False)
    with pytest.raises(ContractError, match="day was published by another run"):
        publish(3, "day", gate=lambda stored: publish(5, "day"))
    assert contracts.read_source(spark, wh, "t", "day").count() == 5
    with pytest.raises(ContractError):
        publish(3, "day", gate=lambda stored: publish(6, "day"))
    assert contracts.read_source(spark, wh, "t", "day").count() == 6
    publish(7, "other", gate=lambda stored: publish(8, "day"))  # another id is no conflict
    assert [i for _, i, _ in contracts.commit_log(spark, wh)] == ["day", "day", "day", "other"]


def test_a_taken_number_is_not_written_again(spark, scratch_dir):
    assert contracts._add_commit(spark, scratch_dir, 1, "a", "x")
    assert not contracts._add_commit(spark, scratch_dir, 1, "b", "y")
    assert contracts.commit_log(spark, scratch_dir) == [(1, "a", "x")]
    assert contracts.commit(spark, scratch_dir, "b", "y", None) == 2


def test_the_current_snapshot_follows_commits_not_names(spark, scratch_dir):
    for i in ("2026-07-26", "20260725T000000Z", "2026-07-25"):
        contracts.publish_snapshot(spark, {"t": spark.range(1)}, scratch_dir, i, validate=False)
        assert contracts.current_snapshot(spark, scratch_dir) == i
    contracts.publish_snapshot(spark, {"t": spark.range(1)}, scratch_dir, "2026-07-26", validate=False)
    assert contracts.committed_snapshots(spark, scratch_dir) == ["20260725T000000Z", "2026-07-25", "2026-07-26"]


def test_only_dead_attempts_are_removed(spark, scratch_dir):
    publish = lambda n, gate=None: contracts.publish_snapshot(spark, {"t": spark.range(n)}, scratch_dir, "day", gate, validate=False)
    publish(2)
    held = contracts.read_source(spark, scratch_dir, "t")
    publish(3)
    with pytest.raises(GateFailed):
        publish(4, _blocked)
    assert contracts.remove_dead_attempts(spark, scratch_dir, timedelta(hours=1)) == []  # it could still be running
    assert len(contracts.remove_dead_attempts(spark, scratch_dir, timedelta(0))) == 1
    assert held.count() == 2 and contracts.read_source(spark, scratch_dir, "t").count() == 3
    assert contracts.remove_dead_attempts(spark, os.path.join(scratch_dir, "none"), timedelta(0)) == []


def test_model_metadata_and_descriptions(spark, sample):
    from tidemark.operators import marts
    from tidemark.sources.metadata import described, model_metadata

    meta = {r["model"]: r for r in model_metadata(spark).collect()}
    assert len(meta) == 9 and meta["fct_funnel"]["layer"] == "marts" and meta["stg_raw_events"]["materialized"] == "view"
    assert "daily_metrics_report" in meta["fct_ab_tests"]["consumers"]
    mart = described(marts.fct_ab_tests(sample["assignments"], sample["events"]), "fct_ab_tests")
    assert mart.schema["variant"].metadata == {"comment": "arm", "model": "fct_ab_tests"}
    assert mart.columns == marts.fct_ab_tests(sample["assignments"], sample["events"]).columns

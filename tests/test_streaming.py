import os

from tidemark.streaming.ingest import start_ingest

HEADER = "event_id,user_id,event_name,event_ts,session_id,experiment_id,variant,revenue,properties\n"


def _drop(folder, name, rows):
    with open(os.path.join(folder, name), "w") as fh:
        fh.write(HEADER + "".join(r + "\n" for r in rows))


def _ingested(spark, table):
    return sorted(r["event_id"] for r in spark.read.parquet(table).collect())


def test_every_row_of_every_file_is_stored_once(spark, scratch_dir):
    landing, table, ckpt = (os.path.join(scratch_dir, n) for n in ("landing", "events", "ckpt"))
    os.makedirs(landing)
    _drop(landing, "first.csv", [
        'n-10,ines,signup,2026-03-01T23:30:00-02:00,v1,,,,"{""from"": ""mail""}"',
        "n-11,ines,session_started,2026-02-27T06:00:00+05:30,v2,,,7.25,{}",
    ])
    start_ingest(spark, landing, table, ckpt).awaitTermination(120)
    got = {r["event_id"]: r for r in spark.read.parquet(table).collect()}
    assert str(got["n-10"]["event_ts"]) == "2026-03-02 01:30:00" and str(got["n-10"]["event_date"]) == "2026-03-02"
    assert got["n-10"]["properties"] == '{"from": "mail"}' and float(got["n-10"]["revenue"]) == 0.0
    assert str(got["n-11"]["event_ts"]) == "2026-02-27 00:30:00" and float(got["n-11"]["revenue"]) == 7.25

    # two months late: stored all the same, and nothing of the first file is stored again
    _drop(landing, "second.csv", ["n-12,omar,signup,2026-01-01T00:00:00Z,v3,,,,{}", "n-13,omar,signup,2026-03-02T00:00:00Z,v4,,,,{}"])
    start_ingest(spark, landing, table, ckpt).awaitTermination(120)
    assert _ingested(spark, table) == ["n-10", "n-11", "n-12", "n-13"]


def test_duplicates_are_dropped_only_on_request(spark, scratch_dir):
    landing = os.path.join(scratch_dir, "landing")
    os.makedirs(landing)
    _drop(landing, "one.csv", ["k1,ines,signup,2026-03-01T00:00:00Z,v1,,,,{}"] * 2)
    for name, options, count in (("all", {}, 2), ("once", {"dedupe_within": "7 days"}, 1)):
        table = os.path.join(scratch_dir, name)
        start_ingest(spark, landing, table, f"{table}-ckpt", **options).awaitTermination(120)
        assert len(_ingested(spark, table)) == count

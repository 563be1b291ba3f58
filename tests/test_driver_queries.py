"""Every registered query against its DuckDB oracle on the smallest driver tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tools.oracle_check import TABLES, rows_of

from .conftest import SMOKE_DIR


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = Path(SMOKE_DIR) / f"{t}.parquet"
        if p.exists():
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(E.queries()) - set(E.CORPUS_QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - set(E.CORPUS_QUERIES)))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMOKE_DIR)
    spark_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert Counter(spark_rows) == Counter(rows_of(names, cur.fetchall()))


def test_heatmap_has_every_week_of_the_events(spark, scratch_dir):
    for t in ("customer", "nation", "region", "orders"):
        spark.read.parquet(f"{SMOKE_DIR}/{t}.parquet").write.parquet(f"{scratch_dir}/{t}.parquet")
    events = spark.read.parquet(f"{SMOKE_DIR}/events.parquet")
    later = events.withColumn("ts", F.expr("ts + interval 35 days"))
    events.unionByName(later).write.parquet(f"{scratch_dir}/events.parquet")
    cells = {(str(r[0]), r[1]): r[4] for r in E.queries()["retention_weekly"](spark, scratch_dir).collect()}
    weeks = sorted({k for _, k in cells})
    assert max(weeks) > 5
    out = E.queries()["retention_heatmap"](spark, scratch_dir)
    assert out.columns == ["cohort_period", *map(str, weeks)]
    got = {(r[0], k): r[str(k)] for r in out.collect() for k in weeks}
    assert got == {(c, k): cells.get((c, k), 0.0) for c, k in got} and got.keys() >= cells.keys()


def test_entry_smoke(spark):
    out = E.entry(spark)
    assert out.columns == ["step", "users", "conversion_from_previous", "dropoff_from_previous"]
    assert out.count() == 5

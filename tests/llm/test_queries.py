"""Registered corpus queries on the smallest tables: contract columns, and DuckDB's rows where SQL can express them."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import QUERIES
from tools.oracle_check import rows_of

SMOKE = "/root/testdata/sf0.001"
CONTRACT = {
    1: "page_id url text n_chars",
    2: "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    3: "page_id host path rule verdict",
    4: "doc_id held_out lang_pred score",
    5: "page_id payload_bytes payload_digest record_type refers_to",
    6: "doc_id fingerprint component_id",
    7: "doc_id n_lines n_dropped kept_sha256",
    8: "doc_id n_words n_hit n_items items_sha256 contaminated",
    9: "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    10: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    11: "item_id rank doc_id score",
    12: "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    13: "doc_id n_words n_removed kept_sha256",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_contract_columns(spark, name):
    number = int(name[2:].split("_")[0])
    out = QUERIES[name](spark, SMOKE)
    assert set(CONTRACT[number].split()) <= set(out.columns)
    table = "pages" if number in (1, 3, 5) else "documents"
    if number != 2:
        assert out.count() == spark.read.parquet(f"{SMOKE}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_rows_equal_duckdb(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMOKE}/{table}.parquet')")
    out = QUERIES[name](spark, SMOKE)
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(out.columns) == sorted(CONTRACT[int(name[2:].split("_")[0])].split())
    assert Counter(rows_of(out.columns, [tuple(r) for r in out.collect()])) == Counter(rows_of(names, cur.fetchall()))


def test_each_contract_is_registered_once():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == sorted(CONTRACT)

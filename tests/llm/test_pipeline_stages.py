"""The corpus pipeline stage by stage on the smallest tables and on odd rows, each against its operator's plain meaning."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline as C

from .test_decontaminate import plain as plain_contamination
from .test_rules_and_lines import deduped
from .test_simhash import plain_components, plain_fingerprint

SMOKE = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage."""
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    odd = [(10_001, None, "en", "s", None), (10_002, "", "en", "s", 0), (10_003, "123 $$$", None, None, 7)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    out = {}
    for name, stage in C.STAGES:
        before = docs
        docs = C.store(stage(spark, docs, SMOKE), f"test-{name}")
        out[name] = (before.collect(), docs.collect(), docs.columns)
    return out


def test_stages_are_in_order_and_keep_the_columns(stages):
    assert list(stages) == ["language_id", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "packing"]
    assert all(columns == COLUMNS for _, _, columns in list(stages.values())[:-1])


def test_language_stage_drops_what_has_no_language(stages):
    before, after, _ = stages["language_id"]
    gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
    assert {10_001, 10_002, 10_003} <= gone and len(gone) <= 5
    assert set(after) <= set(before)


def test_line_stage(stages):
    before, after, _ = stages["line_dedup"]
    want = Counter((i, t) for i, t, *_ in deduped([(r["doc_id"], r["text"]) for r in before]))
    assert Counter((r["doc_id"], r["text"]) for r in after) == want
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_simhash_stage(stages):
    before, after, _ = stages["simhash_near_dedup"]
    rows = sorted(before, key=lambda r: r["doc_id"])
    roots = plain_components([plain_fingerprint(r["text"]) for r in rows])
    assert sorted(r["doc_id"] for r in after) == sorted({rows[k]["doc_id"] for k in roots})


def test_decontamination_stage(spark, stages):
    before, after, _ = stages["benchmark_decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMOKE}/benchmark.parquet").collect()]
    dirty = {i for i, *_, hit in plain_contamination([(r["doc_id"], r["text"]) for r in before], items) if hit}
    assert dirty and {r["doc_id"] for r in after} == {r["doc_id"] for r in before} - dirty


def test_packing_stage(stages):
    before, after, _ = stages["packing"]
    total = {r["doc_id"]: r["doc_tokens"] for r in after}
    assert set(total) == {r["doc_id"] for r in before}
    assert sum(r["length"] for r in after) == sum(total.values())


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").limit(0)
    for name, stage in C.STAGES:
        docs = C.store(stage(spark, docs, SMOKE), f"empty-{name}")
        assert docs.count() == 0


def test_extra_columns_and_repeated_rows_pass(spark):
    """Every stage, with columns named like those that the operators make, in other letter case too."""
    line = "the same long line of words in every document and of the whole table\nand one of its own"
    rows = [(i % 3, line, "en", "x", 1, "z", 0.5, "q", True) for i in range(6)] + [(None, None, None, None, None, None, None, None, None)]
    names = ["doc_id", "text", "lang", "hits", "th", "fp", "Score", "LANG_PRED", "contaminated"]
    kinds = "long string string string int string double string boolean".split()
    docs = spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True)))
    before = docs
    for name, stage in C.STAGES:
        docs = C.store(stage(spark, before, SMOKE), f"extra-{name}")
        if name == "packing":
            assert sum(r["length"] for r in docs.select("length").collect()) >= 1
        else:
            assert docs.columns == names and docs.count() >= 1
            assert {tuple(r)[2:] for r in docs.collect()} <= {tuple(r)[2:] for r in before.collect()}
            before = docs


def test_python_stages_take_texts_in_small_batches(spark, monkeypatch):
    """Executor memory must not follow the rows of a batch: 1,500 texts of 8,000 characters in one partition."""
    key, most = "spark.sql.execution.arrow.maxBytesPerBatch", 2 * (2 << 20)
    docs = spark.range(0, 1500, 1, 1).selectExpr(
        "id AS doc_id", "repeat('x', 8000) AS text", "'en' AS lang", "'s' AS source", "8000L AS n_chars"
    )

    class Model:
        langs = ["en"]

        def document_probabilities(self, texts):
            import numpy as np

            assert sum(map(len, texts)) <= most
            return np.ones((len(texts), 1))

    def longest(batches):
        for pdf in batches:
            yield pdf.assign(n=pdf["text"].str.len().sum())[["n"]].head(1)

    spark.conf.unset(key)
    monkeypatch.setattr(C.langid, "train_model", lambda *_, **__: Model())
    assert C.language_id(spark, docs, SMOKE).count() == 1500
    for name in ("language_id", "simhash_near_dedup", "packing"):
        spark.conf.unset(key)
        dict(C.STAGES)[name](spark, docs.limit(3), SMOKE)
        assert max(r["n"] for r in docs.mapInPandas(longest, "n long").collect()) <= most

"""Sketch search against scoring every document for every item."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import max_sketch

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c in counted:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // n_terms
            score = 0
            for t in terms(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return out


def fixture():
    rng = random.Random(8)
    vocabulary = [f"{a}{b}" for a in "abcdefghij" for b in ("", "ü", "9", "x")] + [f"rare{i}" for i in range(60)]
    chance = [1 / (i + 1) for i in range(len(vocabulary))]

    def some(n):
        return rng.choice([" ", ", ", "\n", "_"]).join(w.title() if rng.random() < 0.3 else w for w in rng.choices(vocabulary, chance, k=n))

    docs = [(i, some(rng.choice([0, 1, 5, 30, 80]))) for i in range(-40, 160)]
    docs += [(None, some(20)), (500, None), (501, ""), (502, " -_- "), (503, "a " * 700 + "rare3")]
    docs += [(600 + i, docs[50][1]) for i in range(60)] + docs[10:13] + [(None, docs[50][1])]  # copies, repeated rows, ties
    rng.shuffle(docs)
    items = [(i, some(rng.choice([1, 4, 12, 40]))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "unknown words"), (None, "rare1 rare1 a"), items[3], (103, docs[50][1])]
    return docs, items


@pytest.mark.parametrize(("k", "block_terms", "chunk"), [(20, max_sketch.BLOCK_TERMS, 512), (3, 20, 7)])
def test_equals_scoring_everything(spark, monkeypatch, k, block_terms, chunk):
    monkeypatch.setattr(max_sketch, "CHUNK_DOCS", chunk)
    monkeypatch.setattr(max_sketch, "BLOCKS_PER_PASS", 4)
    docs, items = fixture()
    documents = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, score string").repartition(3)
    questions = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, rank int")
    out = max_sketch.rank_documents(documents, questions, k=k, block_terms=block_terms)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(r) for r in out.collect()) == Counter(plain(docs, items, k))


def test_large_vocabularies_join_instead_of_broadcasting(spark, monkeypatch):
    monkeypatch.setattr(max_sketch, "VOCABULARY_BROADCAST_BYTES", 0)
    docs, items = fixture()
    out = max_sketch.rank_documents(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    assert Counter(tuple(r) for r in out.collect()) == Counter(plain(docs, items, 20))


def test_empty_tables(spark):
    docs, items = (spark.createDataFrame(x, s) for x, s in zip(fixture(), ("doc_id long, text string", "item_id long, text string"), strict=True))
    assert max_sketch.rank_documents(docs.limit(0), items).collect() == []
    assert max_sketch.rank_documents(docs, items.limit(0)).collect() == []
    assert max_sketch.rank_documents(docs.where("text is null"), items).collect() == []


def test_bounds_are_never_below_the_scores():
    docs, items = fixture()
    docs = [Counter(max_sketch.terms_of((t or "").encode())) for _, t in docs] + [Counter({b"a": 400, b"rare1": 300})]
    docs = [c for c in docs if c]
    rows = [(k, t, n, 3) for k, (_, text) in enumerate(items) for t, n in Counter(terms(text)).items()]
    queries = max_sketch.Queries(rows, 1000)
    m = np.arange(len(docs)) + 76
    sketches = [np.frombuffer(max_sketch.sketch_of(list(c), np.array(list(c.values()))), np.uint8) for c in docs]
    bounds = max_sketch.upper_bounds(sketches, m, queries.hashes, queries.matrix())
    exact = np.array([
        [sum(w * ((10**9 * c[t]) // (1000 * c[t] + 12 * int(m[d]))) for t, w in own.items() if t in c) for own in queries.of]
        for d, c in enumerate(docs)
    ])
    assert (bounds >= exact).all() and (bounds <= 1.5 * exact + 1e6).mean() > 0.7


def test_a_very_long_text(spark):
    text = " ".join(f"t{i}" for i in range(400_000)) + " needle"
    docs = spark.createDataFrame([(1, text), (2, "needle t7"), (3, "t9")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "needle"), (2, text)], "item_id long, text string")
    out = [tuple(r) for r in max_sketch.rank_documents(docs, items).orderBy("item_id", "rank").collect()]
    assert [r[:3] for r in out] == [(1, 1, 2), (1, 2, 1), (2, 1, 1), (2, 2, 2), (2, 3, 3)]

"""Winnowing decontamination against a plain search of all windows."""

from __future__ import annotations

import random
import re

import pytest

from tidemark.llm import decontaminate

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, hits string, w int, item_id long"
ITEMS = "item_id long, text string, size int"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain(docs, items):
    out = []
    for i, text, *_ in docs:
        w, hit, found = words(text), set(), set()
        for item_id, item, *_ in items:
            v = words(item)
            n = min(len(v), 10)
            windows = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if n else set()
            for at in range(len(w) - n + 1) if n else ():
                if tuple(w[at : at + n]) in windows:
                    hit |= set(range(at, at + n))
                    if item_id is not None:
                        found.add(str(item_id))
        out.append((i, len(w), len(hit), tuple(sorted(found)), bool(hit)))
    return out


def fixture():
    rng = random.Random(6)
    vocabulary = [f"t{i}" for i in range(30)]
    items = [(k, " ".join(rng.choices(vocabulary, k=n)), 1) for k, n in enumerate([10, 11, 14, 25, 60, 3, 9, 1])]
    items += [(100, None, 1), (101, "", 1), (102, "-- !!", 1), (None, " ".join(f"z{i}" for i in range(12)), 1), items[2], (103, "Über alles " * 10, 1)]
    docs = [(0, None), (1, ""), (2, "t1"), (3, " \n ")]
    for i in range(10, 60):
        text = rng.choices(vocabulary, k=rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            w = words(items[rng.choice([0, 1, 2, 3, 4, 6, 11])][1])
            a = rng.randint(0, max(0, len(w) - 5))
            text[rng.randint(0, len(text)) : 0] = w[a : a + rng.randint(5, 14)]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(x.upper() if rng.random() < 0.2 else x for x in text)))
    docs += [docs[-1], docs[12], (None, items[4][1]), (70, "ü" + items[13][1]), (71, (items[1][1] + " filler ") * 2000)]
    docs += [(80 + i, items[3][1]) for i in range(30)]  # one passage in many documents
    return docs, items


@pytest.mark.parametrize("broadcast_rows", [0, 200_000])
def test_matches_a_plain_search(spark, broadcast_rows):
    docs, items = fixture()
    df = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], DOCS)
    out = decontaminate.contamination(df, spark.createDataFrame(items, ITEMS), broadcast_rows=broadcast_rows).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"]), r["contaminated"]) for r in out), key=str)
    assert got == sorted(plain(docs, items), key=str)
    assert all((r["hits"], r["w"], r["item_id"]) == ("x", 1, 2) for r in out)


def test_without_short_items_and_empty_tables(spark):
    docs, items = fixture()
    long_items = [x for x in items if len(words(x[1])) >= 10]
    df = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], DOCS)
    out = decontaminate.contamination(df, spark.createDataFrame(long_items, ITEMS)).collect()
    assert sorted(((r["doc_id"], r["n_hit"]) for r in out), key=str) == sorted(((p[0], p[2]) for p in plain(docs, long_items)), key=str)
    none = spark.createDataFrame([], ITEMS)
    assert not any(r["contaminated"] for r in decontaminate.contamination(df, none).collect())
    assert decontaminate.contamination(df.limit(0), none).collect() == []


def test_every_shared_span_of_ten_words_is_found(spark):
    rng = random.Random(1)
    items = [(k, " ".join(rng.choices("a b c".split(), k=10)), 1) for k in range(40)]  # many ties and repeated grams
    docs = [(k, " ".join(rng.choices("a b c".split(), k=9)) + " " + items[k][1] + " b a", "x", 1, 2) for k in range(40)]
    out = decontaminate.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    assert {r["doc_id"]: tuple(r["item_ids"]) for r in out} == {p[0]: p[3] for p in plain(docs, items)}
    assert all(r["contaminated"] for r in out)


def test_plan_has_no_python(spark):
    docs, items = fixture()
    df = decontaminate.contamination(spark.createDataFrame([(*d, "x", 1, 2) for d in docs], DOCS), spark.createDataFrame(items, ITEMS))
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def test_equal_items_and_shared_prompts_are_one_benchmark_row(spark):
    prompt = " ".join(f"p{i}" for i in range(40))
    items = [(k, prompt, 1) for k in range(60)] + [(100 + k, f"{prompt} tail{k} " * 2, 1) for k in range(5)]
    marks = decontaminate.benchmark_fingerprints(
        spark.createDataFrame(items, ITEMS).select("item_id", decontaminate.item_words(decontaminate.F.col("text")).alias("w")), 10, 5, []
    )
    rows = marks.collect()
    alone = decontaminate.benchmark_fingerprints(
        spark.createDataFrame(items[:1], ITEMS).select("item_id", decontaminate.item_words(decontaminate.F.col("text")).alias("w")), 10, 5, []
    ).count()
    assert sum("0" in r["items"] for r in rows) == alone  # sixty equal items have no more rows than one
    assert max(len(r["items"]) for r in rows) == 65  # the inner windows of the prompt are shared by all
    docs = [(k, f"x {prompt} y", "x", 1, 2) for k in range(20)]
    out = decontaminate.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    want = {p[0]: p[1:4] for p in plain([d[:2] for d in docs], items)}
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], tuple(r["item_ids"])) for r in out} == want

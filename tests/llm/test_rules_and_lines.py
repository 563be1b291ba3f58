"""Quality rules and line de-duplication against plain-Python versions, on odd rows and generated texts."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import line_dedup, quality_rules
from tidemark.llm.quality_rules import STOP_WORDS, SYMBOLS

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, measures string, kept string, drop_id int"


def odd_texts() -> list[str | None]:
    rng = random.Random(3)
    vocabulary = ["the", "of", "Dog", "cat###", "é", "łódź", "a|b", "x", "und", " ", "日本"]
    made = [" ".join(rng.choices(vocabulary, k=n)) for n in (1, 2, 3, 4, 5, 60, 300)]
    lines = ["\n".join(rng.choices(["one line here", "", "  ", "another", "the of and a"], k=n)) for n in (2, 8, 40)]
    return [None, "", " ", "\n\n\n", "\t\x0b\x0c\r", "a a a a a", "the " * 5000, *made, *lines, *made[:2]]


def measured(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen = Counter(grams)
    hit = {p for i, g in enumerate(grams) if seen[g] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, chars, symbols = len(w), sum(map(len, w)), sum(text.count(c) for c in SYMBOLS)
    dup, stop = len(lines) - len(set(lines)), sum(x in STOP_WORDS for x in w)
    base = n < 50 or 100 * len(hit) > 50 * n
    method = (
        200 * n <= 100 * chars <= 1500 * n and 100 * symbols <= 10 * n and 100 * stop >= 4 * n
        and 100 * dup <= 50 * len(lines)
    )
    return n, chars, symbols, dup, len(hit), base, not base and method


def test_rules_match_a_plain_version(spark):
    texts = odd_texts()
    rows = [(i, t, "m", "k", 1) for i, t in enumerate(texts)] + [(None, "a b", None, None, None)]
    out = quality_rules.apply_rules(spark.createDataFrame(rows, DOCS)).collect()
    assert len(out) == len(rows)
    by_id = {r["doc_id"]: r for r in out}
    for i, text in enumerate(texts):
        r = by_id[i]
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"))
        assert got == measured(text), (i, text)
        assert r["measures"] == "m" and r["drop_id"] == 1
    assert by_id[0]["failed_rules"] == ["enough_words"]


def test_rules_on_an_empty_table(spark):
    assert quality_rules.apply_rules(spark.createDataFrame([], DOCS)).collect() == []


def test_rules_projection_has_no_python_and_no_shuffle(spark):
    df = quality_rules.apply_rules(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def deduped(rows, min_chars=20, min_docs=3):
    """rows: (id, text) in order; the kept text, lines and dropped lines of each."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    rank = lambda i: float("-inf") if i is None else i
    holders = defaultdict(set)
    for r, (i, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add((rank(i), r))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if len(holders.get(key(x), ())) < min_docs or rank(i) == max(holders[key(x)])[0]
        ]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def line_rows():
    rng = random.Random(9)
    common = [f"a common line number {k} of the set" for k in range(6)]
    rows = [(None, common[0]), (None, None), (1, ""), (2, None), (3, "\n\n"), (3, "\n\n")]
    for i in range(10, 60):
        lines = rng.choices([*common, "short", "", f"only in document {i} and not elsewhere"], k=rng.randint(1, 12))
        lines = [rng.choice([x, f"  {x.upper()}\t", x]) for x in lines]
        rows.append((i, "\n".join(lines)))
    rows += [rows[-1], rows[20]]  # repeated rows
    rows.append((5, "\n".join([common[1]] * 3000 + [f"line {k} of a very long text" for k in range(3000)])))
    return rows


@pytest.mark.parametrize(("n_batches", "fanout"), [(1, 2), (4, 2), (7, 3)])
def test_line_dedup_matches_a_plain_version(spark, n_batches, fanout):
    rows = line_rows()
    docs = spark.createDataFrame([(i, t, "m", "k", 7) for i, t in rows], DOCS)
    out = line_dedup.dedup_lines(docs, n_batches=n_batches, fanout=fanout).collect()
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = Counter((r["doc_id"], digest(r["text"]), r["n_lines"], r["n_dropped"]) for r in out)
    assert got == Counter((i, digest(t), n, d) for i, t, n, d in deduped(rows))
    assert all(r["drop_id"] == 7 for r in out)
    assert sum(r["n_dropped"] for r in out) > 3000


def test_places_of_repeated_rows_are_kept_once(spark, monkeypatch):
    found = []
    whole = line_dedup._without
    monkeypatch.setattr(line_dedup, "_without", lambda docs, per_doc, *a: found.append(per_doc) or whole(docs, per_doc, *a))
    text = "\n".join(f"the long line number {i} of a text" for i in range(5))
    rows = [(1, text)] * 40 + [(None, text)] * 40 + [(2, text), (3, text)]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["n_dropped"]) for r in out) == [(0, 5)] * 40 + [(1, 5)] * 40 + [(2, 5), (3, 0)]
    assert {len(r["places"]) for r in found[0].collect()} == {5}


def test_line_dedup_on_an_empty_table(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], DOCS)).collect() == []


def test_runs_are_compacted_level_by_level(spark):
    runs = line_dedup.LineRuns(2)
    for b in range(4):
        run = spark.createDataFrame([(1, 1, 1, b), (b, 5, 1, b)], "h1 long, h2 long, n_docs long, max_id long")
        runs.add(runs.write(run))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    merged = {(r["h1"], r["h2"]): (r["n_docs"], r["max_id"]) for r in runs.levels[2][0].collect()}
    assert merged[1, 1] == (4, 3) and merged[3, 5] == (1, 3)


def test_runs_are_joined_and_compacted_without_shuffle_or_sort(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with line_dedup.stored_order(spark):
            runs = line_dedup.LineRuns(3)
            stored = []
            for b in range(3):
                keys = [(h, h % 5, 1 + b, 100 - b) for h in range(b, 400, b + 1)]
                run = spark.createDataFrame(keys, "h1 long, h2 long, n_docs long, max_id long")
                stored.append(runs.write(run.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("max_id").alias("max_id"))))
            runs.levels = [stored[:2]]
            claims, merged = runs.claims(stored[2]), runs.merged(*stored[:2])
            plans = [df._jdf.queryExecution().executedPlan().toString() for df in (claims, merged)]
            assert plans[0].count("SortMergeJoin") == 2 and plans[1].count("SortMergeJoin") == 1
            assert not any(re.search(r"Exchange|\bSort ", plan) for plan in plans)
            held = [{h for h in range(b, 400, b + 1)} for b in range(3)]
            assert {r["h1"] for r in claims.collect() if r["claimed"]} == held[2] & (held[0] | held[1])
            for df, n in ((merged, 2), (runs.compacted(stored, 1), 3)):
                want = defaultdict(list)
                for b in range(n):
                    for h in held[b]:
                        want[h].append(b)
                got = {(r["h1"], r["n_docs"], r["max_id"]) for r in df.collect()}
                assert got == {(h, sum(1 + b for b in bs), max(100 - b for b in bs)) for h, bs in want.items()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    runs.forget(spark)
    assert not {t.name for t in spark.catalog.listTables()} & set(runs.tables)

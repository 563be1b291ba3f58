"""SimHash near-duplicates against brute force over all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, reach=2):
    """Smallest position reachable, for each position."""
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    v = np.array(values, dtype=np.uint64)
    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v ^ v[i]) <= reach).tolist():
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def documents():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "one"), (4, "ONE"), (5, "one two"), (6, "É é"), (None, "lost words here"), (None, "one two")]
    for i in range(10, 60):
        base = rng.choices(words, k=rng.choice([5, 80, 600]))
        for c in range(rng.randint(1, 5)):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = "changed"
            rows.append((i * 10 + c, " ".join(copy).upper() if rng.random() < 0.3 else "  ".join(copy)))
    return [*rows, rows[-1], (9999, "long " * 200_000)]


@pytest.mark.parametrize("leaf_size", [4, 2048])
def test_components_match_brute_force(spark, leaf_size):
    rows = documents()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string")
    out = simhash.near_duplicates(df, leaf_size=leaf_size).collect()
    prints = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(prints)
    best = {}
    for (i, _), r in zip(rows, roots, strict=True):
        best[r] = min((x for x in (best.get(r), i) if x is not None), default=None)
    want = sorted(((i, f"{p:016x}", best[r]) for (i, _), p, r in zip(rows, prints, roots, strict=True)), key=str)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in out), key=str) == want


def test_one_document_of_each_component_stays(spark):
    rows = documents()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, keep_id string")
    kept = simhash.keep_one_of_each(df, leaf_size=8)
    assert kept.columns == df.columns
    roots = plain_components([plain_fingerprint(t) for _, t in rows])
    groups = {}
    for (i, _), r in zip(rows, roots, strict=True):
        groups.setdefault(r, []).append(i)
    want = [min((i for i in g if i is not None), default=None) for g in groups.values()]
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(want, key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).collect() == []
    assert simhash.keep_one_of_each(df).collect() == []


def test_tree_visits_every_leaf_in_reach():
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 2**63, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (40, 30), dtype=np.uint64)
    values = np.unique(np.concatenate((centres, (centres[:, None] ^ flips).ravel(), rng.integers(0, 2**63, 500, dtype=np.uint64))))
    tree = simhash.VantageTree(values[::3], 32)
    home = np.full(len(values), -1)
    for leaf, rows in tree.visit(values, 0):
        assert (home[rows] == -1).all()
        home[rows] = leaf
    visited = {(leaf, int(r)) for leaf, rows in tree.visit(values, 2) for r in rows}
    pairs = np.argwhere(np.bitwise_count(values[:, None] ^ values[None, :]) <= 2)
    assert len(pairs) > len(values)
    assert all((home[a], int(b)) in visited for a, b in pairs)
    assert len(visited) < len(values) * 32  # branches were pruned


def test_dense_group_gives_a_forest_not_all_pairs():
    bits = np.uint64(1) << np.arange(12, dtype=np.uint64)
    dense = np.array([np.bitwise_xor.reduce(bits[[i, j]]) for i in range(12) for j in range(i)], dtype=np.uint64)
    dense = np.unique(np.concatenate((dense, bits)))
    a, b = simhash.forest(dense, dense, 0, 2)
    assert len(set(a.tolist())) == 1 and len(b) == len(dense) - 1


def dense_ball(n):
    """Distinct fingerprints of one template: few bits away from each other."""
    rng = np.random.default_rng(5)
    bits = np.uint64(1) << rng.integers(0, 64, (4 * n, 3), dtype=np.uint64)
    return np.unique(np.bitwise_or.reduce(bits, axis=1))[:n]


def test_groups_of_a_dense_ball_are_bounded_on_both_sides(spark):
    values = dense_ball(1500)
    reached = spark.createDataFrame([(0, True, int(v.view(np.int64)), 0) for v in values], "leaf int, home boolean, fp long, sub int")
    groups = simhash.dealt_groups(reached, 100, 200).groupBy("leaf", "sub", "block", "piece")
    sizes = groups.agg(F.count_if("home").alias("homes"), F.count_if(~F.col("home")).alias("queries")).collect()
    assert max(r["homes"] for r in sizes) < 200 and max(r["queries"] for r in sizes) < 400
    # every pair of rows meets
    assert sum(r["homes"] * r["queries"] for r in sizes) == len(values) ** 2


def test_leaves_grow_beyond_the_first_tree_and_lose_no_link(spark):
    rng = np.random.default_rng(6)
    centres = rng.integers(0, 2**64, 120, dtype=np.uint64)
    near = centres[:, None] ^ (np.uint64(1) << rng.integers(0, 64, (120, 5), dtype=np.uint64))
    values = np.unique(np.concatenate((dense_ball(300), centres, near.ravel(), rng.integers(0, 2**64, 400, dtype=np.uint64))))
    fps = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    # two leaves in the first tree
    edges = simhash.links(fps, 2, 8, 64, len(values), piece_size=50).collect()
    place = {int(v): i for i, v in enumerate(values.view(np.int64))}
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for r in edges:
        a, b = find(place[r["a"]]), find(place[r["b"]])
        parent[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(values))] == plain_components(values)
    reached = spark.createDataFrame([(0, True, int(v)) for v in values.view(np.int64)], "leaf int, home boolean, fp long")
    subs = simhash.split_leaves(reached, 2, 100, 2048, 300)
    assert subs.where("home").count() == len(values) and subs.select("sub").distinct().count() > 4


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001), (7, 3)], "a long, b long")
    got = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1001: 1000}

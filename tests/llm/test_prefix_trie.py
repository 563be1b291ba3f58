"""The conversation trie against nodes counted one by one."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import prefix_trie

SCHEMA = "conv_id long, turn int, role string, text string"


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0, key), (role, text)))
    own = {c: [t for _, t in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - int(np.fmod(c, 100)), [])[:h] + turns[h:]
    return out


def plain(rows):
    nodes = defaultdict(list)
    built = rebuilt(rows)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    out = []
    for key, convs in nodes.items():
        d = len(key)
        inside = [k for k in nodes if k[:d] == key]
        ends = ",".join(map(str, sorted(c for c in convs if len(built[c]) == d)))
        out.append((
            min(convs), d, min(nodes[key[:-1]]) if d else None, len(convs), sum(len(k) == d + 1 for k in inside),
            sum(not any(len(j) == len(k) + 1 and j[: len(k)] == k for j in nodes) for k in inside),
            sum((len(nodes[k]) - 1) * len(k[-1][1]) for k in inside if k), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def fixture():
    rng = random.Random(11)
    texts = ["", "hi", "wie geht's", "ünter\n", None, "yes " * 5]
    rows = []
    for c in [*range(0, 40), *range(95, 130), 207, 350, -3, -100, 12345678901]:
        for t in range(rng.choice([1, 1, 2, 3, 5, 7, 9])):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(texts)))
    for c in range(400, 440):  # copies of one conversation
        rows += [(c, t, "user", "same") for t in range(8)]
    for c in (500, 501, 502):  # deeper than a block of columns, parting late
        rows += [(c, t, "user", f"turn {t}" if t < 140 or c == 500 else f"{c} {t}") for t in range(150)]
    rows += [(None, 0, "user", "nobody"), (7, None, "system", "first"), (7, 1, "user", "tie a"), (7, 1, "user", "tie b")]
    rows += rows[:3] + [(600, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("per_shard", [prefix_trie.TURNS_PER_SHARD, 40, 9])
def test_equals_counted_nodes(spark, per_shard):
    rows = fixture()
    turns = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = prefix_trie.conversation_trie(turns, turns_per_shard=per_shard)
    assert Counter(tuple(r) for r in out.collect()) == Counter(plain(rows))


def test_the_root_holds_turnless_conversations(spark):
    absent = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(absent, 0, "user", "x"), (absent, 1, "user", "y")]
    out = prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [tuple(r) for r in out] == plain(rows) and out[0]["depth"] == 0 and out[0]["n_leaves"] == 1


def test_other_columns_and_empty_tables(spark):
    rows = [(1, 0, "user", "a", "x", 5), (2, 0, "user", "a", None, 6)]
    turns = spark.createDataFrame(rows, SCHEMA + ", path string, depth int")
    assert Counter(tuple(r) for r in prefix_trie.conversation_trie(turns).collect()) == Counter(plain(rows))
    assert prefix_trie.conversation_trie(turns.limit(0)).collect() == []
    assert prefix_trie.conversation_trie(turns.selectExpr("null conv_id", "turn", "role", "text")).collect() == []


def test_very_long_texts(spark):
    rows = [(0, 0, "user", "x" * 5_000_000), (0, 1, "user", "b"), (1, 0, "user", "x" * 5_000_000), (1, 1, "user", "c")]
    out = prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter(tuple(r) for r in out) == Counter(plain(rows))


def test_borders_share_the_turns_of_their_neighbours():
    a, b, c = (bytes([n]) * 16 for n in (1, 2, 3))
    borders = prefix_trie.Borders([(4, a, a + b), (6, a + b + a, a + b + b), (9, a + b + b, a + b + b), (11, c, c)])
    assert [borders.spans(s) for s in (4, 6, 9, 11)] == [(-1, 2), (2, 3), (3, 0), (0, -1)]
    assert borders.starts(9, 3) == [0, 0, 0, 1] and borders.starts(4, -1) == []
    parted = prefix_trie.Borders([(0, a, a), (1, a, b), (2, b, b + a)])  # the shard between ends one node and starts another
    assert parted.starts(2, 1) == [0, 1]

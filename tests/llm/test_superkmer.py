"""Super-k-mer de-duplication against a plain table of all windows."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import superkmer

LEAST = -(2**63)


def plain(rows, k=20):
    cut = [(LEAST if i is None else i, (text or "").encode().split()) for i, text in rows]
    first = {}
    for i, words in cut:
        for at in range(len(words) - k + 1):
            window = tuple(words[at : at + k])
            first[window] = min(first.get(window, (i, at)), (i, at))
    out = []
    for (doc_id, _), (i, words) in zip(rows, cut, strict=True):
        gone = set()
        for at in range(len(words) - k + 1):
            if first[tuple(words[at : at + k])] < (i, at):
                gone |= set(range(at, at + k))
        kept = b" ".join(w for p, w in enumerate(words) if p not in gone).decode()
        out.append((doc_id, len(words), len(gone), kept))
    return out


def fixture():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(25)] + ["ünter", " ", "longer-than-eight-bytes", "longer-than-eight-bytEs"]

    def some(n):
        return " ".join(rng.choices(vocabulary, k=n))

    passages = [some(60), some(25), some(20)]
    rows = [(None, passages[0]), (None, passages[0]), (3, None), (4, ""), (5, " \n\x0b "), (6, "a " * 300), (7, "a " * 60)]
    rows += [(8, passages[2]), (9, passages[2] + " x"), (9, "y " + passages[2]), (-5, passages[1])]
    for i in range(10, 60):
        text = some(rng.randint(0, 50))
        for _ in range(rng.randint(0, 2)):
            p, a = rng.choice(passages).split(" "), rng.randint(0, 5)
            text += rng.choice([" ", "\n\t"]) + " ".join(p[a:]) + " " + some(rng.randint(0, 30))
        rows.append((i, text))
    rows += rows[30:33]
    rows += [(100 + i, f"{some(3)} {passages[0]} {some(3)}") for i in range(40)]  # one passage, other surroundings
    rows.append((200, " ".join([passages[1], some(3000)] * 3)))
    return rows


@pytest.mark.parametrize(("bucket_bytes", "chunk_bytes"), [(2 << 20, 4 << 20), (300, 700)])
def test_equals_the_plain_version(spark, monkeypatch, bucket_bytes, chunk_bytes):
    """The second case has hundreds of buckets, hot minimisers and chunks of a few documents."""
    monkeypatch.setattr(superkmer, "CHUNK_BYTES", chunk_bytes)
    rows = fixture()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = superkmer.dedup_windows(docs, bucket_bytes=bucket_bytes).select("doc_id", "n_words", "n_removed", "text")
    assert Counter(tuple(r) for r in out.collect()) == Counter(plain(rows))


def test_other_window_lengths(spark):
    rows = fixture()[:40]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for window, gram in ((1, 1), (5, 5), (7, 2)):
        out = superkmer.dedup_windows(docs, window=window, gram=gram).select("doc_id", "n_words", "n_removed", "text")
        assert Counter(tuple(r) for r in out.collect()) == Counter(plain(rows, window))
    with pytest.raises(ValueError):
        superkmer.dedup_windows(docs, window=3, gram=4)


def test_extra_and_clashing_columns_and_empty_tables(spark):
    rows = [(2, "b " * 25, "l", 7, 1, ["z"]), (1, "b " * 20, None, 8, 2, None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string, N_Words int, dup_id int, spans array<string>")
    out = superkmer.dedup_windows(docs)
    assert [c.lower() for c in out.columns] == ["doc_id", "text", "lang", "n_words", "dup_id", "spans", "n_removed"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[1]["text"] == " ".join("b" * 20) and got[1]["n_removed"] == 0 and got[1]["spans"] is None
    assert got[2]["n_removed"] == 25 and got[2]["n_words"] == 25 and got[2]["dup_id"] == 1 and got[2]["spans"] == ["z"]
    assert superkmer.dedup_windows(docs.limit(0)).collect() == []


def test_runs_cover_every_window_once_and_share_the_minimiser():
    rng = random.Random(5)
    strings = [" ".join(rng.choices("abcdefghij", k=n)).encode() for n in (3, 20, 200, 21, 9000)]
    strings.insert(2, b"")
    words = superkmer.Words(strings)
    at, n, _ = superkmer.cut_runs(words, 20, 4, np.zeros(0, np.uint64))
    covered = np.concatenate([np.arange(a, a + k) for a, k in zip(at, n, strict=True)])
    assert sorted(covered) == words.window_starts(20).tolist() and n.max() <= superkmer.LONGEST_RUN
    one = superkmer.Words([b" ".join([b"a"] * 20000)])
    assert superkmer.cut_runs(one, 20, 4, np.zeros(0, np.uint64))[1].max() == superkmer.LONGEST_RUN


def test_a_very_long_text(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    text = passage + " " + " ".join(f"q{i}" for i in range(1_500_000)) + " " + passage
    docs = spark.createDataFrame([(1, text), (2, "s " + passage)], "doc_id long, text string")
    out = {r[0]: r[1:] for r in superkmer.dedup_windows(docs).select("doc_id", "n_words", "n_removed").collect()}
    assert out == {1: (1_500_100, 50), 2: (51, 50)}


def test_equal_hashes_are_compared_word_for_word(monkeypatch):
    """With every hash equal, the words alone decide."""
    monkeypatch.setattr(superkmer.Words, "hashes", lambda self: np.zeros(len(self.ends), np.uint64))
    runs = [b"a b c", b"a b d", b"b c", b"x a b"]
    places = np.array([[1, 2, 3, 4], [0, 0, 0, 0], [0, 5, 9, 2], [2, 2, 1, 2]])
    spans = superkmer.settle(runs, places, 2)
    assert sorted(map(tuple, spans.T.tolist())) == [(2, 0, 5, 1), (3, 0, 9, 1), (4, 0, 3, 1)]

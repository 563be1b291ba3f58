"""Language identification (gradients, held-out accuracy) and packing (exact round trip with the tokenizer)."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import langid, packing

SMOKE = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def test_gradients_match_differences():
    model = langid.ByteGru(["x", "y", "z"], hidden=4)
    rng = np.random.default_rng(0)
    x, y = rng.integers(60, 130, (9, 5)).astype(np.uint8), np.array([0, 1, 2, 1, 0])
    _, g = model.gradients(x, y)
    for name, grad in g.items():
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        kept, losses = model.w[name][at], []
        for step in (0.01, -0.01):
            model.w[name][at] = kept + step
            losses.append(model.gradients(x, y)[0])
        model.w[name][at] = kept
        assert (losses[0] - losses[1]) / 0.02 == pytest.approx(grad[at], rel=0.02, abs=1e-5)


def test_long_texts_pool_all_their_stretches():
    model = langid.ByteGru(["x", "y"])
    text = "Grüße an alle, und so weiter. " * 5000
    whole = model.document_probabilities([text, None, "", "..."])
    x = np.frombuffer(text.encode().ljust(-(-len(text.encode()) // 64) * 64, b"\0"), np.uint8).reshape(-1, 64)
    p, weight = model.probabilities(np.ascontiguousarray(x.T)), langid.LETTER[x.T]
    assert whole[0] == pytest.approx((p * weight[:, None, :]).sum(axis=(0, 2)) / weight.sum(), abs=1e-5)
    assert (whole[1:] == 0).all()


def test_held_out_accuracy_and_odd_rows(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text", "lang")
    odd = [(None, "the and of that", "en"), (-1, None, "en"), (-2, "", "de"), (-3, "12 !! 34", None), (-4, "de la", None)]
    both = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    out = langid.identify(both).collect()
    assert len(out) == docs.count() + len(odd)
    by_id = {r["doc_id"]: r for r in out}
    assert [by_id[i]["lang_pred"] for i in (-1, -2, -3)] == ["und"] * 3 and by_id[-3]["score"] == 0.0
    assert by_id[None]["held_out"] is False and 0 < by_id[-4]["score"] <= 1
    tested = [r for r in out if r["doc_id"] is not None and r["doc_id"] >= 0]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in tested)
    held = [r for r in tested if r["held_out"]]
    assert len(held) > 30 and np.mean([r["lang"] == r["lang_pred"] for r in held]) >= 0.95


def test_prediction_ignores_everything_but_the_text(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.train_model(docs, steps=60)
    rows = [(1, "the and", "x", 0.5, "de"), (2, "the and", "y", None, None), (2, "the and", "y", None, None)]
    out = langid.predict(spark.createDataFrame(rows, "id long, text string, lang_pred string, score double, lang string"), model)
    assert out.columns == ["id", "text", "lang", "lang_pred", "score"]
    assert len({(r["lang_pred"], r["score"]) for r in out.collect()}) == 1


def test_repeated_ids_do_not_change_the_bound(spark, monkeypatch):
    learned = []
    monkeypatch.setattr(langid.ByteGru, "train", lambda self, x, y, steps: learned.append((self.langs, x, y)))
    free = [r["id"] for r in spark.range(200).where(~langid.held_out(F.col("id"))).collect()]
    rows = [(free[0], f"one id, text number {i}", "en") for i in range(3000)]  # all drawn or none by id alone
    rows += [(free[1], "ein text, immer wieder", "de")] * 3000 + [(i, f"texte numero {i}", "fr") for i in free[2:]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langid.train_model(docs, sample_per_lang=100)
    langs, x, y = learned[0]
    taken = {lang: len(np.unique(x[y == k], axis=0)) for k, lang in enumerate(langs)}
    assert taken == {"de": 1, "en": 100, "fr": 100}


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [(r["lang_pred"], r["score"]) for r in langid.identify(df).collect()] == [("und", 0.0)]
    assert langid.identify(df.limit(0)).collect() == []


def test_piece_lengths():
    for n in range(1, 5000, 7):
        pieces = packing.piece_lengths(n, 2048)
        assert sum(pieces) == n and all(p & (p - 1) == 0 and p <= 2048 for p in pieces)
        assert [p for p in pieces if p < 2048] == sorted({p for p in pieces if p < 2048}, reverse=True)


ODD = [
    "It's $5.99—naïve don't.stop 'll we'll 'S ABC's x'y <|endoftext|> Q <|STARTOFTEXT|>",
    "ΣΑΣ. ﬁ Ⅷ ² é é\u0085a b c ẞ İstanbul x́.",
    "",
    " \t\n",
    "\x1cfoo\x1dbar",
    "a'b.'s,'re ...'ve $'s 's' 12'34 don’t",
    "日本語。テキスト 🙂🙂 a🙂b",
    "word " * 30_000,
]


def test_cached_ids_equal_the_tokenizers():
    plain, coder = Tokenizer.from_file(TOKENIZER), packing.ChunkTokenizer(TOKENIZER)
    for _ in range(2):  # unknown, then remembered
        for text, ids in zip(ODD, coder.ids(ODD), strict=True):
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids


def test_full_memory_still_gives_the_ids():
    plain, coder = Tokenizer.from_file(TOKENIZER), packing.ChunkTokenizer(TOKENIZER, cache=4)
    for text in ["one two", "three four five", "one two three", "one six", "one two"]:
        assert coder.ids([text])[0].tolist() == plain.encode(text, add_special_tokens=False).ids
        assert len(coder.young) <= 2 and len(coder.old) <= 2


def test_chunks_in_use_outlive_rare_ones():
    coder = packing.ChunkTokenizer(TOKENIZER, cache=20)
    for i in range(50):
        coder.ids([f"common {chr(97 + i % 26)}{chr(97 + i // 26)}x"])
        assert b"common" in coder.young or b"common" in coder.old


def test_letters_that_are_no_chain_of_their_own_take_a_call_each():
    """A tokenizer whose chains do not match the chunks still gives its own ids."""
    plain, coder = Tokenizer.from_file(TOKENIZER), packing.ChunkTokenizer(TOKENIZER)
    coder.ends[:] = False
    text = "some plain words\u00e9 and more"
    assert coder.ids([text])[0].tolist() == plain.encode(text, add_special_tokens=False).ids


def test_pieces_rebuild_every_document(spark):
    rows = [(i, t, "s", 1) for i, t in enumerate([None, *ODD])] + [(None, "no id", "s", 1), (3, ODD[2], "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string, length int")
    out = packing.pack(df, TOKENIZER).collect()
    plain = Tokenizer.from_file(TOKENIZER)
    assert len({r["sequence_id"] for r in out}) == len(out) and all(r["offset"] == 0 for r in out)
    once = {}
    for r in out:
        assert r["length"] & (r["length"] - 1) == 0 and len(r["tokens"]) == r["length"] <= 2048
        assert r["ids_crc32"] == zlib.crc32(np.array(r["tokens"], "<u4").tobytes())
        once.setdefault((r["doc_id"], r["start"]), r["tokens"])
    for i, text, *_ in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        parts = sorted((s, t) for (d, s), t in once.items() if d == i)
        assert [x for _, t in parts for x in t] == ids
        assert all(r["doc_tokens"] == len(ids) for r in out if r["doc_id"] == i)
    assert sum(r["doc_id"] == 3 for r in out) == 2  # repeated rows are packed each
    assert packing.pack(df.limit(0), TOKENIZER).collect() == []


def test_buckets_are_folders_of_one_length(spark, scratch_dir):
    df = spark.createDataFrame([(1, "a b c d"), (2, "a b")], "doc_id long, text string")
    packing.write_buckets(packing.pack(df, TOKENIZER), f"{scratch_dir}/out")
    stored = spark.read.parquet(f"{scratch_dir}/out")
    assert {(r["length"], len(r["tokens"])) for r in stored.collect()} == {(4, 4), (1, 1), (2, 2)}


def test_thousands_of_labels_are_bounded(spark):
    rows = [(i, f"text number {i} of the label", f"l{i % 2000:04d}" if i % 3 else "common") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train_model(docs, steps=1, max_langs=5)
    assert "common" in model.langs and len(model.langs) == 5
    assert len(langid.train_model(docs, steps=1, sample_per_lang=2, max_langs=1500).langs) == 1500

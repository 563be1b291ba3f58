"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads UTF-8 bytes. A text is cut into stretches of ``STRETCH`` bytes; two gated recurrent layers run over
each stretch, one from either end, and a softmax over both states labels every byte with language probabilities. A
document's probabilities are the mean over the bytes of all its letters, from the first stretch to the last.

Training is numpy code: backpropagation through time over the stretches and Adam, for a fixed number of steps, on a
bounded sample of labelled rows (``sample_per_lang`` of each language, chosen by hash; of each a stretch of
``sample_chars`` characters at a hashed place). The held-out rows are never drawn. Prediction sees nothing but the text.

Scale: training reads the labelled texts once and costs the same for any corpus. Prediction is one pass without a
shuffle; a worker runs all stretches of its batch side by side, in blocks of ``BLOCK`` stretches, so memory does not
grow with a text's length beyond the text itself, and a lost task is simply run again with the same weights.

Defined cases: null text or one without letters is ``und`` with score 0. With no labelled rows nothing is learned and
every text is ``und``. A null id is not held out and not learned from. Repeated rows get equal predictions. Other
columns pass through; input columns named as results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

UNKNOWN = "und"
STRETCH = 64
BLOCK = 4096
HIDDEN = 8
LETTER = np.zeros(256, np.float32)
LETTER[list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = 1


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training: crc32 of its id as text, modulo 4, is 2. False for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class ByteGru:
    """Weights of both directions. ``table`` has the input part of all gates per byte (update, reset, candidate)."""

    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 11):
        r = np.random.default_rng(seed)
        self.langs, self.hidden = langs, hidden
        self.w = {"out": r.normal(0, 0.1, (len(langs), 2 * hidden)), "bias": np.zeros((len(langs), 1))}
        for d in "fb":
            self.w["table" + d] = r.normal(0, 0.3, (3 * hidden, 256))
            self.w["u" + d] = r.normal(0, hidden**-0.5, (3 * hidden, hidden))
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def states(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """Hidden states (time, hidden, batch) for bytes (time, batch); ``keep`` gets what the way back needs."""
        n, h = self.hidden, np.zeros((self.hidden, x.shape[1]), np.float32)
        table, u = self.w["table" + d], self.w["u" + d]
        out = np.empty((len(x), n, x.shape[1]), np.float32)
        half = np.float32(0.5)
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            a = np.take(table, x[t], axis=1)
            b = u @ h
            gates = a[: 2 * n]
            gates += b[: 2 * n]
            gates *= half
            np.tanh(gates, out=gates)
            gates *= half
            gates += half
            z, reset = gates[:n], gates[n:]
            cand = a[2 * n :]
            cand += reset * b[2 * n :]
            np.tanh(cand, out=cand)
            if keep is not None:
                keep.append((t, z, reset, cand, b[2 * n :], h))
            h = np.subtract(h, cand, out=out[t])
            h *= z
            h += cand
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(time, languages, batch)"""
        w = self.w["out"]
        n = self.hidden
        p = np.matmul(w[:, :n], self.states(x, "f"))
        p += np.matmul(w[:, n:], self.states(x, "b"))
        p += self.w["bias"]
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over the letters of stretches ``x`` with languages ``y``, and its gradients."""
        n, kept = self.hidden, {"f": [], "b": []}
        s = {d: self.states(x, d, kept[d]) for d in "fb"}
        both = np.concatenate((s["f"], s["b"]), axis=1)
        p = np.matmul(self.w["out"], both) + self.w["bias"]
        p -= p.max(axis=1, keepdims=True)
        p = np.exp(p)
        p /= p.sum(axis=1, keepdims=True)
        weight = LETTER[x]
        total = max(1.0, float(weight.sum()))
        columns = np.arange(x.shape[1])
        loss = -float((np.log(p[:, y, columns] + 1e-9) * weight).sum()) / total
        p[:, y, columns] -= 1
        dp = p * weight[:, None, :] / np.float32(total)
        g = {"out": np.einsum("tlb,thb->lh", dp, both), "bias": dp.sum(axis=(0, 2))[:, None]}
        dboth = np.matmul(self.w["out"].T, dp)
        for d, half in (("f", dboth[:, :n]), ("b", dboth[:, n:])):
            u = self.w["u" + d]
            da = np.empty((len(x), 3 * n, x.shape[1]), np.float32)
            du = np.zeros_like(u)
            back = np.zeros((n, x.shape[1]), np.float32)
            for t, z, reset, cand, mixed, before in reversed(kept[d]):
                dh = half[t] + back
                dc = dh * (1 - z) * (1 - cand * cand)
                a = da[t]
                a[:n] = dh * (before - cand) * z * (1 - z)
                a[n : 2 * n] = dc * mixed * reset * (1 - reset)
                a[2 * n :] = dc
                through = np.concatenate((a[: 2 * n], dc * reset))
                du += through @ before.T
                back = dh * z + u.T @ through
            flat, bytes_ = da.transpose(1, 0, 2).reshape(3 * n, -1), x.ravel()
            g["table" + d] = np.stack([np.bincount(bytes_, row, 256) for row in flat]).astype(np.float32)
            g["u" + d] = du
        return loss, g

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = 400, batch: int = 128, rate: float = 0.02) -> float:
        """Adam over random batches of the stretches ``x`` (rows) with language numbers ``y``; the last mean loss."""
        r = np.random.default_rng(5)
        mean = {k: np.zeros_like(v) for k, v in self.w.items()}
        square = {k: np.zeros_like(v) for k, v in self.w.items()}
        losses = []
        for step in range(1, steps + 1):
            rows = r.integers(len(x), size=min(batch, len(x)))
            loss, g = self.gradients(np.ascontiguousarray(x[rows].T), y[rows])
            losses.append(loss)
            norm = max(1.0, float(np.sqrt(sum(float((v * v).sum()) for v in g.values()))))
            now = rate * (1 - step / (steps + 1))
            for k, v in g.items():
                v = v / norm
                mean[k] = 0.9 * mean[k] + 0.1 * v
                square[k] = 0.99 * square[k] + 0.01 * v * v
                change = now * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
                self.w[k] = (self.w[k] - change).astype(np.float32)
        return float(np.mean(losses[-20:]))

    def document_probabilities(self, texts: list[str | None]) -> np.ndarray:
        """(documents, languages): the mean over the bytes of letters; zeros where there are none."""
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        pieces = np.array([-(-len(b) // STRETCH) for b in raw], np.int64)
        sums = np.zeros((len(raw), len(self.langs) + 1))
        # stretches of all documents, in blocks; a document may span blocks
        owner = np.repeat(np.arange(len(raw)), pieces)
        joined = b"".join(b.ljust(-(-len(b) // STRETCH) * STRETCH, b"\0") for b in raw)
        stretches = np.frombuffer(joined, np.uint8).reshape(-1, STRETCH)
        for at in range(0, len(stretches), BLOCK):
            x = np.ascontiguousarray(stretches[at : at + BLOCK].T)
            weight = LETTER[x]
            pooled = np.einsum("tlb,tb->bl", self.probabilities(x), weight)
            mine = owner[at : at + BLOCK]
            for k in range(len(self.langs)):
                sums[:, k] += np.bincount(mine, pooled[:, k], len(raw))
            sums[:, -1] += np.bincount(mine, weight.sum(axis=0), len(raw))
        return sums[:, :-1] / np.maximum(sums[:, -1:], 1)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def train_model(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_per_lang: int = 1000,
    sample_chars: int = 512,
    steps: int = 400,
    max_langs: int = 200,
) -> ByteGru | None:
    """Learn from a bounded sample of the labelled rows that are not held out; None if there are none.

    Of more than ``max_langs`` labels the commonest are learned, equally common ones in alphabetical order.
    """
    usable = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        F.col("lang").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id")) & (F.length("text") > 0)
    )
    # rows are drawn by a hash of id and text; rows that share both count once
    usable = usable.withColumn("draw", F.xxhash64("id", "text"))
    common = usable.groupBy("lang").agg(F.approx_count_distinct("draw").alias("n")).orderBy(F.desc("n"), "lang").limit(max_langs)
    counts = {r["lang"]: r["n"] for r in common.collect()}
    if not counts:
        return None
    langs = sorted(counts)
    # about twice the rows wanted, of which the first by hash are taken
    shares = [(lang, min(1.0, 2 * (sample_per_lang + 50) / n)) for lang, n in counts.items()]
    table = docs.sparkSession.createDataFrame(shares, "lang string, share double")
    place = 1 + F.pmod(F.xxhash64(F.lit("place"), "id"), F.greatest(F.length("text") - sample_chars, F.lit(0)) + 1)
    shared = usable.join(F.broadcast(table), "lang")  # at most max_langs rows
    near = shared.where(F.pmod(F.col("draw"), F.lit(1_000_003)) < F.col("share") * 1_000_003).select(
        "id", "lang", "draw", F.substring(F.col("text"), place.cast("int"), F.lit(sample_chars)).alias("text")
    )
    by_hash = Window.partitionBy("lang").orderBy("draw", "id", "text")
    drawn = near.distinct().withColumn("n", F.row_number().over(by_hash)).where(F.col("n") <= sample_per_lang)
    rows = sorted((r["lang"], r["id"], r["text"]) for r in drawn.collect())
    x, y = [], []
    for lang, _, text in rows:
        raw = text.encode("utf-8", "surrogatepass")
        for at in range(0, len(raw), STRETCH):
            x.append(raw[at : at + STRETCH].ljust(STRETCH, b"\0"))
            y.append(langs.index(lang))
    if not x:
        return None
    model = ByteGru(langs)
    order = np.concatenate([np.resize(np.flatnonzero(np.array(y) == k), len(x)) for k in set(y)])  # languages weigh alike
    bytes_ = np.frombuffer(b"".join(x), np.uint8).reshape(-1, STRETCH)
    model.train(bytes_[order], np.array(y)[order], steps)
    return model


def predict(docs: DataFrame, model: ByteGru | None, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score``."""
    rest = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    docs = docs.select(*rest)
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [t if isinstance(t, str) else None for t in pdf[text_col]]
            p = model.document_probabilities(texts)
            best = p.argmax(axis=1) if len(p) else np.zeros(0, int)
            known = [has_letter(t) for t in texts]
            out = pdf.copy()
            out["lang_pred"] = [model.langs[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)]
            out["score"] = [min(1.0, float(row[k])) if ok else 0.0 for row, k, ok in zip(p, best, known, strict=True)]
            yield out

    schema = StructType(
        [*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    )
    return docs.mapInPandas(run, schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """Train on ``docs`` and predict every row: ``docs`` plus ``held_out``, ``lang_pred`` and ``score``."""
    model = train_model(docs, id_col, text_col, lang_col, **options)
    return predict(docs, model, text_col).withColumn("held_out", held_out(F.col(id_col)))

"""Ranked lexical search over hashed max-sketches.

A document's score for an item sums, over the item's terms with repeats, weight x impact. The impact of a term grows with
its occurrences in the document and is the same for every query.

1. Index, one row per document, in the shared folder: its terms with occurrences, and a sketch: a row of bytes, eight to
   sixteen for each distinct term, in which every term's occurrences fold into the byte of its hash by maximum. For a fixed
   length the impact rises with the occurrences, so these are the coordinatewise maxima of the impacts. 255 stands for any
   greater number, whose impact is bounded by its limit.
2. Counts over all documents: N, total length, and the document frequency of each item term.
3. Lookup. A batch of documents looks the terms of a block of items up in its sketches; the looked-up impacts times the
   items' weights, one matrix product, are upper bounds of all scores (a term's byte holds at least its own occurrences).
4. Rescoring. For each item the batch takes its documents by descending bound and scores them exactly from their terms,
   until the bound falls below the k-th best exact score that the task has met. Only these documents' terms are decoded.
5. Each task's best k per item meet in one ranking.

Scale: no term of a document is shuffled but in the counts, where tasks count first. The sent queries are bounded: a block
has about ``block_terms`` terms (one item's terms at least), and a pass over the index takes BLOCKS_PER_PASS blocks. Scores are whole numbers below 2^53 as long as an
item has fewer than 300,000 terms, so the bounds are exact in doubles; beyond that they are raised by a part in 10^9.

Defined cases: null, empty and termless texts are no documents for N and score nothing; a null or termless item has no
rows. Each row of the items is an item and each row of the documents a document, repeated or not; rows that tie by score
and id take following ranks. A null document id sorts last. Very long texts have longer sketches. Extra columns are not
read, and output names are fixed. Empty tables give an empty table.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import store

LIMIT = 1_000_000  # an impact's upper limit
BLOCK_TERMS = 1 << 13
BLOCKS_PER_PASS = 32
VOCABULARY_BROADCAST_BYTES = 8 << 20
CHUNK_BYTES = 4 << 20
CHUNK_DOCS = 256
# lower-case A-Z; a space for all ASCII that is no letter or digit
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

INDEX = "doc_id long, n long, terms array<string>, counts array<int>, sketch binary"


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TABLE).split()


def term_hashes(terms: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh32_intdigest, terms), np.int64, len(terms))


def sketch_of(terms: list[bytes], counts: np.ndarray) -> bytes:
    """The occurrences folded by maximum into 8 to 16 bytes for each term."""
    out = np.zeros(1 << (8 * len(terms) - 1).bit_length(), np.uint8)
    np.maximum.at(out, term_hashes(terms) & (len(out) - 1), np.minimum(counts, 255).astype(np.uint8))
    return out.tobytes()


def impacts(occurrences: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * occurrences) // (1000 * occurrences + 12 * m)


def index_documents(docs: DataFrame) -> DataFrame:
    """The index of the documents (doc_id, text) that have a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in INDEX.split(", ")]
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary())
            rows, size = [], 0
            for row in range(len(texts)):
                found = terms_of(texts[row].as_py())
                if found:
                    counted = Counter(found)
                    terms, counts = list(counted), np.fromiter(counted.values(), np.int64, len(counted))
                    rows.append((ids[row].as_py(), len(found), terms, counts, sketch_of(terms, counts)))
                    size += len(texts[row].as_buffer())
                if rows and (size >= CHUNK_BYTES or row == len(texts) - 1):
                    doc_id, n, terms, counts, sketch = zip(*rows, strict=True)
                    ends = np.concatenate(([0], np.cumsum([len(t) for t in terms]))).astype(np.int32)
                    flat = pa.array([t for some in terms for t in some], pa.binary()).cast(pa.string())
                    columns = [
                        pa.array(doc_id, pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.ListArray.from_arrays(ends, flat),
                        pa.ListArray.from_arrays(ends, pa.array(np.concatenate(counts), pa.int32())),
                        pa.array(sketch, pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names)
                    rows, size = [], 0

    return docs.mapInArrow(run, INDEX)


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, term, repeats): the distinct terms of each row of the items."""

    @F.arrow_udf("array<string>")
    def cut(texts: pa.Array) -> pa.Array:
        raw = texts.cast(pa.binary()).to_pylist()
        return pa.array([[t.decode("utf-8", "replace") for t in terms_of(x)] for x in raw], pa.list_(pa.string()))

    exploded = items.select("item", "item_id", F.explode(cut("text")).alias("term"))
    return exploded.groupBy("item", "item_id", "term").agg(F.count("*").alias("repeats"))


def document_frequencies(index: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(term, df) of the vocabulary's terms that occur. A small vocabulary is broadcast and filters the terms first."""
    size = vocabulary.agg(F.coalesce(F.sum(F.octet_length("term") + 32), F.lit(0))).first()[0]
    found = index.select(F.explode("terms").alias("term"))
    if size <= VOCABULARY_BROADCAST_BYTES:
        return found.join(F.broadcast(vocabulary), "term").groupBy("term").agg(F.count("*").alias("df"))
    return found.groupBy("term").agg(F.count("*").alias("df")).join(vocabulary, "term", "left_semi")


class Queries:
    """A block of items: their distinct terms, and each item's terms with weight times repeats."""

    def __init__(self, rows: list[tuple[int, str, int, int]], n_docs: int):
        """``rows``: item, term, repeats, document frequency."""
        self.terms = sorted({r[1].encode() for r in rows})
        place = {t: k for k, t in enumerate(self.terms)}
        self.items = sorted({r[0] for r in rows})
        column = {x: k for k, x in enumerate(self.items)}
        self.hashes = term_hashes(self.terms)
        self.of: list[dict[bytes, int]] = [{} for _ in self.items]
        self.at, self.col, self.weight = (np.zeros(len(rows), np.int64) for _ in range(3))
        for k, (item, term, repeats, df) in enumerate(rows):
            w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * repeats
            self.of[column[item]][term.encode()] = w
            self.at[k], self.col[k], self.weight[k] = place[term.encode()], column[item], w

    def matrix(self) -> np.ndarray:
        out = np.zeros((len(self.terms), len(self.items)))
        out[self.at, self.col] = self.weight
        return out


def upper_bounds(sketches: list[np.ndarray], m: np.ndarray, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Documents x items: no exact score is above its bound."""
    table = impacts(np.arange(255)[None, :], m[:, None])
    table = np.column_stack([table, np.full(len(m), LIMIT)]).astype(np.float64)
    looked = np.empty((len(m), len(hashes)))
    for row, sketch in enumerate(sketches):
        looked[row] = table[row][sketch[hashes & (len(sketch) - 1)]]
    bounds = looked @ weights
    return np.where(bounds < 2.0**53, bounds, bounds * (1 + 1e-9))


class Best:
    """The k best (score, id) of one item; a heap whose top is the worst of them."""

    def __init__(self, k: int):
        self.k, self.heap, self.met = k, [], 0

    def may_enter(self, score: float, rank_id: int) -> bool:
        return len(self.heap) < self.k or (score, -rank_id) >= self.heap[0][:2]

    def add(self, score: int, rank_id: int) -> None:
        self.met += 1
        entry = (score, -rank_id, self.met)
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, entry)
        else:
            heapq.heappushpop(self.heap, entry)


NULL_ID = 2**63  # sorts after all ids


def search(index: DataFrame, blocks: list[Queries], n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score): of each task the k best documents of each item of the blocks, in one pass over the index."""
    told = index.sparkSession.sparkContext.broadcast(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = told.value
        best = [[Best(k) for _ in block.items] for block in blocks]
        for batch in batches:
            for block, tops in zip(blocks, best, strict=True):
                weights = block.matrix()
                for lo in range(0, batch.num_rows, CHUNK_DOCS):
                    rescore(batch.slice(lo, CHUNK_DOCS), block, weights, tops)
        rows = [
            (x, None if i == -NULL_ID else -i, s)
            for block, tops in zip(blocks, best, strict=True)
            for x, top in zip(block.items, tops, strict=True)
            for s, i, _ in top.heap
        ]
        if rows:
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    def rescore(docs: pa.RecordBatch, queries: Queries, weights: np.ndarray, best: list[Best]) -> None:
        ids = [NULL_ID if i is None else i for i in docs.column(0).to_pylist()]
        n = docs.column(1).to_numpy()
        m = 100 - 25 + np.array([25 * int(x) * n_docs // n_terms for x in n], np.int64)
        sketches = [np.frombuffer(s.as_buffer(), np.uint8) for s in docs.column(4)]
        bounds = upper_bounds(sketches, m, queries.hashes, weights)
        opened: dict[int, dict[bytes, int]] = {}
        by_id = np.array(sorted(range(len(ids)), key=ids.__getitem__))
        for column, own in enumerate(queries.of):
            mine, top = bounds[:, column], best[column]
            least = top.heap[0][0] if len(top.heap) == top.k else 1
            rows = by_id[mine[by_id] >= max(least, 1)]
            for row in rows[np.argsort(-mine[rows], kind="stable")].tolist():
                if len(top.heap) == top.k and mine[row] < top.heap[0][0]:
                    break
                if not top.may_enter(mine[row], ids[row]):
                    continue
                if row not in opened:
                    terms = docs.column(2)[row].values.cast(pa.binary()).to_pylist()
                    opened[row] = dict(zip(terms, docs.column(3)[row].values.to_pylist(), strict=True))
                held, length, score = opened[row], 12 * int(m[row]), 0
                for term in own.keys() & held.keys():
                    tf = held[term]
                    score += own[term] * ((1_000_000_000 * tf) // (1000 * tf + length))
                if score > 0 and top.may_enter(score, ids[row]):
                    top.add(score, ids[row])

    return index.mapInArrow(run, "item long, doc_id long, score long")


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """Each item's ``k`` best documents: item_id, rank, doc_id, score."""
    index = store(
        index_documents(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))), "sketch-index"
    )
    n_docs, n_terms = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    numbered = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    numbered = store(numbered.withColumn("item", F.monotonically_increasing_id()), "sketch-items")
    terms = store(item_terms(numbered), "sketch-item-terms")
    vocabulary = store(terms.select("term").distinct(), "sketch-vocabulary")
    frequencies = store(document_frequencies(index, vocabulary), "sketch-frequencies")
    weighed = terms.join(frequencies, "term").select("item", "term", "repeats", "df")
    n_blocks = max(1, -(-terms.count() // block_terms))
    block = F.pmod(F.xxhash64("item"), F.lit(n_blocks))
    found = frequencies.selectExpr("0L item", "0L doc_id", "0L score").limit(0)
    for lo in range(0, n_blocks, BLOCKS_PER_PASS):
        rows: dict[int, list[tuple]] = {}
        for b, *row in weighed.select(block, "*").where(block.between(lo, lo + BLOCKS_PER_PASS - 1)).collect():
            rows.setdefault(b, []).append(tuple(row))
        if rows:
            found = found.unionByName(search(index, [Queries(r, n_docs) for r in rows.values()], n_docs, n_terms, k))
    first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return ranked.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")

"""Substring de-duplication over super-k-mers of words.

A window is ``window`` consecutive words of one document. A word goes if it is in a window whose words also start earlier:
in a document with a smaller id, or earlier in the same one.

1. Runs. Every window has a minimiser: the smallest hash of the ``gram`` consecutive words inside it. Consecutive windows
   with one minimiser are a super-k-mer and travel together as one packed string, about three bytes for each byte of text
   instead of ``window``. Equal windows have equal minimisers, so they meet in the bucket of that minimiser.
2. Packing. A task cuts its texts in chunks, decides strings that it has seen twice itself (all but the earliest go), and
   sends the others bucket by bucket, compressed. A passage in a third of all documents so costs one string a chunk.
3. Buckets. A bucket takes its strings in order of document and place, decides repeated strings whole, sorts the hashes of
   the windows of the others, and compares the windows under equal hashes word for word. Hashes never decide a window.
4. The decided places go back to their documents by id and text hash, and the words are dropped there.

Skew: a minimiser with more runs than a bucket should hold (counted first, over all documents) is hot; its windows are
dealt one by one by the hash of all their words, so a passage whose surroundings differ in every document spreads over all
buckets. At most ``HOT_ENTRIES`` minimisers can be hot, as the limit rises with the corpus beyond that; they are broadcast
(8 bytes each). Buckets hold the runs of about ``bucket_bytes`` of text, whatever the size of the corpus.

Defined cases: null, empty and blank texts have no words. Documents of fewer words than a window lose nothing. Rows that
share an id tie: at equal places none is earlier, so both keep the window. A row without an id comes before all others.
Very long texts are handled whole, in pieces of bounded size. Other columns pass through; an input column with the name
of an added one (case ignored) is replaced. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh_name

NO_ID = -(2**63)
HOT_ENTRIES = 1 << 22
CHUNK_BYTES = 4 << 20
# a run is cut after so many windows, so that no packed string grows with its document
LONGEST_RUN = 4096
TEXT_BYTES_PER_RUN = 50

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_LOW_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)

SPANS = "id long, th long, start long, n long"


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class Words:
    """Word borders and 64-bit word hashes of strings of words: a space between words, a line feed after each string."""

    def __init__(self, strings: list[bytes]):
        self.raw = b"\n".join(strings) + b"\n"
        codes = np.frombuffer(self.raw, np.uint8)
        self.ends = np.flatnonzero((codes == 32) | (codes == 10))
        self.starts = np.concatenate(([0], self.ends[:-1] + 1))
        last = codes[self.ends] == 10
        self.string = np.cumsum(last) - last  # of each word
        self.first = np.concatenate(([0], np.flatnonzero(last)[:-1] + 1))  # each string's first word

    def hashes(self) -> np.ndarray:
        """From the first and last eight bytes and the length: equal words agree, others may too."""
        padded = self.raw + bytes(8)
        eight = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
        size = self.ends - self.starts
        head = eight[self.starts] & _LOW_BYTES[np.minimum(size, 8)]
        tail = eight[np.maximum(self.ends - 8, self.starts)] & _LOW_BYTES[np.minimum(size, 8)]
        return mix(head * _ODD + mix(tail + size.astype(np.uint64)))

    def window_starts(self, window: int) -> np.ndarray:
        """Words at which a window of one string starts."""
        n = len(self.string) - window + 1
        return np.flatnonzero(self.string[:n] == self.string[window - 1 :]) if n > 0 else np.zeros(0, np.int64)


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` consecutive numbers."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out = out * _ODD + hashes[j : j + n]
    return mix(out)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive numbers."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[:n], values[width - have : width - have + n])


def cut_runs(words: Words, window: int, gram: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of windows and routing hash of each super-k-mer; windows of a hot minimiser go one by one."""
    hashes = words.hashes()
    at = words.window_starts(window)
    if not len(at):
        return at, at, np.zeros(0, np.uint64)
    least = sliding_min(rolling(hashes, gram), window - gram + 1)[at]
    route = least
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (words.string[at[1:]] != words.string[at[:-1]]) | (least[1:] != least[:-1])
    new |= (at - words.first[words.string[at]]) % LONGEST_RUN == 0
    if len(hot):
        found = np.minimum(np.searchsorted(hot, least), len(hot) - 1)
        alone = hot[found] == least
        route = np.where(alone, rolling(hashes, window)[at], least)
        new |= alone
        new[1:] |= alone[:-1]
    begin = np.flatnonzero(new)
    return at[begin], np.diff(np.append(begin, len(at))), route[begin]


def later_copies(codes: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which rows come strictly later than the first with their code; the rows are in order of id and start."""
    _, first, back = np.unique(codes, return_index=True, return_inverse=True)
    first = first[back]
    return (ids > ids[first]) | (starts > starts[first]) & (ids == ids[first])


def exact_codes(strings: list[bytes]) -> np.ndarray:
    """Equal numbers for equal strings."""
    return pa.array(strings, pa.large_binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)


def text_chunks(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """(ids, text hashes, words joined by one space) of the documents with a window, about CHUNK_BYTES at a time."""
    for batch in batches:
        ids, ths = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        texts = batch.column(2).cast(pa.binary())
        held, rows, size = [], [], 0
        for row in range(len(texts)):
            words = texts[row].as_py().split()
            if len(words) >= window:
                held.append(b" ".join(words))
                rows.append(row)
                size += len(held[-1])
            if held and (size >= CHUNK_BYTES or row == len(texts) - 1):
                yield ids[rows], ths[rows], held
                held, rows, size = [], [], 0


def packed_rows(ids: np.ndarray, ths: np.ndarray, strings: list[bytes], window: int, gram: int, hot: np.ndarray, n_buckets: int):
    """The chunk's rows (bucket, strings, places): places only, in a bucket below zero, where the chunk itself decides."""
    import zstandard

    zip_ = zstandard.ZstdCompressor(level=6).compress
    words = Words(strings)
    at, n, route = cut_runs(words, window, gram, hot)
    if not len(at):
        return
    of = words.string[at]
    order = np.lexsort((at, ids[of]))
    at, n, route, of = at[order], n[order], route[order], of[order]
    start = at - words.first[of]
    raw = words.raw
    runs = [raw[a:b] for a, b in zip(words.starts[at].tolist(), words.ends[at + n + window - 2].tolist(), strict=True)]
    bucket = (mix(route) % np.uint64(n_buckets)).astype(np.int64)
    gone = later_copies(exact_codes(runs), ids[of], start)
    if gone.any():
        places = np.stack([ids[of][gone], ths[of][gone], start[gone], n[gone]]).astype("<i8")
        yield -1 - int(route[0] % np.uint64(2**40)), None, zip_(places.tobytes())
    stay = np.flatnonzero(~gone)
    stay = stay[np.argsort(bucket[stay], kind="stable")]
    if not len(stay):
        return
    borders = np.flatnonzero(np.diff(bucket[stay])) + 1
    places = np.stack([ids[of], ths[of], start, n]).astype("<i8")
    for rows in np.split(stay, borders):
        yield int(bucket[rows[0]]), zip_(b"\n".join([runs[r] for r in rows])), zip_(places[:, rows].tobytes())


def _runs_merged(places: np.ndarray) -> np.ndarray:
    """Single windows (id, th, start) as spans (id, th, start, n) of consecutive ones."""
    if not places.shape[1]:
        return np.zeros((4, 0), np.int64)
    places = places[:, np.lexsort((places[2], places[1], places[0]))]
    new = np.ones(places.shape[1], bool)
    new[1:] = (np.diff(places[0]) != 0) | (np.diff(places[1]) != 0) | (np.diff(places[2]) != 1)
    begin = np.flatnonzero(new)
    return np.vstack([places[:, begin], np.diff(np.append(begin, places.shape[1]))])


def settle(runs: list[bytes], places: np.ndarray, window: int) -> np.ndarray:
    """The spans (id, th, start, n) of one bucket whose windows also start earlier. ``places``: id, th, start, n by run."""
    order = np.lexsort((places[2], places[0]))
    places, runs = places[:, order], [runs[r] for r in order]
    gone = later_copies(exact_codes(runs), places[0], places[2])
    whole = places[:, gone]
    stay = np.flatnonzero(~gone)
    places, words = places[:, stay], Words([runs[r] for r in stay])
    at = words.window_starts(window)
    hashes = rolling(words.hashes(), window)[at]
    by_hash = np.argsort(hashes, kind="stable")
    same = hashes[by_hash][1:] == hashes[by_hash][:-1]
    twice = np.zeros(len(at), bool)
    twice[:-1] = same
    twice[1:] |= same
    at = at[by_hash[twice]]
    of = words.string[at]
    ids, ths, starts = places[0][of], places[1][of], places[2][of] + at - words.first[of]
    order = np.lexsort((starts, ids))
    at, ids, ths, starts = at[order], ids[order], ths[order], starts[order]
    raw = words.raw
    windows = [raw[a:b] for a, b in zip(words.starts[at].tolist(), words.ends[at + window - 1].tolist(), strict=True)]
    gone = later_copies(exact_codes(windows), ids, starts) if windows else np.zeros(0, bool)
    return np.hstack([whole, _runs_merged(np.stack([ids, ths, starts])[:, gone])])


def repeated_spans(docs: DataFrame, window: int, gram: int, bucket_bytes: int) -> DataFrame:
    """(id, th, start, n): n windows from word ``start`` on that also start earlier. ``docs`` has id, th and text."""
    spark = docs.sparkSession
    n_bytes = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_buckets = max(1, -(-n_bytes // bucket_bytes))
    limit = max(bucket_bytes, n_bytes // HOT_ENTRIES) // TEXT_BYTES_PER_RUN

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, strings in text_chunks(batches, window):
            _, _, route = cut_runs(Words(strings), window, gram, np.zeros(0, np.uint64))
            least, n = np.unique(route, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(least.view(np.int64)), pa.array(n)], ["least", "n"])

    counts = docs.mapInArrow(count, "least long, n long").groupBy("least").agg(F.sum("n").alias("n"))
    often = [r[0] for r in counts.where(F.col("n") > limit).select("least").collect()]
    hot = spark.sparkContext.broadcast(np.sort(np.array(often, np.int64).view(np.uint64)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.binary(), pa.binary()]
        for ids, ths, strings in text_chunks(batches, window):
            rows = list(packed_rows(ids, ths, strings, window, gram, hot.value, n_buckets))
            if rows:
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "runs", "places"])

    def in_bucket(table: pa.Table) -> pa.Table:
        import zstandard

        unzip = zstandard.ZstdDecompressor().decompress
        places = np.hstack([np.frombuffer(unzip(p), "<i8").reshape(4, -1) for p in table.column("places").to_pylist()])
        packed = [r for r in table.column("runs").to_pylist() if r is not None]
        if packed:
            places = settle([s for r in packed for s in unzip(r).split(b"\n")], places, window)
        return pa.Table.from_arrays([pa.array(c) for c in places.astype(np.int64)], ["id", "th", "start", "n"])

    packed = docs.mapInArrow(pack, "bucket long, runs binary, places binary")
    return packed.groupBy("bucket").applyInArrow(in_bucket, SPANS)


def dedup_windows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 20,
    gram: int = 3,
    bucket_bytes: int = 4 << 20,
) -> DataFrame:
    """``docs`` with ``text_col`` cut to its kept words, joined by one space, plus ``n_words`` (before) and ``n_removed``."""
    if not 1 <= gram <= window:
        raise ValueError("a minimiser has between one word and a window of words")
    key_id: Column = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID).cast("long"))
    thin = docs.where(F.col(text_col).isNotNull()).select(
        key_id.alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text")
    )
    spans = repeated_spans(thin, window, gram, bucket_bytes)
    # a set: rows that share id and text also share their spans
    per_doc = spans.groupBy("id", "th").agg(F.collect_set(F.struct("start", "n")).alias("spans"))
    names = [fresh_name(docs.columns, n) for n in ("dup_id", "dup_th", "dup_spans", "dup_out")]
    right = per_doc.select(*[F.col(c).alias(n) for c, n in zip(("id", "th", "spans"), names, strict=False)])
    joined = docs.join(right, (key_id == F.col(names[0])) & (F.xxhash64(F.col(text_col)) == F.col(names[1])), "left")

    @F.arrow_udf("text string, n_words long, n_removed long")
    def cut(texts: pa.Array, starts: pa.Array, sizes: pa.Array) -> pa.Array:
        kept, n_words, n_removed = [], [], []
        raw = texts.cast(pa.binary())
        for row in range(len(raw)):
            words = (raw[row].as_py() or b"").split()
            n_words.append(len(words))
            first = starts[row].values
            if first is not None and len(first):
                a, n = first.to_numpy(zero_copy_only=False), sizes[row].values.to_numpy(zero_copy_only=False)
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, a, 1)
                np.add.at(edge, a + n + window - 1, -1)
                covered = np.cumsum(edge[:-1]) > 0
                words = [words[i] for i in np.flatnonzero(~covered)]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words))
        columns = [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
        return pa.StructArray.from_arrays(columns, ["text", "n_words", "n_removed"])

    out = names[3]
    cut_text = cut(F.col(text_col), F.col(names[2])["start"], F.col(names[2])["n"])
    return (
        joined.withColumn(out, cut_text)
        .withColumns({text_col: F.col(out)["text"], "n_words": F.col(out)["n_words"], "n_removed": F.col(out)["n_removed"]})
        .drop(*names)
    )

"""Packing by power-of-two decomposition.

A document's ids (its tokens and an end id) are cut into pieces of power-of-two length: as many full-length pieces as
fit, then the binary digits of the rest, largest first. A piece is a sequence of its own, so no sequence crosses
documents and, as every length is a power of two, none is padded. Equal lengths form a bucket (column ``length``);
``write_buckets`` stores them so, and a trainer draws a batch from one bucket.

Tokens: white space and a boundary between an ASCII letter or digit and ASCII punctuation (not the apostrophe, which can
begin a contraction) always part tokens in this vocabulary, and A-Z are lower-cased by it, so chunks between these
boundaries are tokenized once per worker and remembered: two generations of at most ``CACHE`` / 2 chunks, of which the
older is forgotten when the younger is full, so chunks in use stay known however many rare ones pass. Chunks unknown to
the memory go through the tokenizer together; a text that may hold a special token's name goes through it whole.

One pass, no shuffle: rows are independent, so skew does not matter and a lost task is simply run again. Sequence ids are
unique longs (task number and row), the same again when a task is repeated over the same input.

Defined cases: null text is empty; an empty text is the end id alone, one piece. Repeated rows are packed each on
their own. Columns other than id and text are not carried.
"""

from __future__ import annotations

import string
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END_ID = 1
CACHE = 500_000
JOINED = 4096  # chunks of letters in one call of the tokenizer


def _table(members: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members.encode("ascii"))] = True
    return out


BEFORE = _table(string.ascii_lowercase + string.digits)
AFTER = _table(string.punctuation.replace("'", ""))


def piece_lengths(n: int, longest: int) -> list[int]:
    """Full pieces first, then the binary digits of what is left."""
    out = [longest] * (n // longest)
    rest = n % longest
    out += [1 << b for b in range(longest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return out


def chunks_of(low: bytes) -> list[bytes]:
    """The chunks of a lower-cased text: cut at white space and between a letter or digit and punctuation."""
    signs = np.frombuffer(low, np.uint8)
    cuts = np.flatnonzero(BEFORE[signs[:-1]] & AFTER[signs[1:]]) + 1
    return (np.insert(signs, cuts, ord(" ")).tobytes() if len(cuts) else low).split()


class ChunkTokenizer:
    """The ids of texts by a tokenizer file, remembering the ids of chunks."""

    def __init__(self, path: str, cache: int = CACHE):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.generation = max(cache // 2, 1)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)  # ids that end a token chain
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")

    @classmethod
    def of_worker(cls, path: str) -> ChunkTokenizer:
        """One per Python worker and file, kept from task to task."""
        held = sys.modules.setdefault("_tidemark_tokenizers", types.ModuleType("_tidemark_tokenizers"))
        if path not in held.__dict__:
            held.__dict__[path] = cls(path)
        return held.__dict__[path]

    def _batch(self, texts: list[bytes]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast([t.decode("utf-8") for t in texts], add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in encoded]

    def _encode(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        """Chunks of letters share calls as long as each is one token chain; others take a call each."""
        letters, alone = [], []
        for c in chunks:
            (letters if c.isalpha() or c.decode("utf-8").isalpha() else alone).append(c)
        out: dict[bytes, bytes] = {}
        for at in range(0, len(letters), JOINED):
            some = letters[at : at + JOINED]
            (ids,) = self._batch([b" ".join(some)])
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(some) or stops[-1] != len(ids):  # some chunk is not one chain
                alone += some
                continue
            packed, last = ids.tobytes(), 0
            for c, stop in zip(some, (4 * stops).tolist(), strict=True):
                out[c] = packed[last:stop]
                last = stop
        out.update(zip(alone, (ids.tobytes() for ids in self._batch(alone)), strict=True))
        return out

    def _remember(self, new: dict[bytes, bytes]) -> None:
        if len(self.young) + len(new) > self.generation:
            self.old, self.young = self.young, {}
        if len(new) <= self.generation:
            self.young.update(new)

    def _found(self, chunks: list[bytes]) -> list[bytes]:
        found = list(map(self.young.get, chunks))
        if None in found:
            holes = [i for i, v in enumerate(found) if v is None]
            missing = {chunks[i] for i in holes}
            new = {c: self.old[c] for c in missing if c in self.old}
            new.update(self._encode([c for c in missing if c not in new]))
            for i in holes:
                found[i] = new[chunks[i]]
            self._remember(new)
        return found

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        cut: list[list[bytes] | None] = []
        chunks: list[bytes] = []
        for text in texts:
            low = text.encode("utf-8").lower()
            mine = None if b"<|" in low else chunks_of(low)
            cut.append(mine)
            chunks += mine or ()
        found = self._found(chunks)
        out, at = [], 0
        for text, mine in zip(texts, cut, strict=True):
            if mine is None:
                out.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4"))
            else:
                out.append(np.frombuffer(b"".join(found[at : at + len(mine)]), "<u4"))
                at += len(mine)
        return out


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    longest: int = 2048,
    end_id: int = END_ID,
    with_tokens: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length (its bucket), ids_crc32, doc_tokens, sequence_id, offset, tokens."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest piece must be a power of two")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = ChunkTokenizer.of_worker(tokenizer_path)
        for pdf in batches:
            for at in range(0, len(pdf), 256):
                part = pdf.iloc[at : at + 256]
                rows: list[tuple] = []
                texts = [t if isinstance(t, str) else "" for t in part["text"]]
                for doc_id, ids in zip(part["doc_id"], coder.ids(texts), strict=True):
                    whole = np.append(ids, np.uint32(end_id)).astype("<u4")
                    start = 0
                    for n in piece_lengths(len(whole), longest):
                        piece = whole[start : start + n]
                        row = (doc_id, start, n, zlib.crc32(piece.tobytes()), len(whole))
                        rows.append((*row, piece.astype(np.int32)) if with_tokens else row)
                        start += n
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["tokens"] * with_tokens
                out = pd.DataFrame(rows, columns=names)
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    kind = docs.schema[id_col].dataType.simpleString()
    if kind not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError(f"{id_col} must be a whole number")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", tokens array<int>" * with_tokens
    thin = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = thin.mapInPandas(run, schema)
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Store the pieces with one folder per length."""
    pieces.write.mode("error").partitionBy("length").parquet(path)

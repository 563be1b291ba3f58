"""WARC archives with revisit records, and their capture index merged from sorted runs.

Writing. Each page is one WARC/1.1 record. Of the pages with equal payloads that with the smallest id is the response and
carries the payload; the others are revisits that refer to it and carry headers only. Records are built by Spark
expressions and written by Spark's own text writer, whose line separator is the blank line that ends a record, so the
archives are committed files on whatever store the folder is in, and a lost executor's files are written again. Pages are
written by classes of payload size, with fewer records to a file in the larger ones, so an archive's bytes are bounded (by
``ARCHIVE_BYTES`` and headers, or by one record); equal payloads have equal sizes, so no revisit refers to another class.

Reading. Archives are unpacked and parsed record by record, by Content-Length; the payload digest and length of every
response are computed again from its bytes and must equal its headers.

Index. The captures of each archive are sorted by URL key (host labels reversed, then path), time and id; a reading task
merges its archives with a loser tree into one sorted run, stored in the shared folder. The stored runs are parted by ranges
of that order, as many as their rows ask for, and each range merges its stretches of all runs with a loser tree whose
cursors walk them in place, so ranges one after the other give the global order. The shuffle keeps a run's stretch sorted
by Spark's own (spilling) sort; no task sorts in Python beyond one archive. A hot URL's history may span ranges, as time, id
and place in the archives are part of the order, so no range grows with it.

Defined cases: columns other than page_id, url and html are not read. Pages of any length are records of their own
archive above ``ARCHIVE_BYTES``. Null html is an empty payload. Null URL: no target header, empty key. Rows that tie for the smallest id of
a payload are all responses; rows without an id are responses only if no equal payload has an id. Line breaks in
a URL are percent-encoded. An empty table writes no records and gives an empty index.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator
from itertools import islice
from typing import BinaryIO

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import shared_path, store

EOL = "\r\n"
RECORD_END = EOL + EOL
CAPTURE_START = 1_700_000_000
YEAR = 31_536_000
RUN_COLUMNS = (
    "page_id long, url_key string, captured string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, archive string, archive_offset long, record_bytes long, run string"
)
ARCHIVE_BYTES = 128 << 20
ROWS_PER_RANGE = 1 << 17
ROWS_PER_BATCH = 1 << 13


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 digest: eight groups of 20 bits, four letters each."""
    groups = F.transform(
        F.sequence(F.lit(0), F.lit(7)),
        lambda i: F.lpad(F.conv(F.substring(F.sha1(payload), i * 5 + 1, F.lit(5)), 16, 32), 4, "0"),
    )
    digits, letters = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return F.translate(F.array_join(groups, ""), digits, letters)


def capture_time(page_id: Column) -> Column:
    """Pages have no capture time: one is derived from the id, the same at every run."""
    return F.date_format(
        F.timestamp_seconds(F.lit(CAPTURE_START) + F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(YEAR))),
        "yyyy-MM-dd'T'HH:mm:ss'Z'",
    )


def records(pages: DataFrame) -> DataFrame:
    """One column ``record``: the WARC record of each page without its end. ``pages``: page_id, url, html."""
    digested = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")
    ).withColumn("digest", base32_sha1(F.col("html").cast("binary")))
    first = digested.groupBy("digest").agg(F.min("page_id").alias("first_id"))
    joined = digested.join(first.withColumnRenamed("digest", "first_digest"), F.col("digest") == F.col("first_digest"))
    revisit = ~F.col("page_id").eqNullSafe(F.col("first_id"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    http = F.concat(
        F.lit(EOL.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "])),
        F.octet_length("html").cast("string"),
        F.lit(RECORD_END),
    )
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    lines = F.array(
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("page_id"))),
        F.concat(F.lit("WARC-Date: "), capture_time(F.col("page_id"))),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name(F.col("first_id")))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(
            F.lit("Content-Length: "),
            (F.octet_length(http) + F.when(revisit, 0).otherwise(F.octet_length("html"))).cast("string"),
        ),
    )
    head = F.array_join(F.filter(lines, lambda x: x.isNotNull()), EOL)
    return joined.select(F.concat(head, F.lit(RECORD_END), http, F.when(revisit, "").otherwise(F.col("html"))).alias("record"))


def size_class(payload: Column, records_per_file: int, archive_bytes: int) -> Column:
    """Half as many records to a file in each next class; 0 where ``records_per_file`` of the size fit into an archive."""
    share = F.octet_length(payload) * F.lit(float(records_per_file)) / F.lit(float(archive_bytes))
    return F.when(share > 1, F.ceil(F.log2(share))).otherwise(0).cast("int")


def write_archives(pages: DataFrame, path: str, records_per_file: int = 1000, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write gzip WARC files below ``path``, of at most ``records_per_file`` records and about ``archive_bytes`` bytes."""
    size = size_class(F.coalesce("html", F.lit("")), records_per_file, archive_bytes)
    classes = [r[0] for r in pages.select(size.alias("c")).distinct().collect()]  # a few dozen at most
    for c in sorted(classes) or [0]:
        (
            records(pages.where(size == c))
            .write.mode("append")
            .option("lineSep", RECORD_END)
            .option("compression", "gzip")
            .option("zlib.compress.level", "BEST_SPEED")
            .option("maxRecordsPerFile", max(1, records_per_file >> c))
            .text(path)
        )


def url_key(url: str | None) -> str:
    """Host labels reversed and joined by commas, then the rest of the URL."""
    if not url or "://" not in url:
        return ""
    rest = url.split("://", 1)[1]
    cut = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    return ",".join(reversed(rest[:cut].lower().split("."))) + ")" + rest[cut:]


def parse_records(archive: BinaryIO) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """(headers, block, offset, record length) of every record of an unpacked archive, one record at a time."""
    at = 0
    while first := archive.readline():
        if not first.startswith(b"WARC/1."):
            raise ValueError(f"no record at byte {at}")
        read, headers = len(first), {}
        while (line := archive.readline()) != b"\r\n":
            if not line.endswith(b"\r\n"):
                raise ValueError(f"record at byte {at} is cut short")
            read += len(line)
            name, value = line[:-2].decode("utf-8").split(": ", 1)
            headers[name] = value
        size = int(headers["Content-Length"])
        block = archive.read(size)
        if len(block) != size or archive.read(4) != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut short")
        length = read + 2 + size + 4
        yield headers, block, at, length
        at += length


def _page(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number not in ("", "none") else None


def capture(headers: dict[str, str], block: bytes) -> tuple:
    """page_id, url key, time, payload bytes, digest, type, refers_to of one record, checked against its bytes."""
    cut = block.index(b"\r\n\r\n") + 4
    sizes = [x.split(b": ", 1)[1] for x in block[:cut].split(b"\r\n") if x.startswith(b"Content-Length: ")]
    size, digest = int(sizes[0]), headers["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = headers["WARC-Type"]
    if kind == "response":
        payload = block[cut:]
        if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its headers")
    return (
        _page(headers["WARC-Record-ID"]),
        url_key(headers.get("WARC-Target-URI")),
        headers["WARC-Date"],
        size,
        digest,
        kind,
        _page(headers.get("WARC-Refers-To")),
    )


def order_of(row: tuple) -> tuple:
    """URL key, time, id (none first), place in the archives."""
    return (row[1], row[2], row[0] is not None, row[0] or 0, row[7], row[8])


class LoserTree:
    """Merge of k sorted iterators: a node keeps the loser of its match, the winner plays on, so a step is log2 k matches."""

    def __init__(self, runs: list[Iterator[tuple]], key):
        self.key, self.runs = key, runs
        self.heads: list[tuple | None] = [next(r, None) for r in runs]
        k = len(runs)
        self.losers = [-1] * max(1, k)
        for run in range(k):
            self._play(run)

    def _beats(self, a: int, b: int) -> bool:
        """Whether run a's head comes before run b's; an exhausted run comes last, equal heads go by run."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (self.key(x), a) < (self.key(y), b)

    def _play(self, run: int) -> None:
        winner, node = run, (run + len(self.runs)) // 2
        while node > 0:
            if self.losers[node] < 0:
                self.losers[node] = winner
                return
            if self._beats(self.losers[node], winner):
                self.losers[node], winner = winner, self.losers[node]
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and (row := self.heads[self.losers[0]]) is not None:
            yield row
            winner = self.losers[0]
            self.heads[winner] = next(self.runs[winner], None)
            self._play(winner)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The captures of every archive below ``path`` as sorted runs, one for each reading task, named by its first archive."""
    names = [c.split()[0] for c in RUN_COLUMNS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        archives = []
        for pdf in batches:
            for file, content in zip(pdf["path"], pdf["content"], strict=True):
                short = file.rsplit("/", 1)[-1]
                with gzip.GzipFile(fileobj=io.BytesIO(content)) as data:
                    rows = [(*capture(h, b), short, at, n) for h, b, at, n in parse_records(data)]
                archives.append((short, sorted(rows, key=order_of)))
        name = min((short for short, _ in archives), default="")
        merged = iter(LoserTree([iter(rows) for _, rows in archives], order_of))
        while rows := list(islice(merged, ROWS_PER_BATCH)):
            out = pd.DataFrame([(*row, name) for row in rows], columns=names)
            for c in ("page_id", "refers_to"):
                out[c] = out[c].astype("Int64")
            yield out

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return files.mapInPandas(run, RUN_COLUMNS)


def stretches(table: pa.Table) -> list[Iterator[tuple]]:
    """A cursor for each run's rows of a table ordered by run: (URL key, time, id or none first, place, row number)."""
    keys = [table.column(c).to_pylist() for c in ("url_key", "captured", "page_id", "archive", "archive_offset")]
    run = table.column("run").to_pylist()
    starts = [i for i in range(len(run)) if i == 0 or run[i] != run[i - 1]]

    def cursor(start: int, stop: int) -> Iterator[tuple]:
        for i in range(start, stop):
            key, captured, page, archive, offset = (k[i] for k in keys)
            yield key, captured, page is not None, page or 0, archive, offset, i

    return [cursor(a, b) for a, b in zip(starts, [*starts[1:], len(run)], strict=True)]


def merged_index(runs: DataFrame, ranges: int | None = None) -> DataFrame:
    """All captures in global order: ``index_range`` counts the ranges, ``index_place`` the captures within.

    ``runs`` is stored: its rows are counted to choose the number of ranges, each of about ``ROWS_PER_RANGE`` at most.
    """
    spark = runs.sparkSession
    n = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // ROWS_PER_RANGE))
    order = ["url_key", "captured", "page_id", "archive", "archive_offset"]
    ranged = runs.repartitionByRange(n, *order).sortWithinPartitions("run", *order)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(got) if (got := list(batches)) else None
        if table is None or not table.num_rows:
            return
        place, rows = 0, iter(LoserTree(stretches(table), lambda row: row[:-1]))
        while taken := [row[-1] for row in islice(rows, ROWS_PER_BATCH)]:
            out = table.take(taken).append_column("index_place", pa.array(range(place, place + len(taken)), pa.int64()))
            yield from out.combine_chunks().to_batches()
            place += len(taken)

    merged = ranged.mapInArrow(merge, RUN_COLUMNS + ", index_place long")
    return merged.withColumn("index_range", F.spark_partition_id())


def archive_and_index(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives below ``path``, read them back and return the merged index."""
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    write_archives(pages, path)
    return merged_index(store(read_runs(spark, path), "warc-runs"))

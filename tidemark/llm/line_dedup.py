"""Line de-duplication over levelled sorted runs of line hashes (a log-structured index kept as Parquet tables).

Documents are taken in batches, the largest ids first. A batch reduces its lines to one row per key, merge-joins these
with the runs of the batches before it, and so learns which of its keys are new (the anti-join) and which an earlier
batch, with larger ids, has already claimed. It then adds its own keys as a new sorted run. When ``fanout`` runs of a
level have gathered they are merged into one run of the next level, so a batch never meets more than ``fanout`` runs of
any level. A run is a table bucketed and sorted by hash, one file a bucket, so the anti-join and the compaction walk
runs side by side: stored runs are neither shuffled nor sorted again. A line is a candidate for dropping if its key was claimed before, or by a larger id of its own batch; when
all batches are in, the candidates whose key is in at least ``min_docs`` documents are dropped.

Scale: lines travel as two 64-bit hashes, never as text. Every count is pre-aggregated before its shuffle, so a line
found in a third of all documents is one row per task; the joins of lines with keys have one row per key on the other
side and are plain equi-joins that adaptive execution can split when a key is hot. Texts are shuffled once, at the end,
by document. All intermediate tables are in the shared folder, so a lost executor costs only its running tasks.

Defined cases: null or empty text is one empty line (kept). A document row is a document: repeated rows count each, and
rows that tie for the largest id holding a key all keep it. A row without an id is below all others. A key must have
``min_chars`` code points. Only the id and text columns are read; other columns pass through.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, ascii_lower, fresh_name, let, shared_path, store

HASH = ["h1", "h2"]
NO_ID = -(2**63)


def line_key(line: Column) -> Column:
    """What makes lines equal: white space stripped at both ends, A-Z lower-cased."""
    return F.btrim(line, F.lit(SPACES))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_entries(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per long enough line: document, text hash, line place, key hash, and whether it is the key's first there.

    ``docs`` has ``id`` and ``text``. Lower-casing is done on the whole text, once.
    """

    def marked(s: Column) -> Column:
        return F.transform(
            s,
            lambda x, i: F.struct(
                x["h1"].alias("h1"),
                x["h2"].alias("h2"),
                x["p"].alias("p"),
                F.coalesce((x["h1"] != F.get(s, i - 1)["h1"]) | (x["h2"] != F.get(s, i - 1)["h2"]), F.lit(True)).alias(
                    "first"
                ),
            ),
        )

    keys = F.transform(
        _lines(ascii_lower(F.col("text"))),
        lambda line, i: let(
            line_key(line),
            lambda k: F.when(
                F.length(k) >= min_chars,
                F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit("line"), k).alias("h2"), i.alias("p")),
            ),
        ),
    )
    entries = let(F.sort_array(F.filter(keys, lambda x: x.isNotNull())), marked)
    return docs.select("batch", "id", F.xxhash64("text").alias("th"), F.explode(entries).alias("e")).select(
        "batch", "id", "th", "e.h1", "e.h2", "e.p", "e.first"
    )


@contextmanager
def stored_order(spark: SparkSession) -> Iterator[None]:
    """Within, a scan of a bucketed table with one file a bucket counts as sorted, so merge joins need no sort."""
    key = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class LineRuns:
    """Levelled sorted runs of (key hash, documents, largest id), oldest level last."""

    def __init__(self, fanout: int):
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []
        self.tables: list[str] = []

    def all(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    @staticmethod
    def merged(run: DataFrame, other: DataFrame) -> DataFrame:
        """A full outer merge join of two runs: equal hashes become one row."""
        other = other.select(*HASH, F.col("n_docs").alias("more_docs"), F.col("max_id").alias("other_id"))
        return run.join(other, HASH, "full").select(
            *HASH,
            (F.coalesce("n_docs", F.lit(0)) + F.coalesce("more_docs", F.lit(0))).alias("n_docs"),
            F.greatest("max_id", "other_id").alias("max_id"),
        )

    def compacted(self, runs: list[DataFrame], level: int) -> DataFrame:
        """One stored run of several, two at a time, each result stored: a join's own result has no buckets to go on with."""
        out = runs[0]
        for r in runs[1:]:
            out = self.write(self.merged(out, r), level)
        return out

    def claims(self, own: DataFrame) -> DataFrame:
        """``own`` and whether any run holds the key: a merge join with each run, which has a key at most once."""
        seen = F.lit(False)
        for i, r in enumerate(self.all()):
            own = own.join(r.select(*HASH, F.lit(True).alias(f"seen_{i}")), HASH, "left")
            seen = seen | F.col(f"seen_{i}").isNotNull()
        return own.select(*HASH, "n_docs", "max_id", seen.alias("claimed"))

    def write(self, run: DataFrame, level: int = 0) -> DataFrame:
        """Store ``run``, which has each hash once, as a table bucketed and sorted by hash.

        The table is as wide as the session's shuffles, whose tasks hold whole buckets: each bucket becomes one file.
        """
        spark = run.sparkSession
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        table = f"line_run_{uuid.uuid4().hex}"
        writer = run.write.format("parquet").option("path", shared_path(spark, f"line-run-{level}"))
        writer.bucketBy(buckets, *HASH).sortBy(*HASH).saveAsTable(table)
        self.tables.append(table)
        return spark.table(table)

    def add(self, stored: DataFrame, level: int = 0) -> None:
        """Put a stored run on its level, and compact the level into the next one when it is full."""
        if len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(stored)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self.add(self.compacted(full, level + 1), level + 1)

    def forget(self, spark: SparkSession) -> None:
        """Take the runs out of the catalogue; their files stay in the shared folder like those of other stored tables."""
        for table in self.tables:
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def batch_bounds(ids: DataFrame, n_batches: int) -> list[int]:
    """Ids that part the documents into about equal batches; any bounds give the same result."""
    at = [i / n_batches for i in range(1, n_batches)]
    if not at:
        return []
    return sorted({int(x) for x in ids.where(F.col("id") != NO_ID).approxQuantile("id", at, 0.01)})


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    n_batches: int = 4,
    fanout: int = 2,
) -> DataFrame:
    """``docs`` with ``text_col`` cut down to its kept lines, plus ``n_lines`` (before) and ``n_dropped``."""
    key_id = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID).cast("long"))
    thin = docs.select(key_id.alias("id"), F.col(text_col).alias("text"))
    bounds = batch_bounds(thin.select("id"), n_batches)
    # batch 0 has the largest ids
    batch = F.lit(0)
    for bound in bounds:
        batch = batch + F.when(F.col("id") <= bound, 1).otherwise(0)
    entries = store(line_entries(thin.withColumn("batch", batch), min_chars), "line-entries", ["batch"])

    runs = LineRuns(fanout)
    candidates: list[DataFrame] = []
    with stored_order(docs.sparkSession):
        for b in range(len(bounds) + 1):
            mine = entries.where(F.col("batch") == b).drop("batch")
            own = mine.groupBy(*HASH).agg(
                F.sum(F.col("first").cast("long")).alias("n_docs"), F.max("id").alias("max_id")
            )
            own = runs.write(own)
            again = runs.claims(own).where(F.col("claimed") | (F.col("n_docs") > 1))
            # stored, so that the join with the lines has exchanges of its own and can be split at a hot key
            again = store(again.select(*HASH, "claimed", F.col("max_id").alias("own_max")), "line-again")
            candidates.append(
                store(
                    mine.join(again, HASH)
                    .where(F.col("claimed") | (F.col("id") < F.col("own_max")))
                    .select("id", "th", "p", *HASH),
                    "line-candidates",
                )
            )
            runs.add(own)
        many = runs.compacted(runs.all(), len(runs.levels)).where(F.col("n_docs") >= min_docs)
        everywhere = store(many.select(*HASH, "max_id"), "line-many")
    runs.forget(docs.sparkSession)

    dropped = candidates[0]
    for c in candidates[1:]:
        dropped = dropped.unionByName(c)
    per_doc = (
        dropped.join(everywhere, HASH)
        .where(F.col("id") < F.col("max_id"))
        .groupBy("id", "th")
        .agg(F.collect_set("p").alias("places"))  # repeated rows share a key: bounded by the lines of one text
    )
    return _without(docs, per_doc, id_col, text_col)


def _without(docs: DataFrame, per_doc: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Join the dropped places back to their documents and rebuild the texts."""
    names = [fresh_name(docs.columns, n) for n in ("drop_id", "drop_th", "drop_places")]
    right = per_doc.select(*[F.col(c).alias(n) for c, n in zip(("id", "th", "places"), names, strict=True)])
    key_id = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID).cast("long"))
    joined = docs.join(
        right, (key_id == F.col(names[0])) & (F.xxhash64(F.col(text_col)) == F.col(names[1])), "left"
    )
    text, places = F.col(text_col), F.col(names[2])

    def rebuilt(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places)
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    out = {
        text_col: F.when(places.isNull(), F.coalesce(text, F.lit(""))).otherwise(let(_lines(text), rebuilt)),
        "n_lines": F.size(_lines(text)).cast("long"),
        "n_dropped": F.coalesce(F.size(F.array_distinct(places)), F.lit(0)).cast("long"),
    }
    return joined.withColumns(out).drop(*names)

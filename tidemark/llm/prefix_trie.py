"""Prefix trie of conversations over padded turn-id matrices in lexicographic range shards.

1. A turn's id is the MD5 of its role and text (16 bytes, made by Spark); a conversation's path is its turns' ids in order.
2. Conversations are range-partitioned by path and id, so a shard is a stretch of the lexicographic order: a node's members
   lie next to each other, in one shard or in neighbouring ones, and copies of one conversation are cut by their ids.
3. A shard pads its paths to a matrix of turn ids, ``BLOCK`` columns at a time (deep columns hold only the rows that reach
   them), and orders the rows by numpy lexsort. Masks of the columns in which a row differs from the one before, OR-ed from
   the first column on, mark where the nodes of each depth start; ``reduceat`` aggregates every depth.
4. Only a node that spans a shard border is not whole: its depth is at most the number of turns that the last row before
   the border and the first row after it have in common. Its parts recombine by (depth, shard in which it starts). All
   figures are sums or minima over the parts: a part subtracts a node's single copy only where the node starts, counts a
   child only where the child starts, and a leaf only where the leaf ends.

Scale: rows are paths and code point counts, not texts. The driver holds two numbers a shard. A node with a third of all
conversations costs one part a shard. The digest of ends is one SHA-256 over ordered ids, which is sequential: the parts
are streamed to it in order, packed, and never held together.

Defined cases: turns come by turn number (null first), equal ones by turn id. Null role and text are empty. Rows without a
conversation id belong to no conversation. Remainders keep the sign of the id, as in SQL. Repeated rows are turns each. A
conversation is held as one row (16 bytes a turn), however long its texts are. Other columns are not read. An empty table
has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import store

TURNS_PER_SHARD = 1 << 16
BLOCK = 64
NO_ENDS = hashlib.sha256(b"").hexdigest()

PART = (
    "depth long, start long, parent_start long, shard long, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ends binary"
)


def own_conversations(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as (id in hex, code points of the text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.md5(F.concat(F.length(role), F.lit(":"), role, text).cast("binary")).alias("id"),
            F.length(text).alias("size"),
        ).alias("t"),
    )
    ordered = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["id"].alias("id"), t["size"].alias("size")))
    return rows.groupBy("conv_id").agg(ordered.alias("turns"))


def with_shared_heads(own: DataFrame, group: int = 100, longest: int = 6) -> DataFrame:
    """Each conversation with its first h turns taken from the first of its ``group``; h is its id's CRC-32 mod ``longest``."""
    base = own.select(F.col("conv_id").alias("base_id"), F.slice("turns", 1, longest).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest).cast("int")
    none = F.slice("turns", 1, 0)
    head: Column = F.slice(F.coalesce("head", none), F.lit(1), h)
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    keyed = own.withColumn("base_id", F.col("conv_id") - F.col("conv_id") % group)
    return keyed.join(base, "base_id", "left").select("conv_id", F.concat(head, rest).alias("turns"))


def paths_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, sizes) of conversations as (conv_id, turns)."""
    ids = F.array_join(F.transform("turns", lambda t: t["id"]), "")
    return conversations.select("conv_id", F.unhex(ids).alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes"))


def turns_in_common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b)) // 16
    x, y = (np.frombuffer(p[: 16 * n], ">u8").reshape(-1, 2) for p in (a, b))
    differs = np.flatnonzero((x != y).any(axis=1))
    return int(differs[0]) if len(differs) else n


class Borders:
    """How many turns neighbouring shards have in common; ``shards`` are (shard, first path, last path) in order."""

    def __init__(self, shards: list[tuple[int, bytes, bytes]]):
        self.place = {s[0]: k for k, s in enumerate(shards)}
        self.within = np.array([turns_in_common(first, last) for _, first, last in shards])
        self.shared = np.full(len(shards) + 1, -1)  # across the border before each shard
        for k in range(1, len(shards)):
            self.shared[k] = turns_in_common(shards[k - 1][2], shards[k][1])

    def spans(self, shard: int) -> tuple[int, int]:
        """Depths up to which a node comes from the shard before and goes on in the next; -1: not even the root."""
        k = self.place[shard]
        return int(self.shared[k]), int(self.shared[k + 1])

    def starts(self, shard: int, deepest: int) -> list[int]:
        """By depth, the shard in which a node starts that comes into this shard from before."""
        out, k = [], self.place[shard] - 1
        for depth in range(deepest, -1, -1):
            while min(self.shared[k], self.within[k]) >= depth:  # the whole shard is inside the node
                k -= 1
            out.append(k)
        return out[::-1]


def _ordered(conv: np.ndarray, ids: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Row order by path, a prefix first, then by conversation id: lexsort from the deepest block of columns up."""
    order = np.argsort(conv, kind="stable")
    for lo in range((int(length.max(initial=0)) - 1) // BLOCK * BLOCK, -1, -BLOCK):
        deep = length[order] > lo
        alive = order[deep]
        matrix = _matrix(ids, at, length, alive, lo)
        keys = matrix.reshape(len(alive), -1).T[::-1]
        order = np.concatenate((order[~deep], alive[np.lexsort(keys)]))
    return order


def _matrix(ids: np.ndarray, at: np.ndarray, length: np.ndarray, rows: np.ndarray, lo: int) -> np.ndarray:
    """Turn ids ``lo`` to ``lo + BLOCK`` of the rows, padded with zeros."""
    width = min(BLOCK, int(length[rows].max()) - lo)
    out = np.zeros((len(rows), width, 2), np.uint64)
    column = np.arange(lo, lo + width)
    real = column < length[rows][:, None]
    out[real] = ids[(at[rows][:, None] + column)[real]]
    return out


def _common(ids: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Turns that each row of the ordered shard has in common with the row before; -1 for the first row."""
    common = np.minimum(length, np.concatenate(([0], length[:-1])))
    same = np.ones(len(length), bool)  # as far as the blocks before
    for lo in range(0, int(length.max(initial=0)), BLOCK):
        rows = np.flatnonzero(same & (common > lo))
        rows = rows[rows > 0]
        if not len(rows):
            break
        both = np.union1d(rows, rows - 1)
        matrix = _matrix(ids, at, length, both, lo)
        a, b = np.searchsorted(both, rows), np.searchsorted(both, rows - 1)
        changed = np.logical_or.accumulate((matrix[a] != matrix[b]).any(axis=2), axis=1)
        parted = changed[:, -1]
        agree = lo + (~changed[parted]).sum(axis=1)
        common[rows[parted]] = np.minimum(common[rows[parted]], agree)
        same[rows] = ~parted
    common[0] = -1
    return common


def shard_parts(conv: np.ndarray, paths: list[bytes], sizes: list[np.ndarray], shard: int, borders: Borders) -> dict[str, list]:
    """The nodes of one shard, deepest first: whole ones finished, parts of spanning ones with their packed ends."""
    length = np.array([len(p) // 16 for p in paths])
    at = np.concatenate(([0], np.cumsum(length)[:-1]))
    ids = np.frombuffer(b"".join(paths), ">u8").astype(np.uint64).reshape(-1, 2)
    size = np.concatenate([*sizes, np.zeros(0)]).astype(np.int64)
    order = _ordered(conv, ids, at, length)
    conv, at, length = conv[order], at[order], length[order]
    common = _common(ids, at, length)
    before, after = borders.spans(shard)
    deepest = int(length.max())
    origin = borders.starts(shard, before)

    columns: dict[str, list] = {c.split()[0]: [] for c in PART.split(", ")}
    below = None  # of the depth under the present one: first rows, where the node starts, subtree's leaves, saved
    for depth in range(deepest, -1, -1):
        rows = np.flatnonzero(length >= depth)
        first = np.flatnonzero(common[rows] < depth)  # places in rows
        top, last = rows[first], rows[np.append(first[1:], len(rows)) - 1]
        n_convs = np.diff(np.append(first, len(rows)))
        least = np.minimum.reduceat(conv[rows], first)
        comes, goes = np.zeros(len(top), bool), np.zeros(len(top), bool)
        comes[0], goes[-1] = depth <= before, depth <= after
        text = size[at[top] + depth - 1] if depth else np.zeros(len(top), np.int64)
        saved = n_convs * text - np.where(comes, 0, text)
        leaves = (~goes & (length[last] == depth)).astype(np.int64)
        children = np.zeros(len(top), np.int64)
        if below is not None:
            parent = np.searchsorted(top, below[0], side="right") - 1
            np.add.at(children, parent, (~below[1]).astype(np.int64))
            np.add.at(leaves, parent, below[2])
            np.add.at(saved, parent, below[3])
        below = (top, comes, leaves, saved)

        start = np.full(len(top), -1)
        start[goes] = borders.place[shard]
        start[comes] = origin[depth] if depth <= before else -1
        # the parent, one turn shorter, may span a border where the node does not
        up = np.full(len(top), -1)
        up_conv = np.full(len(top), -1)
        if depth:
            over = np.flatnonzero(length >= depth - 1)
            begins = np.flatnonzero(common[over] < depth - 1)
            over_top, over_conv = over[begins], np.minimum.reduceat(conv[over], begins)
            mine = np.searchsorted(over_top, top, side="right") - 1
            up_conv = over_conv[mine]
            if depth - 1 <= after:
                up[mine == len(over_top) - 1] = borders.place[shard]
            if depth - 1 <= before:
                up[mine == 0] = origin[depth - 1]
        spans = start >= 0
        sha, ends = [NO_ENDS] * len(top), [None] * len(top)
        over = np.flatnonzero(length[top] == depth)
        for k in over.tolist():  # a node's ends come first among its rows, by id
            a, b = first[k], first[k] + n_convs[k]
            own = conv[rows[a:b]][length[rows[a:b]] == depth]
            if spans[k]:
                ends[k] = own.astype("<i8").tobytes()
            else:
                sha[k] = hashlib.sha256(",".join(map(str, own.tolist())).encode()).hexdigest()
        columns["depth"].append(np.full(len(top), depth))
        columns["start"].append(start)
        columns["parent_start"].append(up)
        columns["shard"].append(np.full(len(top), borders.place[shard]))
        columns["conv_id"].append(least)
        columns["parent_conv_id"].append(up_conv)
        columns["n_convs"].append(n_convs)
        columns["n_children"].append(children)
        columns["n_leaves"].append(leaves)
        columns["saved_tokens"].append(saved)
        columns["ends_sha256"].extend(sha)
        columns["ends"].extend(ends)
    return {c: v if c in ("ends", "ends_sha256") else np.concatenate(v) for c, v in columns.items()}


def spanning_digests(parts: DataFrame) -> DataFrame:
    """(depth, start, ends_sha256) of the spanning nodes with ends: ids streamed in order through one hash a node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, out = None, None, []
        for batch in batches:
            for depth, start, ends in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3)), strict=True):
                if node != (depth, start):
                    if node is not None:
                        out.append((*node, digest.hexdigest()))
                    node, digest, comma = (depth, start), hashlib.sha256(), ""
                ids = np.frombuffer(ends, "<i8")
                for a in range(0, len(ids), 1 << 16):
                    digest.update((comma + ",".join(map(str, ids[a : a + (1 << 16)].tolist()))).encode())
                    comma = ","
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["depth", "start", "ends_sha256"])
                out = []
        if node is not None:
            last = [[v] for v in (*node, digest.hexdigest())]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in last], ["depth", "start", "ends_sha256"])

    ends = parts.where(F.col("ends").isNotNull()).select("depth", "start", "shard", "ends")
    together = ends.repartition("depth", "start").sortWithinPartitions("depth", "start", "shard")
    return together.mapInArrow(run, "depth long, start long, ends_sha256 string")


def trie(conversations: DataFrame, turns_per_shard: int = TURNS_PER_SHARD) -> DataFrame:
    """One row per node of the trie of ``conversations`` (conv_id, turns as made by :func:`own_conversations`)."""
    spark = conversations.sparkSession
    paths = store(paths_of(conversations), "trie-paths")
    n_turns = paths.agg(F.coalesce(F.sum(F.size("sizes") + 1), F.lit(0))).first()[0]
    dealt = paths.repartitionByRange(max(1, -(-n_turns // turns_per_shard)), "path", "conv_id")
    shards = store(dealt.withColumn("shard", F.spark_partition_id()), "trie-shards")
    ranges = shards.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    borders = Borders([(r[0], bytes(r[1]), bytes(r[2])) for r in ranges.orderBy("shard").collect()])
    told = spark.sparkContext.broadcast(borders)

    def run(table: pa.Table) -> pa.Table:
        conv = table.column("conv_id").to_numpy()
        sizes = [np.array(s, np.int64) for s in table.column("sizes").to_pylist()]
        out = shard_parts(conv, table.column("path").to_pylist(), sizes, table.column("shard")[0].as_py(), told.value)
        kinds = {"ends": pa.binary(), "ends_sha256": pa.string()}
        return pa.Table.from_arrays([pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()], list(out))

    parts = store(shards.groupBy("shard").applyInArrow(run, PART), "trie-parts")
    node = ["depth", "start"]
    added = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    merged = (
        parts.where("start >= 0")
        .groupBy(*node)
        .agg(F.min("conv_id").alias("conv_id"), F.max("parent_start").alias("parent_start"), *[F.sum(c).alias(c) for c in added])
        .join(spanning_digests(parts), node, "left")
        .withColumns({"parent_conv_id": F.lit(-1).cast("long"), "ends_sha256": F.coalesce("ends_sha256", F.lit(NO_ENDS))})
    )
    spanning = store(merged, "trie-spanning")
    names = ["depth", "parent_start", "conv_id", "parent_conv_id", *added, "ends_sha256"]
    nodes = parts.where("start < 0").select(*names).unionByName(spanning.select(*names))
    parents = spanning.select((F.col("depth") + 1).alias("depth"), F.col("start").alias("parent_start"), F.col("conv_id").alias("top"))
    joined = nodes.join(parents, ["depth", "parent_start"], "left")
    parent: Column = F.when(F.col("depth") > 0, F.coalesce("top", "parent_conv_id"))
    return joined.select("conv_id", "depth", parent.alias("parent_conv_id"), *added, "ends_sha256")


def conversation_trie(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    turns_per_shard: int = TURNS_PER_SHARD,
) -> DataFrame:
    """The prefix trie of the conversations, each rebuilt on the head of the first of its hundred."""
    own = own_conversations(turns, conv_col, turn_col, role_col, text_col)
    return trie(with_shared_heads(store(own, "trie-own")), turns_per_shard)

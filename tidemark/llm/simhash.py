"""SimHash near-duplicates: fingerprints parted by a vantage-point tree over Hamming distance.

1. Fingerprints. Whole texts are lower-cased (A-Z), cut into words at white space, and hashed as 3-word shingles; bit b is
   set if it is set in over half of the hashes. Equal fingerprints are reduced to one row first, so a group of exact
   copies costs one fingerprint whatever its size.
2. Tree. A bounded sample of the distinct fingerprints (``sample_size``) builds the tree on the driver: each node has a
   vantage point and the median distance to it as its radius. A leaf is a shard.
3. Shards. A fingerprint's home is one leaf. As a query it also goes to every leaf that its ball of ``max_bits`` can
   reach: by the triangle inequality a branch inside radius r is out of reach if its distance d > r + max_bits, one
   outside if d + max_bits <= r. So each pair within ``max_bits`` meets in the home of either one: no link is lost, and the
   sample decides only how even the shards are. A leaf with over ``SPLIT`` times ``leaf_size`` home rows gets a second tree,
   built in one task from a bounded sample of its own rows, so the number of leaves grows with the input. What a leaf then
   holds is cut by hash: home rows into blocks, queries into pieces, and each pair of a block and a piece is a group of
   its own, bounded on both sides however dense a ball of near copies is.
4. Links. Inside a group, home rows are ordered by distance to one of them, so a query faces only those within ``max_bits``
   of its own distance. A group returns a spanning forest of what it found, not all pairs.
5. Components by alternating large-star and small-star rounds over the forests, each round written to the shared folder.

Growth: a query visits about 1.45 times more leaves per level, so shuffled rows grow as N^1.5 of the distinct
fingerprints (8 bytes each). Where a ball is too dense to prune, each query meets all its home rows.

Defined cases: null, empty and blank texts have fingerprint zero and are linked like any other. The smallest id of a
component ignores null ids; it is null if all are. Repeated rows share a fingerprint. Extra columns pass through.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh_name, store

SEED = 42
SPLIT = 4


def text_fingerprint(text: str | None, width: int = 3) -> int:
    """The 64-bit SimHash of one text, as an unsigned number."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) <= width:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
        hashes = [digest(joined[a:b], SEED) for a, b in spans]
    n = len(hashes)
    counts = np.zeros(64, np.int64)
    values = np.array(hashes, dtype=np.uint64)
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        block = values[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << b for b in range(64) if 2 * counts[b] > n))


def with_fingerprints(docs: DataFrame, text_col: str, fp_col: str, width: int) -> DataFrame:
    """``docs`` without the text, plus the fingerprint as a signed long."""
    rest = [c for c in docs.columns if c != text_col]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fps = np.array([text_fingerprint(t, width) for t in pdf[text_col]], dtype=np.uint64)
            out = pdf[rest].copy()
            out[fp_col] = fps.astype(np.int64)
            yield out

    schema = docs.select(*rest).withColumn(fp_col, F.lit(0).cast("long")).schema
    return docs.mapInPandas(run, schema)


def distances(values: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(values ^ point)


class VantageTree:
    """Nodes in arrays: vantage point, radius, inner and outer child; a negative child -k-1 is leaf k."""

    def __init__(self, sample: np.ndarray, leaves: int, seed: int = 7):
        self.points: list[int] = []
        self.radii: list[int] = []
        self.inner: list[int] = []
        self.outer: list[int] = []
        self.leaves = 0
        self._random = np.random.default_rng(seed)
        self.root = self._grow(np.unique(sample), leaves)

    def _leaf(self) -> int:
        self.leaves += 1
        return -self.leaves

    def _grow(self, values: np.ndarray, leaves: int) -> int:
        if leaves <= 1 or len(values) < 2:
            return self._leaf()
        point = values[self._random.integers(len(values))]
        d = distances(values, point)
        radius = int(np.sort(d)[(len(d) - 1) // 2])
        if radius >= d.max():
            radius = int(d.max()) - 1
        node = len(self.points)
        self.points.append(int(point))
        self.radii.append(radius)
        self.inner.append(0)
        self.outer.append(0)
        self.inner[node] = self._grow(values[d <= radius], leaves // 2)
        self.outer[node] = self._grow(values[d > radius], leaves - leaves // 2)
        return node

    def dump(self) -> bytes:
        return pickle.dumps((self.points, self.radii, self.inner, self.outer, self.root))

    @classmethod
    def load(cls, data: bytes) -> VantageTree:
        tree = cls.__new__(cls)
        tree.points, tree.radii, tree.inner, tree.outer, tree.root = pickle.loads(data)
        return tree

    def visit(self, values: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, row numbers) for every leaf that a ball of ``reach`` around a value can touch; 0 gives homes."""
        stack = [(self.root, np.arange(len(values)))]
        while stack:
            node, rows = stack.pop()
            if not len(rows):
                continue
            if node < 0:
                yield -node - 1, rows
                continue
            d = distances(values[rows], np.uint64(self.points[node])).astype(np.int16)
            stack.append((self.inner[node], rows[d <= self.radii[node] + reach]))
            stack.append((self.outer[node], rows[d + reach > self.radii[node]]))

    def placed(self, values: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(leaf, row numbers, whether it is their home) for every leaf in reach."""
        home = np.zeros(len(values), np.int32)
        for k, rows in self.visit(values, 0):
            home[rows] = k
        for k, rows in self.visit(values, reach):
            yield k, rows, home[rows] == k


def forest(home: np.ndarray, queries: np.ndarray, point: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (root, member) of the components that home rows and queries form within ``max_bits``.

    Home rows are sorted by distance to ``point``; a query at distance d faces those from d - max_bits to d + max_bits.
    """
    values = np.unique(np.concatenate((home, queries)))
    parent = np.arange(len(values))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    p = np.uint64(point)
    dh, dq = distances(home, p).astype(np.int16), distances(queries, p).astype(np.int16)
    home, queries = home[order := np.argsort(dh, kind="stable")], queries[back := np.argsort(dq, kind="stable")]
    dh, dq = dh[order], dq[back]
    at_home = np.searchsorted(values, home)
    at_query = np.searchsorted(values, queries)
    for d in np.unique(dq):
        a, b = np.searchsorted(dq, [d, d + 1])
        lo, hi = np.searchsorted(dh, [d - max_bits, d + max_bits + 1])
        if lo == hi:
            continue
        near = home[lo:hi]
        step = max(1, (1 << 18) // (hi - lo))  # a bounded table of distances at a time
        for q in range(a, b, step):
            some = queries[q : min(q + step, b)]
            rows, cols = np.nonzero(np.bitwise_count(some[:, None] ^ near[None, :]) <= max_bits)
            x, y = at_query[q + rows], at_home[lo + cols]
            x, y = x[x != y], y[x != y]
            if not len(x):
                continue
            while not np.array_equal(top := parent[parent], parent):
                parent[:] = top
            pairs = np.unique(parent[x] * len(values) + parent[y])  # a dense group leaves few pairs of roots
            for rx, ry in zip(*(a.tolist() for a in np.divmod(pairs, len(values))), strict=True):
                if (rx := find(rx)) != (ry := find(ry)):
                    parent[max(rx, ry)] = min(rx, ry)
    roots = np.fromiter((find(i) for i in range(len(values))), np.int64, len(values))
    linked = roots != np.arange(len(values))
    return values[roots[linked]], values[linked]


def drawn(share: Column) -> Column:
    """A share of the fingerprints, chosen by hash, so a lost task draws the same sample again."""
    return F.pmod(F.xxhash64("fp"), F.lit(1_000_003)) < share * 1_000_003


def split_leaves(reached: DataFrame, max_bits: int, leaf_size: int, sample_size: int, piece_size: int) -> DataFrame:
    """``reached`` (leaf, home, fp) with a second number ``sub``: the leaf of a tree inside each large leaf, else 0."""
    sizes = reached.groupBy("leaf").agg(F.count_if("home").alias("homes"), F.count("*").alias("queries"))
    # a row per large leaf, at most sample_size / 32 of them
    large = sizes.where(F.col("homes") > SPLIT * leaf_size).collect()
    if not large:
        return reached.withColumn("sub", F.lit(0))
    most = max(2, sample_size // 32)
    plan = F.broadcast(
        reached.sparkSession.createDataFrame(
            [(r["leaf"], min(most, -(-r["homes"] // leaf_size)), r["homes"], -(-r["queries"] // piece_size)) for r in large],
            "leaf int, subs int, homes long, pieces int",
        )
    )

    def grown(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tree = VantageTree(pdf["fp"].to_numpy(np.int64).view(np.uint64), int(pdf["subs"].iloc[0]), seed=8)
        return pd.DataFrame({"leaf": [key[0]], "tree": [tree.dump()]})

    def dealt(rows: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"leaf": np.zeros(0, np.int32), "home": np.zeros(0, bool), "fp": np.zeros(0, np.int64), "sub": np.zeros(0, np.int32)})]
        if len(rows):
            values, at_home, leaf = rows["fp"].to_numpy(np.int64).view(np.uint64), rows["home"].to_numpy(bool), np.int32(rows["leaf"].iloc[0])
            # a leaf whose sample is empty stays whole
            tree = VantageTree.load(trees["tree"].iloc[0]) if len(trees) else VantageTree(values[:1], 1)
            for k, some, home in tree.placed(values, max_bits):
                out.append(pd.DataFrame({"leaf": leaf, "home": home & at_home[some], "fp": values[some].view(np.int64), "sub": np.int32(k)}))
        return pd.concat(out)

    sample = reached.where("home").join(plan, "leaf").where(drawn(32.0 * F.col("subs") / F.col("homes")))
    trees = store(sample.groupBy("leaf").applyInPandas(grown, "leaf int, tree binary"), "simhash-trees")
    rows = reached.join(plan, "leaf").withColumn("piece", F.pmod(F.xxhash64(F.lit("piece"), "fp"), F.col("pieces")))
    each = trees.join(plan, "leaf").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces").cast("long") - 1)))
    parted = (
        rows.select("leaf", "piece", "home", "fp")
        .groupBy("leaf", "piece")
        .cogroup(each.select("leaf", "piece", "tree").groupBy("leaf", "piece"))
        .applyInPandas(dealt, "leaf int, home boolean, fp long, sub int")
    )
    whole = reached.join(plan, "leaf", "left_anti").withColumn("sub", F.lit(0))
    return store(whole.unionByName(parted), "simhash-split")


def dealt_groups(reached: DataFrame, leaf_size: int, piece_size: int) -> DataFrame:
    """(leaf, sub, block, piece, home, fp): every block of a leaf's home rows with every piece of its queries."""
    counts = reached.groupBy("leaf", "sub").agg(F.count_if("home").alias("homes"), F.count("*").alias("queries"))
    # stored, so that the join has exchanges of its own and can be split at a large leaf
    cuts = store(
        counts.where("homes > 0").select(
            "leaf",
            "sub",
            F.greatest(F.ceil(F.col("homes") / leaf_size), F.lit(1)).cast("long").alias("blocks"),
            F.greatest(F.ceil(F.col("queries") / piece_size), F.lit(1)).cast("long").alias("pieces"),
        ),
        "simhash-cuts",
    )
    rows = reached.join(cuts, ["leaf", "sub"])
    block, piece = F.pmod(F.xxhash64(F.lit("block"), "fp"), F.col("blocks")), F.pmod(F.xxhash64(F.lit("piece"), "fp"), F.col("pieces"))
    all_of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    # a row is a query of its piece in every block and, at home, a member of its block for every piece
    asked = rows.withColumn("home", F.lit(False)).withColumn("piece", piece).withColumn("block", all_of("blocks"))
    homes = rows.where("home").withColumn("block", block).withColumn("piece", all_of("pieces"))
    columns = ["leaf", "sub", "block", "piece", "home", "fp"]
    return homes.select(columns).unionByName(asked.select(columns))


def links(
    fps: DataFrame, max_bits: int, leaf_size: int, sample_size: int, n_distinct: int, piece_size: int = 65_536
) -> DataFrame:
    """Star edges (a, b) between distinct fingerprints; their transitive closure is that of all pairs in reach."""
    leaves = max(1, min(sample_size // 32, -(-n_distinct // leaf_size)))
    share = min(1.0, 32 * leaves / max(1, n_distinct))
    sample = np.array(sorted(r["fp"] for r in fps.where(drawn(F.lit(share))).collect()), dtype=np.int64).view(np.uint64)
    tree = VantageTree(sample, leaves)  # a few thousand nodes; travels with the tasks

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values = pdf["fp"].to_numpy(np.int64).view(np.uint64)
            for k, rows, home in tree.placed(values, max_bits):
                yield pd.DataFrame({"leaf": np.int32(k), "home": home, "fp": values[rows].view(np.int64)})

    def joined(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        values, home = pdf["fp"].to_numpy(np.int64).view(np.uint64), pdf["home"].to_numpy(bool)
        point = int(values[home].min()) if home.any() else 0
        a, b = forest(values[home], values[~home], point, max_bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    reached = store(fps.mapInPandas(placed, "leaf int, home boolean, fp long"), "simhash-reached")
    split = split_leaves(reached, max_bits, leaf_size, sample_size, piece_size)
    groups = dealt_groups(split, leaf_size, piece_size).groupBy("leaf", "sub", "block", "piece")
    return groups.applyInPandas(joined, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; the root is the smallest node of the component.

    Large-star then small-star rounds until a round changes nothing. Minima are pre-aggregated before each shuffle, and
    the joins are equi-joins on the node with one row per node on one side.
    """
    edges = store(edges.where("a <> b").distinct(), "simhash-edges")

    def digest(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    before = digest(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        floor = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            down.join(floor, "a")
            .select(F.col("m").alias("a"), "b")
            .unionByName(floor.select(F.col("m").alias("a"), F.col("a").alias("b")))
            .where("a <> b")
            .distinct()
        )
        edges = store(small, "simhash-edges")
        after = digest(edges)
        if after == before:
            break
        before = after
    return edges.groupBy("b").agg(F.min("a").alias("root")).select(F.col("b").alias("node"), "root")


def labelled(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 3,
    max_bits: int = 2,
    leaf_size: int = 2048,
    sample_size: int = 131_072,
    piece_size: int = 65_536,
) -> DataFrame:
    """Per row of ``docs``: doc_id, th (hash of the text), fp, root (of the component) and component_id."""
    thin = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    marked = store(with_fingerprints(thin, "text", "fp", width), "simhash-fingerprints")
    distinct = store(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    n = distinct.count()
    roots = components(links(distinct.select("fp"), max_bits, leaf_size, sample_size, n, piece_size))
    grouped = distinct.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = grouped.select("fp", "root").join(smallest, "root").select("fp", "root", "component_id")
    return marked.join(labels, "fp").select("doc_id", "th", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits) and component_id (the smallest id reachable)."""
    return labelled(docs, id_col, text_col, **options).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of ``docs`` per component: that with the smallest id (a null id comes last; ties go by text hash)."""
    found = labelled(docs, id_col, text_col, **options)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th")).alias("first"))
    kid, kth, th = (fresh_name(docs.columns, n) for n in ("keep_id", "keep_th", "text_hash"))
    kept = first.select(F.col("first.doc_id").alias(kid), F.col("first.th").alias(kth))
    marked = docs.withColumn(th, F.xxhash64(text_col))
    joined = marked.join(kept, F.col(id_col).eqNullSafe(F.col(kid)) & (F.col(th) == F.col(kth)), "left_semi")
    return joined.dropDuplicates([id_col, th]).drop(th)

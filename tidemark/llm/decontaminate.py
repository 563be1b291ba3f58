"""Benchmark decontamination by winnowing.

Every text is cut into words and its k-word grams are hashed; of each run of ``window`` consecutive grams the smallest
hash is a fingerprint. Two texts that share ``k + window - 1`` words share a whole run of grams and so pick the same
fingerprint in it, whatever surrounds the span. Documents and benchmark items are joined on fingerprints, and each hit is
extended on the words themselves: a hit counts only where all ``span`` words agree. Items shorter than ``span`` words
are looked for whole: their length is a gram size of its own, and every gram of that size is a fingerprint.

A fingerprint is one long: 36 bits of the gram's hash above 28 bits for its place (a text may have 268 million words),
so picking the smallest keeps the place as well. Hash clashes cost a comparison and never a wrong result.

Scale: documents are read twice and shuffled once, by document, to meet their hits. Fingerprints are not shuffled while
the benchmark's stay below ``broadcast_rows`` rows and BROADCAST_BYTES of words and ids (both are summed first); beyond
it both sides are shuffled by fingerprint in a plain equi-join, which adaptive execution can split where a passage is
very common. Items that share a fingerprint and all words around it are one benchmark row with a list of items, so
equal items and shared prompts meet a document once.

Defined cases: null and blank texts have no words, hit nothing and are kept; such items match nothing. Repeated rows
are judged each on its own. Items with a null id mark words but are not listed. An empty benchmark leaves every document
clean. Only id and text columns are read; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, find_words, fresh_name, let

ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PLACE_BITS = 28
BROADCAST_BYTES = 64 << 20


def item_words(text: Column) -> Column:
    return find_words(ascii_lower(text), ITEM_WORD)


def fingerprints(words: Column, k: int, window: int) -> Column:
    """The distinct (hash, place) longs that winnowing picks from a word array."""
    def picked(w: Column) -> Column:
        grams = F.transform(
            F.sequence(F.lit(0), F.size(w) - k),
            lambda i: F.shiftleft(F.xxhash64(*[F.get(w, i + j) for j in range(k)]), PLACE_BITS).bitwiseOR(i.cast("long")),
        )
        if window == 1:
            return grams
        smallest = lambda g: F.array_distinct(
            F.transform(
                F.sequence(F.lit(0), F.size(g) - window), lambda i: F.least(*[F.get(g, i + j) for j in range(window)])
            )
        )
        return let(grams, smallest)

    return F.when(F.size(words) >= k + window - 1, let(words, picked))


def _hash(fp: Column) -> Column:
    return F.shiftright(fp, PLACE_BITS)


def _place(fp: Column) -> Column:
    return fp.bitwiseAND(F.lit((1 << PLACE_BITS) - 1).cast("long")).cast("int")


def benchmark_fingerprints(items: DataFrame, span: int, k: int, sizes: list[int]) -> DataFrame:
    """Per fingerprint: gram size, hash, the words that any span around the gram can touch, and the items holding them.

    ``items`` has ``item_id`` and ``w``. ``back`` is the gram's place among those words. Null ids are not listed.
    """
    window = span - k + 1
    long_items = items.where(F.size("w") >= span).select(
        F.lit(0).alias("size"), "item_id", "w", F.explode(fingerprints(F.col("w"), k, window)).alias("fp")
    )
    out = long_items
    for m in sizes:
        out = out.unionByName(
            items.where(F.size("w") == m).select(
                F.lit(m).alias("size"), "item_id", "w", F.explode(fingerprints(F.col("w"), m, 1)).alias("fp")
            )
        )
    start = F.greatest(_place(F.col("fp")) - (span - k), F.lit(0))
    places = out.select(
        "size",
        _hash(F.col("fp")).alias("h"),
        F.col("item_id").cast("string").alias("item_id"),
        (_place(F.col("fp")) - start).alias("back"),
        F.slice("w", start + 1, _place(F.col("fp")) + span - start).alias("around"),
    )
    return places.groupBy("size", "h", "back", "around").agg(F.sort_array(F.collect_set("item_id")).alias("items"))


def _verified(words: Column, hits: Column, span: int) -> Column:
    """Occurrences (start, length, items) of whole item windows in ``words``, extended from the hits."""

    def around(hit: Column) -> Column:
        length = F.when(hit["size"] == 0, F.lit(span)).otherwise(hit["size"])
        return F.filter(
            F.transform(
                F.sequence(F.lit(0), F.greatest(F.size(hit["around"]) - length, F.lit(0))),
                lambda s: F.when(
                    (hit["start"] + s >= 0)
                    & (
                        F.slice(words, F.greatest(hit["start"] + s, F.lit(0)) + 1, length)
                        == F.slice(hit["around"], s + 1, length)
                    ),
                    F.struct((hit["start"] + s).alias("start"), length.alias("n"), hit["items"].alias("items")),
                ),
            ),
            lambda x: x.isNotNull(),
        )

    return F.flatten(F.transform(hits, around))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    span: int = 10,
    k: int = 5,
    broadcast_rows: int = 200_000,
) -> DataFrame:
    """``docs`` plus ``n_words``, ``n_hit``, ``item_ids`` (sorted text), ``hit_spans`` and ``contaminated``."""
    items = benchmark.select("item_id", item_words(F.col("text")).alias("w"))
    short = items.where((F.size("w") > 0) & (F.size("w") < span)).select(F.size("w").alias("n")).distinct()
    sizes = sorted(r["n"] for r in short.collect())  # at most span - 1 rows
    marks = benchmark_fingerprints(items, span, k, sizes)
    held = F.octet_length(F.concat_ws(" ", "around", "items"))
    shape = marks.agg(F.count("*").alias("n"), F.sum(held).alias("size")).first()
    if shape["n"] <= broadcast_rows and (shape["size"] or 0) <= BROADCAST_BYTES:
        marks = F.broadcast(marks)

    thin = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), item_words(F.col(text_col)).alias("w"))
    found = None
    for size, gram, window in [(0, k, span - k + 1), *((m, m, 1) for m in sizes)]:
        one = thin.select("id", "th", F.lit(size).alias("size"), F.explode(fingerprints(F.col("w"), gram, window)).alias("fp"))
        found = one if found is None else found.unionByName(one)
    found = found.select("id", "th", "size", _hash(F.col("fp")).alias("h"), _place(F.col("fp")).alias("p"))
    hits = (
        found.join(marks, ["size", "h"])
        .select("id", "th", F.struct((F.col("p") - F.col("back")).alias("start"), "size", "items", "around").alias("hit"))
        .groupBy("id", "th")
        .agg(F.collect_set("hit").alias("hits"))
    )

    names = [fresh_name(docs.columns, n) for n in ("hit_id", "hit_th", "hit_list")]
    right = hits.select(*[F.col(c).alias(n) for c, n in zip(("id", "th", "hits"), names, strict=True)])
    joined = docs.join(
        right, F.col(id_col).eqNullSafe(F.col(names[0])) & (F.xxhash64(F.col(text_col)) == F.col(names[1])), "left"
    )
    occurrence = "array<struct<start:int,n:int,items:array<string>>>"

    def judged(w: Column) -> Column:
        spans = F.when(F.col(names[2]).isNull(), F.array().cast(occurrence)).otherwise(
            _verified(w, F.col(names[2]), span).cast(occurrence)
        )
        return let(spans, lambda s: F.struct(F.size(w).cast("long").alias("n_words"), s.alias("spans")))

    j = fresh_name([*docs.columns, *names], "judged")
    out = joined.withColumn(j, let(item_words(F.col(text_col)), judged))
    spans = F.col(f"{j}.spans")
    covered = F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["start"] + s["n"] - 1)))
    ids = F.flatten(F.transform(spans, lambda s: s["items"]))
    return out.withColumns(
        {
            "n_words": F.col(f"{j}.n_words"),
            "n_hit": F.size(F.array_distinct(covered)).cast("long"),
            "item_ids": F.sort_array(F.array_distinct(ids)),
            "hit_spans": F.array_distinct(F.transform(spans, lambda s: F.struct(s["start"], (s["start"] + s["n"]).alias("end")))),
            "contaminated": F.size(spans) > 0,
        }
    ).drop(*names, j)

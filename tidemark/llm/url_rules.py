"""URL filter: rules on host suffixes and path prefixes, found by joining short hashes of expressions.

A URL becomes a set of expressions: each suffix of its host (cut at dots) joined to each prefix of its path that has the
length of some rule's path. Expressions and rules are hashed; the join is on the first four bytes of the digest, and a
match counts only where the full digests agree. Of the rules that fit, the longest wins; between equally long ones the
longer host, then the larger rule text.

Scale: distinct (host, path) pairs are judged once each and joined back, so a hot URL is expanded once; a rule table of at
most ``broadcast_rows`` rows and BROADCAST_BYTES of text is broadcast (it is counted first), a larger one is joined by shuffle. Hosts are only cut into
as many labels as the rules have, so an odd host with thousands of dots stays cheap.

Defined cases: a null URL, or one without ``://``, has an empty host and path and fits no rule (no rule has an empty
host). Repeated pages are judged each. Unmatched URLs get ``default`` (allow). An empty rule table allows everything. Other
columns pass through; those called host, path, rule or verdict (case ignored) are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, fresh_name, let

PREFIX_HEX = 8
BROADCAST_BYTES = 16 << 20


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) as the rules see them."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    raw_host = F.regexp_extract(rest, "^[^/?#]*", 0)
    tail = F.substring(rest, F.length(raw_host) + 1, F.length(rest))
    host, path = ascii_lower(raw_host), F.regexp_extract(tail, "^[^?#]*", 0)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def expressions(host: Column, path: Column, max_labels: int, path_lengths: list[int]) -> Column:
    """Every host suffix of at most ``max_labels`` labels with every path prefix of a rule's length."""

    def suffixes(labels: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max_labels))),
            lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."),
        )

    prefixes = F.filter(
        F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in path_lengths]), lambda p: p.isNotNull()
    )
    crossed = F.flatten(
        F.transform(let(F.split(host, r"\.", -1), suffixes), lambda s: F.transform(prefixes, lambda p: F.concat(s, p)))
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(crossed)


def judge(
    pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow", broadcast_rows: int = 100_000
) -> DataFrame:
    """``pages`` plus ``host``, ``path``, ``rule`` (null if none) and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict``; a rule is written host followed by path.
    """
    table = rules.select(
        F.concat("host", "path").alias("rule"),
        F.col("host").alias("rule_host"),
        F.col("verdict").alias("rule_verdict"),
        F.size(F.split("host", r"\.", -1)).alias("labels"),
        F.length("path").alias("path_length"),
    ).where(F.col("rule_host") != "")
    size = F.sum(F.octet_length("rule") + F.octet_length("rule_host")).alias("size")
    shape = table.agg(F.max("labels").alias("labels"), F.count("*").alias("n"), size).first()
    lengths = sorted(r["path_length"] for r in table.select("path_length").distinct().collect())
    table = table.withColumn("digest", F.sha2("rule", 256)).withColumn("short", F.substring("digest", 1, PREFIX_HEX))
    table = table.select("short", "digest", "rule", "rule_host", "rule_verdict")
    if shape["n"] <= broadcast_rows and (shape["size"] or 0) <= BROADCAST_BYTES:
        table = F.broadcast(table)

    host, path = url_parts(F.col(url_col))
    names = [fresh_name(pages.columns, n) for n in ("key_host", "key_path", "key_judged", "best_host", "best_path")]
    keyed = pages.withColumns({names[0]: host, names[1]: path})
    keys = keyed.select(F.col(names[0]).alias("h"), F.col(names[1]).alias("p")).distinct()
    spread = keys.select("h", "p", F.explode(F.array_distinct(expressions(F.col("h"), F.col("p"), shape["labels"] or 1, lengths or [0]))).alias("e"))
    spread = spread.withColumn("full", F.sha2("e", 256)).withColumn("short", F.substring("full", 1, PREFIX_HEX))
    fitting = spread.join(table, "short").where(F.col("full") == F.col("digest"))
    order = F.struct(
        F.length("rule"), F.length("rule_host"), F.struct("rule", "rule_verdict").alias("what")
    )
    best = fitting.groupBy("h", "p").agg(F.max(order).alias(names[2]))
    judged = keyed.join(
        best.select(F.col("h").alias(names[3]), F.col("p").alias(names[4]), names[2]),
        (F.col(names[0]) == F.col(names[3])) & (F.col(names[1]) == F.col(names[4])),
        "left",
    )
    return judged.withColumns(
        {
            "host": F.col(names[0]),
            "path": F.col(names[1]),
            "rule": F.col(f"{names[2]}.what.rule"),
            "verdict": F.coalesce(F.col(f"{names[2]}.what.rule_verdict"), F.lit(default)),
        }
    ).drop(*names)

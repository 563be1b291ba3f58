"""Quality rules: a threshold table compiled into one Spark projection, without user functions.

Each rule bounds a ratio of two text measures. The bounds are compared as whole numbers
(``scale * measure`` against ``bound * base``), so the verdict has no rounding. Measures are built-in expressions over the
text of one row; nothing is shuffled, so a hot source or a group of copies costs no more than any other rows.

Words are runs of anything but space and U+0009-U+000D. Null text has no words, no lines with a word and no symbols; it
fails the word minimum, as empty and blank texts do. Repeated rows are judged each on its own. Only the text column is
read; other columns pass through, and a column of the input that has the name of a result is replaced by the result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, fresh_name, let, space_words

SYMBOLS = "#*$%&|<>"

# Frequent function words of English, German, French and Spanish prose.
STOP_WORDS = (
    "the of and to in a is that it for was with as on be at by this from are not have or an "
    "der die und das den von zu mit sich des auf ist im dem nicht ein eine als auch es für "
    "de la le et les des en un une du que est pour qui dans par sur pas au plus avec "
    "el los las y por con para una su al lo como más del se"
).split()


@dataclass(frozen=True)
class Rule:
    """``low * base <= 100 * measure <= high * base``; a missing bound does not bind."""

    name: str
    measure: str
    base: str
    low: int | None = None
    high: int | None = None

    def passes(self, cols: dict[str, Column]) -> Column:
        value, base = F.lit(100) * cols[self.measure], cols[self.base]
        ok = F.lit(True)
        if self.low is not None:
            ok = ok & (value >= F.lit(self.low) * base)
        if self.high is not None:
            ok = ok & (value <= F.lit(self.high) * base)
        return ok


BASE_RULES = (
    Rule("enough_words", "n_words", "one", low=5000),
    Rule("few_repeats", "n_repeat_words", "n_words", high=50),
)
METHOD_RULES = (
    Rule("mean_word_length", "word_chars", "n_words", low=200, high=1500),
    Rule("symbol_ratio", "n_symbols", "n_words", high=10),
    Rule("stop_word_ratio", "n_stop_words", "n_words", low=4),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_text_lines", high=50),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_text_lines")


def repeated_window_words(words: Column, width: int = 3) -> Column:
    """Words that lie in a ``width``-word window found twice or more, the first one included.

    A window is its 64-bit hash with the low bits given to its place (as many as the place needs), so sorting plain
    longs brings equal windows together. Windows whose upper bits equal a neighbour's are then compared by their whole
    hash, and the places that remain are swept in order, each adding the words it does not share with the next.
    """

    def whole_hash(w: Column, i: Column) -> Column:
        return F.xxhash64(*[F.get(w, i + j) for j in range(width)])

    def measured(w: Column) -> Column:
        return let(F.greatest(F.ceil(F.log2(F.size(w).cast("double"))), F.lit(1)).cast("int"), lambda bits: packed(w, bits))

    def packed(w: Column, bits: Column) -> Column:
        keep = let_shift(bits)
        return let(
            keep,
            lambda mask: let(
                F.sort_array(
                    F.transform(
                        F.sequence(F.lit(0), F.size(w) - width),
                        lambda i: whole_hash(w, i).bitwiseAND(mask).bitwiseOR(i.cast("long")),
                    )
                ),
                lambda s: let(alike(s, mask), lambda near: of_places(w, near)),
            ),
        )

    def let_shift(bits: Column) -> Column:
        return F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - F.lit(1).cast("long"))

    def alike(s: Column, mask: Column) -> Column:
        pairs = F.zip_with(
            s,
            F.slice(s, F.lit(2), F.size(s)),
            lambda x, y: F.when(x.bitwiseXOR(y).bitwiseAND(mask) == 0, F.array(x, y)),
        )
        near = F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull())))
        return F.transform(near, lambda x: x.bitwiseAND(F.bitwise_not(mask)).cast("int"))

    def of_places(w: Column, near: Column) -> Column:
        by_hash = F.sort_array(F.transform(near, lambda p: F.struct(whole_hash(w, p).alias("h"), p.alias("p"))))
        return let(by_hash, swept)

    def swept(s: Column) -> Column:
        pairs = F.zip_with(
            s, F.slice(s, F.lit(2), F.size(s)), lambda x, y: F.when(x["h"] == y["h"], F.array(x["p"], y["p"]))
        )
        again = F.flatten(F.filter(pairs, lambda x: x.isNotNull()))
        return let(F.sort_array(F.array_distinct(again)), covered)

    def covered(places: Column) -> Column:
        steps = F.transform(
            places, lambda p, i: F.least(F.coalesce(F.get(places, i + 1) - p, F.lit(width)), F.lit(width))
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x)

    return F.when(F.size(words) <= width, F.lit(0).cast("long")).otherwise(let(words, measured))


def measures(text: Column) -> Column:
    """One struct with every measure of a text."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    bare = text
    for symbol in SYMBOLS:
        bare = F.replace(bare, F.lit(symbol), F.lit(""))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(bare)).cast("long").alias("n_symbols"),
            let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
            repeated_window_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: x.isin(*dict.fromkeys(STOP_WORDS)))).cast("long").alias("n_stop_words"),
            F.size(lines).cast("long").alias("n_text_lines"),
        )

    return let(space_words(text), of_words)


def apply_rules(
    docs: DataFrame,
    text_col: str = "text",
    base_rules: tuple[Rule, ...] = BASE_RULES,
    method_rules: tuple[Rule, ...] = METHOD_RULES,
) -> DataFrame:
    """Input columns plus the measures, ``base_failed``, ``failed_rules`` (names, in table order) and ``kept``."""
    m = fresh_name(docs.columns, "measures")
    out = docs.withColumn(m, measures(F.col(text_col)))
    cols = {name: F.col(f"{m}.{name}") for name in MEASURES} | {"one": F.lit(1).cast("long")}
    base_ok, method_ok = F.lit(True), F.lit(True)
    for rule in base_rules:
        base_ok = base_ok & rule.passes(cols)
    for rule in method_rules:
        method_ok = method_ok & rule.passes(cols)
    failed = F.filter(
        F.array(*[F.when(~r.passes(cols), F.lit(r.name)) for r in (*base_rules, *method_rules)]),
        lambda x: x.isNotNull(),
    )
    results = {name: cols[name] for name in MEASURES} | {
        "base_failed": ~base_ok,
        "failed_rules": failed,
        "kept": base_ok & method_ok,
    }
    return out.withColumns(results).drop(m)

"""Quality rules: a table of thresholds compiled into one Spark projection.

Each row of RULES names a measure of the text and the range it must lie in. `measures`
computes counts in the scan, `verdict` turns the table into one condition over them; there
are no user functions and nothing is shuffled.

Null and empty texts have counts of 0, fail the base rule and are not kept. Rows that
repeat are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.llm.text import GAP, fresh, let, words_of

MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"

#: Frequent words of the four languages.
STOP_WORDS = (
    "the of and to in that is was for with as by on be or are from this it at an "
    "de la le les des et que en un une du dans pour est par sur pas au avec se "
    "el los las y del una por con como su no lo "
    "der die das und den von zu mit ist dem nicht ein eine als auch auf sich im"
).split()


class Rule(NamedTuple):
    measure: str
    least: float | None
    most: float | None


RULES = (
    Rule("mean_word_chars", 2.0, 12.0),
    Rule("symbols_per_word", None, 0.2),
    Rule("stop_word_share", 0.03, None),
    Rule("duplicate_line_share", None, 0.5),
)


def _repeated_words(words: Column, window: int) -> Column:
    """Words inside windows that are found twice or more; windows are compared by a 64-bit hash.

    Sorting (hash, start) puts equal windows side by side; their starts, in order, add up
    to the words they cover.
    """
    def grams(w: Column) -> Column:
        return F.when(F.size(w) >= window, F.transform(
            F.sequence(F.lit(1), F.size(w) - window + 1), lambda i: F.xxhash64(F.slice(w, i, window))
        )).otherwise(F.array().cast("array<bigint>"))

    def starts(g: Column) -> Column:
        ordered = F.array_sort(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twins(s: Column) -> Column:
            last = F.size(s) - 1

            def twice(x: Column, k: Column) -> Column:
                before = (k > 0) & (F.get(s, k - 1)["h"] == x["h"])
                after = (k < last) & (F.get(s, k + 1)["h"] == x["h"])
                return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

            return F.array_sort(F.transform(F.filter(s, twice), lambda x: x["i"]))

        return let(ordered, twins)

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(at, k + 1) - x, F.lit(window))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def counted(g: Column) -> Column:
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(let(starts(g), covered))

    return let(let(words, grams), counted).cast("long")


def measures(text: Column, words: Column) -> dict[str, Column]:
    """Counts of one text; `words` is the column with its words."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.regexp_replace(x, GAP, "")) > 0)
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.regexp_replace(text, GAP, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": _repeated_words(words, REPEAT_WINDOW),
        "n_lines": let(lines, F.size).cast("long"),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long"),
    }


RATIOS = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "stop_word_share": ("n_stop_words", "n_words"),
    "duplicate_line_share": ("n_dup_lines", "n_lines"),
    "repeated_word_share": ("n_repeat_words", "n_words"),
}


def verdict(rules: Sequence[Rule], counts: dict[str, Column]) -> Column:
    """All rules hold; a ratio over nothing counts as 0."""
    holds = F.lit(True)
    for rule in rules:
        if rule.measure in RATIOS:
            top, bottom = (counts[c] for c in RATIOS[rule.measure])
            value = F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))
        else:
            value = counts[rule.measure]
        if rule.least is not None:
            holds = holds & (value >= rule.least)
        if rule.most is not None:
            holds = holds & (value <= rule.most)
    return holds


def judged(docs: DataFrame, *, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """`docs` with the counts, base_failed and kept."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words"]
    words, failed, kept, *own = fresh(docs, "_words", "base_failed", "kept", *names)
    cut = docs.withColumn(words, words_of(F.col(f"`{text}`")))
    counts = measures(F.col(f"`{text}`"), F.col(words))
    cut = cut.withColumns({mine: counts[name] for mine, name in zip(own, names)})
    at = {name: F.col(mine) for mine, name in zip(own, names)}
    cut = cut.withColumn(failed, (at["n_words"] < MIN_WORDS) | (at["n_repeat_words"] * 100 > at["n_words"] * REPEAT_PERCENT))
    return cut.withColumn(kept, ~F.col(failed) & verdict(rules, at)).drop(words)

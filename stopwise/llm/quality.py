"""Quality rules as a short-circuit cascade, ordered by rejections per unit of cost.

Each rule is a predicate that is true for a text to reject. A sample shows what a rule costs and
how much of what is left it rejects; the rules then run in the order of rejections per cost, and
a text stops at the first that rejects it. The order decides how long the work takes, never the
verdict: a text is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.llm.text import let, words_of, written

SAMPLE_ROWS = 2_000
FEW_REPEATS = 32

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A text fails where ``fails`` (SQL over the text and its measures) is true."""

    name: str
    fails: str


# Thresholds of the usual web-text rules, with room for languages of longer words. Each looks at
# the text through one pass of a simple pattern at most.
RULES = (
    Rule("short_or_long_words", "word_chars < 2 * n_words or word_chars > 16 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 3 * (1 + length(text) - length(replace(text, '\\n', '')))"),
    Rule("shouting", "10 * (length(text) - length(regexp_replace(text, '[A-Z]+', ''))) > 3 * word_chars"),
    Rule("exclamations", "5 * (length(text) - length(replace(text, '!', ''))) > n_words"),
    Rule("digits", "10 * (length(text) - length(regexp_replace(text, '[0-9]+', ''))) > 2 * word_chars"),
)


def _window_hashes(words: Column) -> Column:
    return F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )


def _repeat_starts(hashes: Column) -> Column:
    """The sorted positions of windows whose hash occurs again.

    Sorted hashes show which repeat: they equal a neighbour. Few of them are looked up one by
    one; where many repeat, hashes are sorted with their positions instead.
    """

    def found(repeated: Column) -> Column:
        looked_up = F.filter(
            F.transform(hashes, lambda h, i: F.when(F.array_contains(repeated, h), i)),
            lambda i: i.isNotNull(),
        )
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return (
            F.when(F.size(repeated) == 0, F.array().cast("array<int>"))
            .when(F.size(repeated) <= FEW_REPEATS, looked_up)
            .otherwise(let(placed, _positions_of_equal))
        )

    def repeated_of(ordered: Column) -> Column:
        return F.array_distinct(F.filter(ordered, lambda h, i: F.get(ordered, i + 1) == h))

    return let(let(F.sort_array(hashes), repeated_of), found)


def _positions_of_equal(placed: Column) -> Column:
    twice = F.filter(
        placed,
        lambda g, i: (F.get(placed, i - 1)["h"] == g["h"]) | (F.get(placed, i + 1)["h"] == g["h"]),
    )
    return F.sort_array(F.transform(twice, lambda g: g["p"]))


def _covered(starts: Column) -> Column:
    """Words in windows of three at sorted ``starts``: each adds what the next does not cover."""
    return F.aggregate(
        F.transform(
            starts,
            lambda p, i: F.least(F.lit(3), F.coalesce(F.get(starts, i + 1) - p, F.lit(3))),
        ),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the five measures of its text; a null text counts as an empty one.

    Repeated words are found inside each row: the hashes of its three-word windows are sorted
    with their positions, neighbours of equal hash are repeats, and the words covered by a
    repeat follow from the distance to the next one. Nothing is exploded or shuffled.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    spoken = F.filter(F.split(body, "\n"), lambda line: line.rlike("[^ \\t-\\r]"))
    symbols = F.length(body) - F.length(F.regexp_replace(body, "[#*$%&|<>]", ""))

    def of_words(words: Column) -> Column:
        starts = let(_window_hashes(words), _repeat_starts)
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            let(starts, _covered).alias("n_repeat_words"),
        )

    counts = F.col("_counts")
    return (
        df.withColumn("_counts", let(words_of(F.col(text)), of_words))
        .withColumn("n_words", counts["n_words"])
        .withColumn("word_chars", counts["word_chars"])
        .withColumn("n_symbols", symbols.cast("long"))
        .withColumn(
            "n_dup_lines",
            let(spoken, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        )
        .withColumn("n_repeat_words", counts["n_repeat_words"])
        .drop("_counts")
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def cascade_order(
    spark: SparkSession, docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS
) -> list[Rule]:
    """The rules in the order of rejections per second on a sample.

    About ``sample_rows`` of all texts are drawn and measured, so
    trying the rules costs the same for every corpus. Rejections are counted among the rows that
    the rules chosen before let pass.
    """
    share = min(1.0, sample_rows / max(1, docs.count()))
    sample = written(spark, measured(docs.sample(share, seed=0)), "quality-sample")
    sample = sample.where(~base_failed())
    seconds = {}
    for rule in rules:
        started = time.perf_counter()
        sample.agg(F.count_if(F.expr(rule.fails))).first()
        seconds[rule.name] = max(time.perf_counter() - started, 1e-6)
    ordered, left = [], list(rules)
    while left:
        passing = sample
        for rule in ordered:
            passing = passing.where(~F.expr(rule.fails))
        counts = passing.agg(*[F.count_if(F.expr(r.fails)).alias(r.name) for r in left]).first()
        best = max(left, key=lambda r: (counts[r.name] / seconds[r.name], -seconds[r.name]))
        ordered.append(best)
        left.remove(best)
    return ordered


def first_rejection(rules) -> Column:
    """The name of the first rule that rejects a text, or null. CASE stops at the first."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(list(rules)):
        verdict = F.when(F.expr(rule.fails), F.lit(rule.name)).otherwise(verdict)
    return verdict


def judged(spark: SparkSession, docs: DataFrame, rules=RULES, sample_rows=SAMPLE_ROWS) -> DataFrame:
    """Every row of ``docs`` with its measures, ``base_failed`` and ``kept``.

    A null text is judged as an empty one, which fails for having fewer than 50 words. An empty
    table gives an empty result. Columns named like a measure are replaced.
    """
    body = docs.drop(*MEASURES, "base_failed", "kept").withColumn(
        "text", F.coalesce(F.col("text"), F.lit(""))
    )
    order = cascade_order(spark, body.select("text"), rules, sample_rows)
    return measured(body).withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & first_rejection(order).isNull()
    )

"""A quality classifier made of rules: conjunctions over statistics of a text, with lasso weights.

1. Each text becomes twelve statistics, all Spark column expressions over the whole text.
2. A forest of shallow trees is fitted on labelled rows. Every path from a root to a node is a
   conjunction of bounds; bounds on one statistic are merged and equal conjunctions kept once.
3. A logistic regression with an L1 penalty weighs the rules and drops most. Each of ``PENALTIES`` is
   a task of its own; the one taken has the least log loss on a fifth of the training rows that it
   is not fitted on.
4. The rules that are left, their weights and the intercept are compiled into one column
   expression. Scoring a corpus reads each text once, shuffles nothing and starts no Python.

Training uses up to about ``TRAINING_ROWS`` rows of each label, drawn by a hash of the row; all else
covers every row.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise.llm.text import let, words_of, written

TRAINING_ROWS = 20_000
TREES = 24
DEPTH = 3
LEAST_ROWS = 8
PENALTIES = (0.02, 0.005, 0.001)
ITERATIONS = 2_000
SEED = 11
INFINITY = math.inf

STATISTICS = (
    "log_words", "word_length", "capitals", "digits", "marks", "bars", "exclamations", "stops",
    "distinct_words", "repeats_last", "log_line_words", "repeated_lines",
)


def statistics(text: Column) -> Column:
    """A struct of ``STATISTICS``, all double and never null; a null text counts as empty."""
    body = F.coalesce(text, F.lit(""))

    def share(pattern: str) -> Column:
        left = F.length(F.regexp_replace(body, f"{pattern}+", ""))
        return (F.length(body) - left) / F.greatest(F.length(body), F.lit(1))

    def character(one: str) -> Column:
        left = F.length(F.replace(body, F.lit(one), F.lit("")))
        return (F.length(body) - left) / F.greatest(F.length(body), F.lit(1))

    def of_words(words: Column) -> Column:
        n = F.greatest(F.size(words), F.lit(1))
        again = F.filter(words, lambda word, i: word == F.get(words, i - 1))
        return F.struct(
            F.size(words).alias("n"),
            (F.length(F.array_join(words, "")) / n).alias("word_length"),
            F.when(F.size(words) == 0, 1.0).otherwise(F.size(F.array_distinct(words)) / n).alias("distinct"),
            (F.size(again) / n).alias("repeats_last"),
        )

    def of_lines(lines: Column) -> Column:
        n = F.greatest(F.size(lines), F.lit(1))
        return F.struct(
            n.alias("n"), ((F.size(lines) - F.size(F.array_distinct(lines))) / n).alias("repeated")
        )

    spoken = F.filter(F.split(body, "\n"), lambda line: line.rlike("[^ \\t-\\r]"))

    def together(parts: Column) -> Column:
        words, lines = parts["words"], parts["lines"]
        return F.struct(
            F.log1p(words["n"]).alias("log_words"),
            words["word_length"].alias("word_length"),
            parts["capitals"].alias("capitals"),
            parts["digits"].alias("digits"),
            parts["marks"].alias("marks"),
            parts["bars"].alias("bars"),
            parts["exclamations"].alias("exclamations"),
            parts["stops"].alias("stops"),
            words["distinct"].alias("distinct_words"),
            words["repeats_last"].alias("repeats_last"),
            F.log1p(words["n"] / lines["n"]).alias("log_line_words"),
            lines["repeated"].alias("repeated_lines"),
        )

    return let(
        F.struct(
            let(words_of(body), of_words).alias("words"),
            let(spoken, of_lines).alias("lines"),
            share("\\p{Lu}").alias("capitals"),
            share("[0-9]").alias("digits"),
            share("[#$%&*]").alias("marks"),
            character("|").alias("bars"),
            character("!").alias("exclamations"),
            share("[.,;:?]").alias("stops"),
        ),
        together,
    )


@dataclass(frozen=True)
class Rule:
    """True where each of ``bounds`` (statistic, low, high) holds: low < value <= high."""

    bounds: tuple[tuple[str, float, float], ...]

    def column(self, of: Column) -> Column:
        met = F.lit(True)
        for name, low, high in self.bounds:
            if low > -INFINITY:
                met = met & (of[name] > low)
            if high < INFINITY:
                met = met & (of[name] <= high)
        return met

    def __str__(self) -> str:
        parts = []
        for name, low, high in self.bounds:
            parts.append((f"{low:.4g} < " if low > -INFINITY else "") + name + (f" <= {high:.4g}" if high < INFINITY else ""))
        return " and ".join(parts)


@dataclass(frozen=True)
class Ensemble:
    """Weighted rules; the score is the logistic function of their sum and the intercept."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...] = ()

    def column(self, of: Column) -> Column:
        """The score (0 to 1) as one expression over a struct of ``STATISTICS``."""
        total = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            total = total + F.when(rule.column(of), F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


# One line of a tree as Spark ML prints it; the indentation is the depth.
_BRANCH = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def tree_rules(printed: str, names=STATISTICS) -> list[Rule]:
    """All paths of the trees in a printed forest, in order of first mention, each once."""
    found: dict[Rule, None] = {}
    path: list[tuple[int, str, float, float]] = []
    for line in printed.splitlines():
        branch = _BRANCH.match(line)
        if not branch:
            if line.lstrip().startswith("Tree "):
                path = []
            continue
        depth, name, threshold = len(branch[1]), names[int(branch[2])], float(branch[4])
        path = [step for step in path if step[0] < depth]
        path.append((depth, name, *((-INFINITY, threshold) if branch[3] == "<=" else (threshold, INFINITY))))
        merged: dict[str, tuple[float, float]] = {}
        for _, of, low, high in path:
            before = merged.get(of, (-INFINITY, INFINITY))
            merged[of] = (max(before[0], low), min(before[1], high))
        found[Rule(tuple((of, *merged[of]) for of in sorted(merged)))] = None
    return list(found)


def _logit(share: float) -> float:
    share = min(max(share, 1e-4), 1 - 1e-4)
    return math.log(share / (1 - share))


def lasso(marks: np.ndarray, labels: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Intercept and weights with the least mean log loss plus ``penalty`` times the sum of the
    weights' sizes, each taken by the spread of its column; by accelerated proximal steps."""
    rows, n = np.unique(np.column_stack([marks, labels]), axis=0, return_counts=True)
    x, y, share = rows[:, :-1].astype(float), rows[:, -1].astype(float), n / n.sum()
    mean = share @ x
    spread = np.sqrt(share @ (x - mean) ** 2)
    x = np.divide(x - mean, spread, out=np.zeros_like(x), where=spread > 0)
    # A step no longer than one over the curvature: a quarter of the largest eigenvalue.
    along = np.ones(x.shape[1])
    for _ in range(30):
        along = x.T @ (share * (x @ along))
        size = np.linalg.norm(along)
        if size == 0:
            break
        along /= size
    step = 1.0 / (0.25 * max(1.0, 1.1 * np.linalg.norm(np.sqrt(share)[:, None] * x @ along[:, None]) ** 2))
    base = _logit(float(share @ y))
    w, b = np.zeros(x.shape[1]), base
    ahead_w, ahead_b, pace = w, b, 1.0
    for _ in range(ITERATIONS):
        miss = share * (1.0 / (1.0 + np.exp(-(x @ ahead_w + ahead_b))) - y)
        moved = ahead_w - step * (x.T @ miss)
        new_w = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0.0)
        new_b = ahead_b - step * miss.sum()
        new_pace = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        push = (pace - 1) / new_pace
        ahead_w, ahead_b = new_w + push * (new_w - w), new_b + push * (new_b - b)
        change = max(np.abs(new_w - w).max(initial=0.0), abs(new_b - b))
        w, b, pace = new_w, new_b, new_pace
        if change < 1e-7:
            break
    weights = np.divide(w, spread, out=np.zeros_like(w), where=spread > 0)
    return float(b - mean @ weights), weights


def log_loss(scores: np.ndarray, labels: np.ndarray) -> float:
    """The mean over rows; infinite without any."""
    right = np.where(labels == 1, scores, 1 - scores)
    return float(-np.log(np.maximum(right, 1e-9)).mean()) if len(right) else math.inf


def _weighed(rows: DataFrame, rules: list[Rule]) -> Ensemble:
    marks = F.array(*[rule.column(F.col("stats")).cast("boolean") for rule in rules])
    judging = F.pmod(F.xxhash64("at"), F.lit(5)) == 0
    trials = rows.select(
        "label", judging.alias("judging"), marks.alias("marks"), F.explode(F.array(*map(F.lit, PENALTIES))).alias("penalty")
    )

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        x, y = np.stack(frame["marks"].to_numpy()).astype(bool), frame["label"].to_numpy()
        judged, penalty = frame["judging"].to_numpy(), float(frame["penalty"].iloc[0])
        b, w = lasso(x[~judged], y[~judged], penalty) if not judged.all() else (0.0, np.zeros(len(rules)))
        loss = log_loss(1 / (1 + np.exp(-(x[judged] @ w + b))), y[judged])
        b, w = lasso(x, y, penalty)
        return pd.DataFrame({"penalty": [penalty], "loss": [loss], "intercept": [b], "weights": [w]})

    fitted = trials.groupBy("penalty").applyInPandas(
        fit, "penalty double, loss double, intercept double, weights array<double>"
    )
    best = min(fitted.collect(), key=lambda row: (row["loss"], -row["penalty"]))
    return Ensemble(best["intercept"], tuple((r, w) for r, w in zip(rules, best["weights"]) if w))


def _draw(of: list[Column], seed: int) -> Column:
    """A number from 0 to 1 that only depends on the values given."""
    return F.pmod(F.xxhash64(*of, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)


def _shares(rows: DataFrame, most: int) -> dict[float, tuple[int, float]]:
    """Per label its number of rows, and the share that leaves about ``most`` of them."""
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["label"]: (r["n"], min(1.0, most / r["n"])) for r in counts}


def _thinned(rows: DataFrame, draw: Column, shares: dict[float, tuple[int, float]]) -> DataFrame:
    return rows.where(draw < F.when(F.col("label") == 1.0, shares[1.0][1]).otherwise(shares[0.0][1]))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, text: str = "text") -> Ensemble:
    """An ensemble from documents (``doc_id``, ``text``) and ``doc_id, label``.

    Labels other than 0 and 1 and rows without an id are left out. Up to about ``rows`` ids of each
    label are drawn by a hash, and sent to the documents, whose texts stay where they are; where ids
    repeat, the rows found are drawn from once more. With rows of one label only, every score is
    near that label; with none, it is a half.
    """
    spark = docs.sparkSession
    marks = labels.where("label in (0, 1) and doc_id is not null").select(
        F.col("doc_id").alias("_of"), F.col("label").cast("double").alias("label")
    ).distinct()
    ids = _shares(marks, rows)
    if not {0.0, 1.0} - ids.keys():
        # At most about twice ``rows`` pairs of numbers.
        marks = _thinned(marks, _draw([F.col("_of")], SEED), ids)
        found = docs.join(F.broadcast(marks), F.col("doc_id") == F.col("_of")).select(
            "label", _draw([F.col("doc_id"), F.col(text)], SEED + 1).alias("at"),
            statistics(F.col(text)).alias("stats"),
        )
        found = written(spark, found, "rule-statistics")
        drawn = _shares(found, rows)
    else:
        drawn = {label: (0, 1.0) for label in ids}
    if {0.0, 1.0} - drawn.keys():
        return Ensemble(_logit(1.0 if 1.0 in drawn else 0.0) if drawn else 0.0)
    # Labels are thinned each by its own share; the odds are put right afterwards.
    shift = math.log(ids[0.0][1] * drawn[0.0][1]) - math.log(ids[1.0][1] * drawn[1.0][1])
    # One small partition in one order: the same rows always give the same model.
    drawn_rows = _thinned(found, _draw([F.col("at"), F.col("stats")], SEED + 2), drawn)
    drawn_rows = written(spark, drawn_rows.orderBy("at", "label", "stats").coalesce(1), "rule-training")
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="values").transform(
        drawn_rows.select("label", "stats.*")
    )
    forest = RandomForestRegressor(
        featuresCol="values", labelCol="label", numTrees=TREES, maxDepth=DEPTH,
        minInstancesPerNode=LEAST_ROWS, featureSubsetStrategy="onethird", seed=SEED,
    ).fit(vectors)
    rules = tree_rules(forest.toDebugString)
    if not rules:
        bad, good = (drawn[label][0] * drawn[label][1] for label in (0.0, 1.0))
        return Ensemble(_logit(good / (good + bad)) + shift)
    model = _weighed(drawn_rows, rules)
    return Ensemble(model.intercept + shift, model.rules)


def scored(docs: DataFrame, model: Ensemble, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with ``score``: how likely its text has label 1. A column of that name is replaced.

    A null text is scored as an empty one; rows that repeat are scored alike; an empty table gives
    an empty result. No other column has a part in it.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != score.lower()]
    row = F.struct(F.lit(0).alias("_"), *kept).alias("row")
    return docs.select(row, statistics(F.col(f"`{text}`")).alias("stats")).select(
        *[F.col("row")[c].alias(c) for c in docs.columns if c.lower() != score.lower()],
        model.column(F.col("stats")).alias(score),
    )

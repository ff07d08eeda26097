"""The rule ensemble: statistics and compiled scores against plain Python, held-out accuracy."""

from __future__ import annotations

import math
import re

import numpy as np
import pytest
from conftest import SMALL, plan_of
from llm_cases import ODD_TEXTS, documents  # noqa: F401
from pyspark.sql import functions as F

from stopwise.llm import language, rule_ensemble
from stopwise.llm.rule_ensemble import Ensemble, Rule

MEDIUM = "/root/testdata/sf0.01"
GAP = re.compile("[\x20\x09-\x0d]+")


def plain_statistics(text):
    text = text or ""
    words = [w for w in GAP.split(text) if w]
    lines = [x for x in text.split("\n") if re.search("[^ \t-\r]", x)]
    n, k, chars = max(len(words), 1), max(len(lines), 1), max(len(text), 1)
    return {
        "log_words": math.log1p(len(words)),
        "word_length": sum(map(len, words)) / n,
        "capitals": sum(c.isupper() for c in text) / chars,
        "digits": len(re.findall("[0-9]", text)) / chars,
        "marks": len(re.findall("[#$%&*]", text)) / chars,
        "bars": text.count("|") / chars,
        "exclamations": text.count("!") / chars,
        "stops": len(re.findall("[.,;:?]", text)) / chars,
        "distinct_words": len(set(words)) / n if words else 1.0,
        "repeats_last": sum(a == b for a, b in zip(words, words[1:])) / n,
        "log_line_words": math.log1p(len(words) / k),
        "repeated_lines": (len(lines) - len(set(lines))) / k,
    }


def plain_score(model, stats):
    total = model.intercept
    for rule, weight in model.rules:
        total += weight if all(low < stats[of] <= high for of, low, high in rule.bounds) else 0.0
    return 1 / (1 + math.exp(-total))


def test_statistics_agree(spark, documents):
    texts = [t for _, t in ODD_TEXTS] + ["A|b! 12\n#x, y;", "No. NO. no.\nNo. NO. no.\n\n*", "É é ÉÉ\tz z z"]
    rows = documents(list(enumerate(texts))).select("doc_id", "text", rule_ensemble.statistics(F.col("text")).alias("s"))
    for row in rows.collect():
        want = plain_statistics(row["text"])
        assert list(row["s"].asDict()) == list(rule_ensemble.STATISTICS)
        for name, value in row["s"].asDict().items():
            assert value == pytest.approx(want[name], abs=1e-12), (row["doc_id"], name)


def test_paths_of_trees_become_rules():
    printed = """RandomForestRegressionModel: uid=x, numTrees=2, numFeatures=12
  Tree 0 (weight 1.0):
    If (feature 4 <= 0.5)
     If (feature 4 <= 0.25)
      Predict: 0.1
     Else (feature 4 > 0.25)
      Predict: 0.2
    Else (feature 4 > 0.5)
     Predict: 1.0E-4
  Tree 1 (weight 1.0):
    If (feature 4 <= 0.5)
     Predict: 0.5
    Else (feature 4 > 0.5)
     If (feature 0 <= 1.0E-3)
      Predict: 0.1
     Else (feature 0 > 1.0E-3)
      Predict: 0.2
"""
    inf = math.inf
    assert [rule.bounds for rule in rule_ensemble.tree_rules(printed)] == [
        (("marks", -inf, 0.5),),
        (("marks", -inf, 0.25),),
        (("marks", 0.25, 0.5),),
        (("marks", 0.5, inf),),
        (("log_words", -inf, 0.001), ("marks", 0.5, inf)),
        (("log_words", 0.001, inf), ("marks", 0.5, inf)),
    ]
    assert str(rule_ensemble.tree_rules(printed)[2]) == "0.25 < marks <= 0.5"


def test_compiled_scores_agree(spark, documents):
    model = Ensemble(-0.5, (
        (Rule((("log_words", 0.5, 2.0),)), 1.5),
        (Rule((("bars", -math.inf, 0.0), ("word_length", 1.0, math.inf))), -2.0),
        (Rule((("repeated_lines", 0.1, 0.9), ("distinct_words", -math.inf, 0.8))), 0.7),
    ))
    df = documents(ODD_TEXTS, score=F.lit("old"), row=F.lit(1), stats=F.lit(2))
    out = rule_ensemble.scored(df, model)
    assert sorted(out.columns) == sorted(df.columns)
    for row in out.collect():
        assert row["score"] == pytest.approx(plain_score(model, plain_statistics(row["text"])), abs=1e-12)
        assert (row["row"], row["stats"]) == (1, 2)
    plan = plan_of(out)
    assert not any(word in plan for word in ("Python", "Exchange", "Arrow"))


@pytest.fixture(scope="module")
def judged(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text")
    marks = spark.read.parquet(f"{MEDIUM}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    model = rule_ensemble.train(docs, marks.where(~language.held_out()))
    return docs, marks, model


def test_held_out_accuracy(judged):
    docs, marks, model = judged
    out = rule_ensemble.scored(docs.join(marks, "doc_id").where(language.held_out()), model)
    out = out.select("label", "score").collect()
    good = [r["score"] for r in out if r["label"] == 1]
    bad = [r["score"] for r in out if r["label"] == 0]
    assert len(good) > 40 and len(bad) > 5
    better = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert better >= 0.97
    assert sum(g >= 0.3 for g in good) >= 0.97 * len(good)
    assert sum(b < 0.3 for b in bad) >= 0.9 * len(bad)


def test_the_ensemble_is_sparse_and_repeatable(judged):
    docs, marks, model = judged
    assert 1 <= len(model.rules) <= 60
    # Held-out labels change nothing, nor does how the rows lie.
    flipped = marks.withColumn("label", F.when(language.held_out(), 1 - F.col("label")).otherwise(F.col("label")))
    again = rule_ensemble.train(docs.repartition(3), flipped.where(~language.held_out()).repartition(2))
    assert again == model


def test_more_rows_than_are_drawn(judged):
    docs, marks, whole = judged
    model = rule_ensemble.train(docs.unionAll(docs), marks, rows=40)
    assert model != whole
    clean, shouted = plain_statistics("A few words of a text. " * 20), plain_statistics("LOUD!! " * 200)
    assert plain_score(model, clean) > plain_score(model, shouted) or not model.rules


def test_lasso_finds_the_least_loss():
    draw = np.random.default_rng(3)
    marks = draw.random((400, 6)) < [0.5, 0.3, 0.5, 0.1, 0.5, 0.5]
    marks[:, 5] = True
    labels = (draw.random(400) < 1 / (1 + np.exp(-(2.0 * marks[:, 0] - 3.0 * marks[:, 1] + 0.5)))).astype(float)
    spread = marks.std(axis=0)

    def loss(b, w, penalty):
        p = 1 / (1 + np.exp(-(marks @ w + b)))
        return rule_ensemble.log_loss(p, labels) + penalty * (np.abs(w) * spread).sum()

    for penalty in (0.001, 0.02, 0.08):
        b, w = rule_ensemble.lasso(marks, labels, penalty)
        assert w[5] == 0 and (np.sign(w[:2]) == [1, -1]).all()
        best = loss(b, w, penalty)
        for _ in range(300):
            assert loss(b + draw.normal(0, 0.02), w + draw.normal(0, 0.02, 6), penalty) >= best - 1e-9
    assert (w[2:] == 0).all()


def test_labels_of_one_kind_or_none(spark, documents):
    docs = documents(ODD_TEXTS)
    for label, want in ((1, 0.9999), (0, 0.0001), (7, 0.5), (None, 0.5)):
        marks = docs.select("doc_id", F.lit(label).cast("int").alias("label"))
        scores = {r["score"] for r in rule_ensemble.scored(docs, rule_ensemble.train(docs, marks)).collect()}
        assert [round(s, 6) for s in scores] == [want]
    both = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, label int")
    assert rule_ensemble.train(documents([]), both) == Ensemble(0.0)
    assert rule_ensemble.train(docs, both.where("false")) == Ensemble(0.0)


def test_labels_without_pattern(spark, documents):
    """Texts that do not differ leave a tree nothing to split."""
    docs = documents([(k, "same words") for k in range(40)])
    marks = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("label"))
    model = rule_ensemble.train(docs, marks)
    assert model.rules == () and 1 / (1 + math.exp(-model.intercept)) == pytest.approx(0.25)

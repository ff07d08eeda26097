"""Queries against their SQL, and every operator on odd tables."""

from __future__ import annotations

import pytest
from conftest import SMALL
from llm_cases import ODD_TEXTS, documents  # noqa: F401
from pyspark.sql import functions as F

from stopwise.llm import (
    fingerprints,
    language,
    line_dedup,
    mixing,
    ngram_join,
    pieces,
    quality,
    rule_ensemble,
    secret_scan,
    substring_dedup,
    url_filter,
)
from stopwise.llm.oracle import ORACLE
from stopwise.llm.queries import PIECES, REGISTRY, URL_RULES
from stopwise_testbed import compare


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, monkeypatch, name):
    monkeypatch.setattr(compare, "REGISTRY", REGISTRY)
    monkeypatch.setattr(compare, "ORACLE", ORACLE)
    assert compare.check(spark, compare.connect(SMALL), name, SMALL) is None


def test_all_operators_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in REGISTRY) == list(range(1, 14))


# Operator -> (what it returns for a table of documents, whether it keeps the table's columns).
OPERATORS = {
    "fingerprints": (lambda s, d: fingerprints.with_next_edited(d, rows_a_part=3), False),
    "secrets": (secret_scan.scan, False),
    "pieces": (lambda s, d: pieces.encode(d, pieces.Vocabulary.load(PIECES)), True),
    "urls": (lambda s, d: url_filter.filter_urls(d, URL_RULES, url="text"), True),
    "lines": (lambda s, d: line_dedup.line_dedup(d), True),
    "substrings": (lambda s, d: substring_dedup.substring_dedup(d, docs_a_shard=4), True),
    "quality": (lambda s, d: quality.judged(s, d), True),
    "language": (lambda s, d: language.identify(d, language.train(d)), True),
    "ensemble": (lambda s, d: rule_ensemble.scored(d, rule_ensemble.Ensemble(0.0)), True),
    "mixing": (lambda s, d: mixing.mix(mixing.sized_documents(d)), False),
    "ngrams": (lambda s, d: ngram_join.joined(d), False),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_texts_and_clashing_columns(spark, documents, name):
    run, keeps = OPERATORS[name]
    clashing = ("kept", "verdict", "score", "n_words", "key", "ids", "x", "token", "start", "part")
    rows = [(i, t, "en" if k % 2 else None, f"s{k % 3}" if k % 4 else None)
            for k, (i, t) in enumerate(ODD_TEXTS)]
    df = documents(rows, **{c: F.lit(1) for c in clashing})
    out = run(spark, df)
    result = out.collect()
    if name != "secrets":
        assert len(result) == len(ODD_TEXTS)
    if keeps:
        assert set(df.columns) <= set(out.columns)
    assert len(set(c.lower() for c in out.columns)) == len(out.columns)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, documents, name):
    run, _ = OPERATORS[name]
    assert run(spark, documents([])).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_all_texts_null(spark, documents, name):
    run, _ = OPERATORS[name]
    rows = run(spark, documents([(1, None), (2, None), (None, None)])).collect()
    assert len(rows) == (0 if name == "secrets" else 3)


@pytest.mark.parametrize("name", ["op2", "op4", "op5", "op7"])
def test_native_operators_have_no_python_in_their_plans(spark, name):
    query = next(q for n, q in REGISTRY.items() if n.startswith(name))
    plan = query(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))

"""The filter audit against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from llm_cases import ODD_TEXTS, documents  # noqa: F401
from pyspark.sql import functions as F

from stopwise.llm import filter_audit as audit

GAP = re.compile("[\x20\x09-\x0d]+")
LABELS = "doc_id long, quality int, toxic int"


def plain_measures(text):
    words = [w for w in GAP.split(text or "") if w]
    text = text or ""
    return (
        len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text),
        len(re.findall(r"[#$%&*|]", text)),
    )


def plain_audit(rows, labels):
    """rows of (doc_id, text, source)."""
    failing = []
    for doc_id, text, source in rows:
        words, distinct, capitals, points, symbols = plain_measures(text)
        smaller = [
            i for i, t, _ in rows
            if i is not None and doc_id is not None and i < doc_id and (t or "") == (text or "")
        ]
        out = {
            "A": words < 200, "B": 100 * distinct < 50 * words, "C": 100 * capitals > 2 * points,
            "D": symbols > 0, "E": bool(smaller),
        }
        good = any(i == doc_id and q == 1 for i, q, _ in labels if i is not None)
        toxic = any(i == doc_id and t == 1 for i, _, t in labels if i is not None)
        failing.append((source or "", {k for k, v in out.items() if v}, good, toxic))
    result = {}
    for part in {f[0] for f in failing}:
        own = [f for f in failing if f[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, letter in enumerate(order, 1):
                removed = [f for f in left if letter in f[1]]
                before = set(order[: step - 1])
                gone = [f for f in own if letter in f[1] and before & f[1]]
                left = [f for f in left if letter not in f[1]]
                shapley[letter] += len(removed)
                result[part, order, step] = [
                    len(left), len(removed), len(gone), sum(f[1] == {letter} for f in own),
                    sum(f[2] for f in removed), sum(f[3] for f in removed),
                ]
        for (p, order, step), values in result.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in result.items()}


def spark_audit(df):
    return {
        (r["part"], r["filter_order"], r["step"]): tuple(
            r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
        )
        for r in df.collect()
    }


def test_the_transducer_counts_what_patterns_count():
    random.seed(1)
    texts = [t for _, t in ODD_TEXTS] + ["A#b é É\tÉ é", " a", "a "]
    texts += ["".join(random.choices("aAb# \n\té日😀| ", k=random.randrange(60))) for _ in range(2000)]
    numbers, digests = audit.measures_of(pa.array(texts))
    for k, text in enumerate(texts):
        assert tuple(int(n[k]) for n in numbers) == plain_measures(text)
        assert digests[k] == hashlib.sha256((text or "").encode()).digest()


def test_sliced_and_empty_batches():
    texts = pa.array(["one two", None, "A  A", "", "Z"])
    assert [n.tolist() for n in audit.measures_of(texts.slice(2, 3))[0]] == [
        [2, 0, 1], [1, 0, 1], [2, 0, 1], [4, 0, 1], [0, 0, 0]
    ]
    assert [len(n) for n in audit.measures_of(pa.array([], pa.string()))[0]] == [0] * 5


@pytest.mark.parametrize("keep", [0, 1, 3])
def test_the_hash_table_compares_words_not_hashes(keep):
    """With hashes of ``keep`` bits nearly all words collide, and none is taken for another."""
    random.seed(2)
    words = ["".join(random.choices("abc", k=random.randrange(1, 5))) for _ in range(400)]
    owner = np.sort(np.random.default_rng(0).integers(0, 5, 400))
    body = np.frombuffer("".join(words).encode(), np.uint8)
    end = np.cumsum([len(w) for w in words])
    begin = end - np.array([len(w) for w in words])
    hashes = audit._hashes(body, begin, end) & np.uint64((1 << keep) - 1)
    first = audit.distinct_words(body, begin, end, owner, hashes)
    seen, want = set(), []
    for who, word in zip(owner.tolist(), words):
        want.append((who, word) not in seen)
        seen.add((who, word))
    assert first.tolist() == want


def test_audit_agrees_with_applying_all_orders(spark, documents):
    random.seed(4)
    bodies = ["", "a b", "word " * 250, " ".join(f"w{k}" for k in range(220)),
              " ".join(f"W{k}" for k in range(220)), " ".join(f"v{k}" for k in range(220)) + " #",
              "LOUD " * 210 + "*"]
    rows = [(random.choice([None, *range(60)]), random.choice([*bodies, None]), random.choice(["x", "y", "", None]))
            for _ in range(150)]
    labels = [(random.choice([None, *range(60)]), random.choice([0, 1, None]), random.choice([0, 1, None]))
              for _ in range(80)]
    docs = documents([(i, t, "en", s) for i, t, s in rows], part=F.lit("clash"), n_words=F.lit(1), good=F.lit(True))
    found = spark_audit(audit.audited(docs, spark.createDataFrame(labels, LABELS)))
    assert found == plain_audit(rows, labels)
    assert len(found) == 3 * 600


def test_small_table_agrees(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    marks = [(r["doc_id"], r["quality"], r["toxic"]) for r in labels.collect()]
    assert spark_audit(audit.audited(docs, labels)) == plain_audit(rows, marks)


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], LABELS)
    assert audit.audited(documents([]), none).collect() == []
    found = spark_audit(audit.audited(documents([(1, None), (2, "")]), none))
    assert found["", "EABCD", 1] == (1, 1, 0, 0, 0, 0, 60)
    assert found["", "EABCD", 2] == (0, 1, 1, 1, 0, 0, 180)


def test_each_filter_needs_its_letter(spark, documents):
    with pytest.raises(ValueError):
        audit.audited(documents([]), spark.createDataFrame([], LABELS), [audit.FILTERS[0]] * 2)

"""Line dedup: recall on planted passages, and what stays."""

from __future__ import annotations

import random

import pytest
from llm_cases import documents  # noqa: F401

from stopwise.llm.line_dedup import line_dedup


def sentence(draw):
    return " ".join(draw.choice("abcdefghij") * draw.randrange(1, 5) for _ in range(8)) + str(draw.random())


def planted(length, passages=60, seed=1):
    """Passages that stand in three texts each, every other line being unique; the rows, and of
    which rows the lines should go."""
    draw = random.Random(seed)
    rows = []
    for _ in range(passages):
        passage = [sentence(draw) for _ in range(length)]
        for _ in range(3):
            before, after = ([sentence(draw) for _ in range(draw.randrange(3, 9))] for _ in range(2))
            rows.append((len(rows), before, passage, after))
    return rows


def text_of(row):
    return "\n".join([*row[1], *row[2], *row[3]])


@pytest.mark.parametrize("length, least", [(2, 0.75), (3, 0.85), (4, 0.9), (6, 0.9), (10, 0.95), (20, 0.97)])
def test_recall_of_planted_passages(spark, documents, length, least):
    rows = planted(length)
    out = {r["doc_id"]: r for r in line_dedup(documents([(r[0], text_of(r)) for r in rows])).collect()}
    removed = sum(out[k]["n_removed"] for k in range(len(rows)) if k % 3)
    assert removed >= least * length * 2 * len(rows) / 3
    for k, before, passage, after in rows:
        left = out[k]["text"].split("\n")
        if k % 3 == 0:
            assert out[k]["text"] == text_of(rows[k])
        # No line of its own goes, and what is left is in order.
        assert left[: len(before)] == before and left[len(left) - len(after) :] == after
        assert out[k]["n_lines"] - out[k]["n_removed"] == len(left)


def test_copies_go_whole_but_the_first(spark, documents):
    draw = random.Random(3)
    text = "\n".join(sentence(draw) for _ in range(25))
    out = line_dedup(documents([(9, text), (4, text), (7, text), (5, text + "\nmore")])).collect()
    left = {r["doc_id"]: r["text"] for r in out}
    assert left[4] == text and left[7] == left[9] == ""
    assert left[5].split("\n")[-1] == "more" and len(left[5].split("\n")) <= 3


def test_the_first_place_of_a_chunk_stays_whole(spark, documents):
    """The line before a passage is shared by the second and the third text only."""
    draw = random.Random(5)
    passage = [sentence(draw) for _ in range(8)]
    own = [[sentence(draw) for _ in range(5)] for _ in range(3)]
    lead = sentence(draw)
    texts = [[*own[0], *passage], [*own[1], lead, *passage], [*own[2], lead, *passage]]
    out = line_dedup(documents([(k, "\n".join(t)) for k, t in enumerate(texts)])).orderBy("doc_id").collect()
    left = [set(r["text"].split("\n")) for r in out]
    assert set(passage) <= left[0]
    assert lead in left[1] and set().union(*left) == {*passage, lead, *own[0], *own[1], *own[2]}


def test_lines_that_repeat_within_a_text(spark, documents):
    out = line_dedup(documents([(1, "a\n" * 50 + "b"), (2, "x\ny\nz\nx\ny\nz\nx\ny\nz")])).orderBy("doc_id").collect()
    assert set(out[0]["text"].split("\n")) == {"a", "b"} and out[0]["text"].startswith("a\na")
    assert out[1]["text"].startswith("x\ny\nz") and out[1]["n_removed"] >= 2


def test_single_lines_stay(spark, documents):
    draw = random.Random(7)
    common = "all rights reserved"
    rows = [(k, "\n".join([sentence(draw), common, sentence(draw)])) for k in range(30)]
    assert all(r["n_removed"] == 0 for r in line_dedup(documents(rows)).collect())
    assert [r["n_removed"] for r in line_dedup(documents([(1, "one"), (2, "one")])).collect()] == [0, 0]

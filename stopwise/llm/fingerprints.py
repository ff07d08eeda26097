"""Fingerprints by randomised edit embedding.

One random walk, shared by all texts, reads a text from the left and writes a longer string: at
step ``j`` it writes the character it stands on and then moves on or stays, as a random bit of
``(j, character)`` says. Two walks that an edit has put out of step fall in again by chance, so a
small edit distance becomes a small Hamming distance. A character is thus written a number of
times that depends on ``j`` and the character alone, and ``STAY`` is that number.

How long two walks stay apart varies much, so ``WALKS`` of them, with different bits, share the
samples of a fingerprint. Each samples its written string at places that are the same for all texts as
far as their lengths allow: place ``b`` is the step with the smallest of a sequence of random numbers,
among the steps the walk has made. For walks of lengths m < n a sample falls on the same step with
probability m/n. Each sample is reduced to four bits, one hexadecimal digit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise.llm.components import components
from stopwise.llm.text import small_batches_for, written

SAMPLES = 256
WALKS = 4
PERIOD = 1 << 12
CLASSES = 1 << 8
ROWS_A_PART = 1_000
MAX_PARTS = 100_000
WORK_CHARS = 6_000_000
FEW = 24
CHANCE = 1 / 16


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(n: int, stream: int) -> np.ndarray:
    seeds = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (_mixed(seeds + np.uint64(stream * 0x632BE59B)) >> np.uint64(11)) / float(1 << 53)


@cache
def _stay(walk: int) -> np.ndarray:
    """``STAY[character class * PERIOD + step % PERIOD]``: how often the character is written."""
    moves = _uniform(CLASSES * PERIOD, 1 + walk).reshape(CLASSES, PERIOD) < 0.5
    moves[:, -1] = True
    steps = np.arange(PERIOD)
    next_move = np.where(moves, steps, PERIOD)
    next_move = np.minimum.accumulate(next_move[:, ::-1], axis=1)[:, ::-1]
    return np.minimum(next_move - steps + 1, 255).astype(np.uint8).ravel()


@cache
def _stay_rows(walk: int) -> list[bytes]:
    return [row.tobytes() for row in _stay(walk).reshape(CLASSES, PERIOD)]


@cache
def _places() -> list[np.ndarray]:
    """For each sample, the steps at which a new smallest random number appears, ascending."""
    every = []
    for b in range(SAMPLES):
        u, at, places, draws = 1.0, 0, [0], iter(_uniform(400, 1000 + b))
        u = next(draws)
        while at < 1 << 44:
            gap = np.log(max(next(draws), 1e-300)) / np.log1p(-min(u, 1 - 1e-12))
            at += int(gap) + 1
            u = max(u * next(draws), 1e-15)
            places.append(at)
        every.append(np.array(places, np.int64))
    return every


def _classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return ((points ^ (points >> np.uint32(8))) & np.uint32(CLASSES - 1)).astype(np.uint8)


def _walks(
    texts: list[np.ndarray], begin: np.ndarray, walk: int
) -> tuple[list[np.ndarray], np.ndarray]:
    """For each text the step at which each of its characters is first written, and the end.

    ``begin`` is the step at which each walk starts. All walks take a character at a time
    together while many are under way; the last few go on one by one.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-lengths, kind="stable")
    flat = np.concatenate([texts[i] for i in order]) if len(texts) else np.zeros(0, np.uint8)
    sizes = lengths[order]
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    steps = np.zeros(len(flat), np.int64)
    now = begin[order].astype(np.int64)
    stay, mask = _stay(walk), PERIOD - 1
    shared = int(sizes[FEW - 1]) if len(sizes) >= FEW else 0
    # Walks under way at each character: those whose text is longer.
    under_way = np.searchsorted(-sizes, -np.arange(shared), side="left")
    for i in range(shared):
        a = under_way[i]
        at = starts[:a] + i
        steps[at] = now[:a]
        now[:a] += stay[flat[at].astype(np.int64) * PERIOD + (now[:a] & mask)]
    rows = _stay_rows(walk)
    for k in range(int(np.searchsorted(-sizes, -shared, side="left"))):
        j, out = int(now[k]), []
        for c in flat[starts[k] + shared : starts[k] + sizes[k]].tobytes():
            out.append(j)
            j += rows[c][j & mask]
        steps[starts[k] + shared : starts[k] + sizes[k]] = out
        now[k] = j
    each: list[np.ndarray] = [None] * len(texts)
    end = np.empty(len(texts), np.int64)
    for k, i in enumerate(order):
        each[i] = steps[starts[k] : starts[k] + sizes[k]]
        end[i] = now[k]
    return each, end


def _digits(texts, steps, ends, walk: int) -> np.ndarray:
    """One row of four-bit symbols per text: the samples of one walk."""
    own = np.arange(walk, SAMPLES, WALKS)
    sampled = np.empty((len(own), len(texts)), np.int64)
    for row, b in zip(sampled, own):
        places = _places()[b]
        row[:] = places[np.maximum(np.searchsorted(places, ends, side="left") - 1, 0)]
    out = np.zeros((len(texts), len(own)), np.uint8)
    salt = own.astype(np.uint64) << np.uint64(16)
    for k, (text, step) in enumerate(zip(texts, steps)):
        if len(text):
            written = text[np.searchsorted(step, sampled[:, k], side="right") - 1]
            symbol = (written.astype(np.uint64) + np.uint64(1) + salt) * np.uint64(0x9E3779B97F4A7C15)
            out[k] = _mixed(symbol) >> np.uint64(60)
    return out


_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def _hex(digits: np.ndarray) -> list[str]:
    return [row.tobytes().decode() for row in _HEX[digits]]


def _likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal samples beyond chance, 0 to 1."""
    return np.clip(((a == b).mean(axis=1) - CHANCE) / (1 - CHANCE), 0.0, 1.0)


def fingerprint_texts(texts: list[str]) -> np.ndarray:
    classes = [_classes(t) for t in texts]
    start = np.zeros(len(texts), np.int64)
    return np.concatenate(
        [_digits(classes, *_walks(classes, start, walk), walk) for walk in range(WALKS)], axis=1
    )


def likeness(left: Column, right: Column) -> Column:
    """Likeness of two fingerprints in hexadecimal, as a column expression."""
    equal = F.size(
        F.filter(F.sequence(F.lit(1), F.lit(SAMPLES)), lambda i: F.substr(left, i, F.lit(1)) == F.substr(right, i, F.lit(1)))
    )
    return F.greatest(F.lit(0.0), (equal / SAMPLES - CHANCE) / (1 - CHANCE))


def _batched(batches: Iterator[pa.RecordBatch], column: str):
    """Rows of Arrow batches in groups of about WORK_CHARS characters."""
    held, chars = [], 0
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            held.append(row)
            chars += len(row[batch.schema.get_field_index(column)] or "")
            if chars >= WORK_CHARS:
                yield held
                held, chars = [], 0
    if held:
        yield held


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of every whole text. Null counts as empty; empty texts, which
    write nothing, all have the fingerprint of zeros. No shuffle."""

    small_batches_for(docs.sparkSession)

    def run(batches):
        for rows in _batched(batches, "text"):
            digits = fingerprint_texts([text or "" for _, text in rows])
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in rows], pa.int64()), pa.array(_hex(digits), pa.string())],
                ["doc_id", "fingerprint"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, fingerprint string"
    )


BANDS = 32
MIN_LIKENESS = 0.6


def near_classes(
    docs: DataFrame, bands: int = BANDS, min_likeness: float = MIN_LIKENESS
) -> DataFrame:
    """``doc_id, class_id`` of every row: documents whose fingerprints are alike share a class,
    named by its smallest doc_id.

    Each band is a set of sampled digits; texts that agree in a whole band are candidates, and
    are verified by all samples. Texts alike to 0.6 agree in one of 32 bands of 8 digits with a
    chance of 53 %, to 0.8 of 99.9 %. Equal texts are one candidate from the start. The members of a
    band's bucket are first compared with its smallest, then those still in different classes
    with one another. Null ids belong to no class but that of null.
    """
    spark = docs.sparkSession
    own = written(spark, fingerprints(docs), "fingerprints")
    first = own.groupBy("fingerprint").agg(F.min("doc_id").alias("x")).where("x is not null")
    first = written(spark, first, "fingerprint-classes")
    width = SAMPLES // bands
    keys = F.array(*[F.substring("fingerprint", 1 + b * width, width) for b in range(bands)])
    members = first.select("x", "fingerprint", F.posexplode(keys).alias("band", "key"))
    pivots = (
        members.groupBy("band", "key")
        .agg(F.min(F.struct("x", "fingerprint")).alias("pivot"), F.count("*").alias("n"))
        .where("n > 1")
        .select("band", "key", F.col("pivot.x").alias("y"), F.col("pivot.fingerprint").alias("of_y"))
    )
    shared = written(spark, members.join(pivots, ["band", "key"]).where("x <> y"), "fingerprint-buckets")
    alike = likeness(F.col("fingerprint"), F.col("of_y")) >= min_likeness
    found = shared.select("x", "fingerprint", "y", "of_y").distinct().where(alike)
    label = written(spark, components(found.select(F.col("x").alias("u"), F.col("y").alias("v"))), "fingerprint-labels")
    placed = shared.join(label, F.col("x") == F.col("node"), "left").select(
        "band", "key", "x", "fingerprint", F.coalesce("component", "x").alias("component")
    )
    other = placed.select("band", "key", F.col("x").alias("o"), F.col("fingerprint").alias("of_o"), F.col("component").alias("o_component"))
    rest = (
        placed.join(other, ["band", "key"])
        .where((F.col("x") < F.col("o")) & (F.col("component") != F.col("o_component")))
        .select("x", "fingerprint", "o", "of_o")
        .distinct()
        .where(likeness(F.col("fingerprint"), F.col("of_o")) >= min_likeness)
    )
    links = label.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(
        rest.select(F.col("x").alias("u"), F.col("o").alias("v"))
    )
    named = components(links)
    classes = first.join(named, F.col("x") == F.col("node"), "left").select(
        F.col("fingerprint").alias("same"), F.coalesce("component", "x").alias("class_id")
    )
    return own.join(classes, F.col("fingerprint") == F.col("same"), "left").select(
        "doc_id", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id")
    )


def _splits(docs: DataFrame, rows_a_part: int) -> list[int]:
    """Ids that begin a part, from the smallest: some of the corpus' own, evenly spread."""
    ids = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"))
    n, least = ids.agg(F.count("*"), F.min("doc_id")).first()
    parts = min(MAX_PARTS, -(-n // rows_a_part))
    if parts <= 1:
        return [least] if n else []
    cuts = [i / parts for i in range(1, parts)]
    found = ids.agg(F.percentile_approx("doc_id", cuts, 20 * parts).alias("at")).first()["at"]
    return sorted({least, *found})


def with_next_edited(docs: DataFrame, rows_a_part: int = ROWS_A_PART) -> DataFrame:
    """Fingerprints of every text and of its edited form, with their likenesses.

    The edited text has its last floor(n/2) code points replaced by the first as many (or all)
    of the next document, in ascending doc_id; the last is followed by the first. Rows of one id
    follow in the order of their texts, null first, and null ids come last. A single document
    follows itself; an empty table gives an empty result.

    Texts move once: to the part of the id range their document belongs to. Parts begin at ids
    of the corpus, and the document that begins a part is also sent to the part before it, as
    the successor of its last document. The walk over the first half of a text is shared by its
    edited form, which goes on from the step that half ends at.
    """
    small_batches_for(docs.sparkSession)
    starts = np.array(_splits(docs, rows_a_part), np.int64)
    last = max(len(starts) - 1, 0)

    def place(batches):
        for batch in batches:
            ids = batch.column(0)
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            values = ids.fill_null(0).to_numpy()
            part = np.searchsorted(starts, values, side="right") - 1
            part = np.where(missing, last, np.maximum(part, 0)).astype(np.int64)
            begins = np.zeros(len(values), bool)
            if len(starts):
                begins = ~missing & (starts[part] == values)
            else:
                begins[:] = True
            twice = np.flatnonzero(begins)
            rows = np.concatenate([np.arange(len(values)), twice])
            taken = batch.take(pa.array(rows))
            own = len(values)
            before = np.where(part[twice] == 0, last, part[twice] - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([part, before])),
                    pa.array(np.arange(len(rows)) >= own),
                    taken.column(0),
                    taken.column(1),
                ],
                ["part", "borrowed", "doc_id", "text"],
            )

    schema = "part long, borrowed boolean, doc_id long, text string"
    placed = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(place, schema)
    ordered = placed.repartition("part").sortWithinPartitions(
        "part", "borrowed", F.col("doc_id").isNull(), "doc_id", "text"
    )

    def run(batches):
        for pairs in _successions(batches):
            yield _compared(pairs)

    return ordered.mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )


def _successions(batches):
    """Lists of (doc_id, text, next text) in groups of about WORK_CHARS characters."""
    held, chars, last = [], 0, None
    for batch in batches:
        for part, borrowed, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            text = text or ""
            if last is not None and last[0] == part:
                held.append((last[1], last[2], text))
                chars += len(last[2])
                if chars >= WORK_CHARS:
                    yield held
                    held, chars = [], 0
            last = None if borrowed else (part, doc_id, text)
    if held:
        yield held


def _compared(pairs) -> pa.RecordBatch:
    texts = [text for _, text, _ in pairs]
    halves = [len(t) // 2 for t in texts]
    heads = [nxt[:half] for (_, _, nxt), half in zip(pairs, halves)]
    edited = [t[: len(t) - half] + head for t, half, head in zip(texts, halves, heads)]
    classes, tails = [_classes(t) for t in texts], [_classes(h) for h in heads]
    kept = [len(t) - half for t, half in zip(texts, halves)]
    both = [np.concatenate([c[:k], t]) for c, k, t in zip(classes, kept, tails)]
    own, changed = [], []
    for walk in range(WALKS):
        steps, ends = _walks(classes, np.zeros(len(texts), np.int64), walk)
        own.append(_digits(classes, steps, ends, walk))
        turn = [s[k] if k < len(s) else e for s, k, e in zip(steps, kept, ends)]
        on, tail_ends = _walks(tails, np.array(turn, np.int64), walk)
        on = [np.concatenate([s[:k], t]) for s, k, t in zip(steps, kept, on)]
        changed.append(_digits(both, on, tail_ends, walk))
    own, changed = np.concatenate(own, axis=1), np.concatenate(changed, axis=1)
    nxt = np.empty_like(own)
    nxt[:-1] = own[1:]
    follows = [k + 1 < len(pairs) and pairs[k][2] is pairs[k + 1][1] for k in range(len(pairs))]
    alone = [k for k, ok in enumerate(follows) if not ok]
    nxt[alone] = fingerprint_texts([pairs[k][2] for k in alone])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([i for i, _, _ in pairs], pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited]),
            pa.array(_hex(own)),
            pa.array(_hex(changed)),
            pa.array(_likeness(own, changed)),
            pa.array(_likeness(own, nxt)),
        ],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )

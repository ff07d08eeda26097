"""What each of several filters removes, in every order of applying them.

1. A byte transducer measures whole texts. It has two states, outside and inside a word; a table
   gives the next state for each byte, another what a byte in a state puts out: a word's start or
   end, a capital, a code point, a symbol. The next state depends on the byte alone, so one pass
   over the bytes of a batch runs the transducer for all of its texts at once.
2. The spans it puts out go into an open-addressing hash table that holds spans, not hashes: a
   word that meets an occupied slot is compared with the occupant byte by byte, and moves on if
   it differs. What a text inserts are its distinct words.
3. Each row is then a few numbers, a digest of its text and the set of filters it fails, as bits.
   Texts that repeat are found by digest (SHA-256); groups are combined before they are shuffled.
4. Rows of one part and one set of failures behave alike in every order, so a part is at most 32
   counts however many rows it has. Those meet a fixed table of (filter, filters before it), and
   that a fixed table of all orders.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.llm.hashing import GAP_BYTES, GOLDEN, _word_hashes, mixed, small_batches
from stopwise.llm.text import small_batches_for, written

# The characters the symbol filter looks for.
SYMBOLS = b"#$%&*|"
OUTSIDE, INSIDE = 0, 1
OPENS, CLOSES, CAPITAL, POINT, SYMBOL = 1, 2, 4, 8, 16
STRETCH = 256 << 10
BATCH_BYTES = 1 << 20


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The state after each byte, and what ``state * 256 + byte`` puts out."""
    after = np.full(256, INSIDE, np.uint8)
    after[list(GAP_BYTES)] = OUTSIDE
    out = np.zeros((2, 256), np.uint8)
    for byte in range(256):
        own = 0 if 0x80 <= byte < 0xC0 else POINT
        own |= CAPITAL if 0x41 <= byte <= 0x5A else 0
        own |= SYMBOL if byte in SYMBOLS else 0
        out[OUTSIDE, byte] = own | (OPENS if after[byte] == INSIDE else 0)
        out[INSIDE, byte] = own | (CLOSES if after[byte] == OUTSIDE else 0)
    return after, out.ravel()


_AFTER, _OUT = _tables()


@dataclass
class Pass:
    """Counts per text, and the spans of all words: text ``k`` has ``n_words[k]`` of them, in order."""

    n_words: np.ndarray
    n_capitals: np.ndarray
    n_points: np.ndarray
    n_symbols: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def transduced(body: np.ndarray, offsets: np.ndarray) -> Pass:
    """Run over UTF-8 ``body``, in which text ``k`` lies from ``offsets[k]`` to ``offsets[k + 1]``."""
    state = np.empty(len(body), np.uint8)
    state[1:] = _AFTER[body[:-1]]
    state[offsets[:-1][offsets[:-1] < len(body)]] = OUTSIDE
    out = _OUT[state.astype(np.uint16) * 256 + body]

    def per_text(bit: int) -> np.ndarray:
        total = np.zeros(len(body) + 1, np.int64)
        np.cumsum((out & bit) != 0, out=total[1:])
        return np.diff(total[offsets])

    # A word that reaches the end of its text is closed by nothing inside it.
    stops = offsets[1:][np.diff(offsets) > 0]
    stops = stops[_AFTER[body[stops - 1]] == INSIDE]
    end = np.sort(np.concatenate([np.flatnonzero(out & CLOSES), stops]), kind="stable")
    return Pass(
        per_text(OPENS), per_text(CAPITAL), per_text(POINT), per_text(SYMBOL),
        np.flatnonzero(out & OPENS), end,
    )


def _same_bytes(body, begin, other, size) -> np.ndarray:
    """Whether the spans of ``size`` bytes from ``begin`` and from ``other`` hold the same."""
    same = np.empty(len(begin), bool)
    total = np.cumsum(size)
    a = 0
    while a < len(begin):
        before = total[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(total, before + STRETCH, side="right")))
        at = total[a:b] - size[a:b] - before
        off = np.arange(total[b - 1] - before) - np.repeat(at, size[a:b])
        agree = body[np.repeat(begin[a:b], size[a:b]) + off] == body[np.repeat(other[a:b], size[a:b]) + off]
        same[a:b] = np.logical_and.reduceat(agree, at)
        a = b
    return same


def distinct_words(body, begin, end, owner, hashes) -> np.ndarray:
    """For each span whether it is the first of its owner to hold its word.

    The table has twice the slots there are spans. All spans probe at once: free slots go to the
    first that asks, and a span whose slot holds another word tries the next slot.
    """
    n = len(begin)
    slots = 1 << max(1, (2 * n - 1).bit_length())
    table = np.full(slots, -1, np.int64)
    slot = (mixed(hashes + owner.astype(np.uint64) * GOLDEN) & np.uint64(slots - 1)).astype(np.int64)
    size, first = end - begin, np.zeros(n, bool)
    asking = np.arange(n)
    while len(asking):
        free = asking[table[slot[asking]] < 0][::-1]
        table[slot[free]] = free
        holder = table[slot[asking]]
        first[asking[holder == asking]] = True
        done = (holder == asking) | (
            (hashes[holder] == hashes[asking])
            & (owner[holder] == owner[asking])
            & (size[holder] == size[asking])
        )
        check = np.flatnonzero(done & (holder != asking))
        if len(check):
            a, b = asking[check], holder[check]
            done[check] = _same_bytes(body, begin[a], begin[b], size[a])
        asking = asking[~done]
        slot[asking] = (slot[asking] + 1) & (slots - 1)
    return first


def _hashes(body, begin, end) -> np.ndarray:
    hashes = np.empty(len(begin), np.uint64)
    cuts = np.searchsorted(begin, np.arange(0, len(body) + STRETCH, STRETCH))
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            hashes[a:b] = _word_hashes(body, begin[a:b], end[a:b], False)
    return hashes


MEASURES = ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.fill_null("") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type)
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return body[offsets[0] : offsets[-1]], offsets - offsets[0]


def measures_of(texts: pa.Array) -> tuple[list[np.ndarray], list[bytes]]:
    """The arrays ``MEASURES`` and the SHA-256 of each text; null counts as empty."""
    body, offsets = _bytes_of(texts)
    found = transduced(body, offsets)
    owner = np.repeat(np.arange(len(texts)), found.n_words)
    first = distinct_words(body, found.begin, found.end, owner, _hashes(body, found.begin, found.end))
    n_distinct = np.bincount(owner[first], minlength=len(texts)).astype(np.int64)
    raw = memoryview(body)
    digests = [hashlib.sha256(raw[a:b]).digest() for a, b in zip(offsets, offsets[1:])]
    return [found.n_words, n_distinct, found.n_capitals, found.n_points, found.n_symbols], digests


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, part`` of ``docs`` with ``MEASURES`` and ``digest``; one row per row. Other
    columns are not carried."""
    small_batches_for(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 2, BATCH_BYTES):
            numbers, digests = measures_of(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *map(pa.array, numbers), pa.array(digests, pa.binary())],
                ["doc_id", "part", *MEASURES, "digest"],
            )

    kinds = ", ".join(f"{name} long" for name in MEASURES)
    return docs.select("doc_id", "part", F.col(text).alias("text")).mapInArrow(
        run, f"doc_id long, part string, {kinds}, digest binary"
    )


@dataclass(frozen=True)
class Filter:
    """A row fails where ``fails`` (SQL over ``MEASURES``) is true; without it, where its text is
    that of a row with a smaller doc_id."""

    letter: str
    fails: str | None


# The five filters of the audit.
FILTERS = (
    Filter("A", "n_words < 200"),
    Filter("B", "100 * n_distinct < 50 * n_words"),
    Filter("C", "100 * n_capitals > 2 * n_points"),
    Filter("D", "n_symbols > 0"),
    Filter("E", None),
)


def failures(docs: DataFrame, labels: DataFrame, filters: Sequence[Filter] = FILTERS) -> DataFrame:
    """``part, mask, n, good, toxic``: rows, those labelled good and those labelled toxic, per part
    and set of failed filters (bit ``k`` for filter ``k``)."""
    spark = docs.sparkSession
    bits = [F.expr(f.fails).cast("int") * (1 << k) for k, f in enumerate(filters) if f.fails]
    repeats = sum(1 << k for k, f in enumerate(filters) if not f.fails)
    rows = measured(docs).select(
        "doc_id", "part", "digest", sum(bits, F.lit(0)).alias("mask")
    )
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_of")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    kind = ["digest", "part", "mask", "good", "toxic"]
    alike = (
        rows.join(marks, F.col("doc_id") == F.col("_of"), "left")
        .withColumn("good", F.coalesce("good", F.lit(False)))
        .withColumn("toxic", F.coalesce("toxic", F.lit(False)))
        .groupBy(*kind, "doc_id")
        .agg(F.count(F.lit(1)).alias("m"))
        .groupBy(*kind)
        .agg(
            F.sum("m").alias("n"),
            # The rows that may be the first of their text: those of the least id; those without.
            F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "m"))).alias("least"),
            F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("m"))), F.lit(0)).alias("apart"),
        )
    )
    alike = written(spark, alike, "filter-audit")
    firsts = alike.groupBy(F.col("digest").alias("_text")).agg(F.min("least.doc_id").alias("first"))
    split = (
        alike.join(firsts, F.col("digest") == F.col("_text"))
        .withColumn(
            "unrepeated",
            F.col("apart")
            + F.when(F.col("least.doc_id") == F.col("first"), F.col("least.m")).otherwise(F.lit(0)),
        )
        .select(
            "part", "good", "toxic",
            F.inline(
                F.array(
                    F.struct("mask", F.col("unrepeated").alias("n")),
                    F.struct(
                        F.col("mask").bitwiseOR(F.lit(repeats)).alias("mask"),
                        (F.col("n") - F.col("unrepeated")).alias("n"),
                    ),
                )
            ),
        )
        .where("n > 0")
    )
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(F.lit(0))).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(F.lit(0))).alias("toxic"),
    )


def interactions(found: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """``part, mask, n, good, toxic`` -> one row per part, order of the letters and step.

    Both tables that are joined here are fixed by the number of filters (80 and 600 rows for
    five), as is the number of rows a part has before the last join.
    """
    spark, size = found.sparkSession, len(letters)
    places = [
        (own, before)
        for own in range(size)
        for before in range(1 << size)
        if not before >> own & 1
    ]
    orders = [
        ("".join(letters[k] for k in order), step + 1, own, sum(1 << k for k in order[:step]))
        for order in permutations(range(size))
        for step, own in enumerate(order)
    ]
    in_orders = F.array(
        *[F.lit(factorial(k) * factorial(size - 1 - k)).cast("long") for k in range(size)]
    )
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    reached = F.col("mask").bitwiseAND(F.col("before")) == 0

    def total(condition, of="n"):
        return F.sum(F.when(condition, F.col(of)).otherwise(F.lit(0)))

    stages = found.select(
        "*",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(o).alias("own"), F.lit(1 << o).alias("bit"), F.lit(b).alias("before"))
                    for o, b in places
                ]
            )
        ),
    )
    counted = stages.groupBy("part", "own", "before").agg(
        total(reached & ~fails).alias("kept"),
        total(reached & fails).alias("removed"),
        total(~reached & fails).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(reached & fails, "good").alias("good_lost"),
        total(reached & fails, "toxic").alias("toxic_lost"),
    )
    shares = counted.groupBy(F.col("part").alias("_part"), F.col("own").alias("_own")).agg(
        F.sum(F.col("removed") * F.get(in_orders, F.bit_count("before"))).alias("shapley")
    )
    table = F.broadcast(
        spark.createDataFrame(orders, "filter_order string, step int, _filter int, _before int")
    )
    return (
        counted.join(shares, (F.col("part") == F.col("_part")) & (F.col("own") == F.col("_own")))
        .join(table, (F.col("own") == F.col("_filter")) & (F.col("before") == F.col("_before")))
        .select(
            "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
            "good_lost", "toxic_lost", "shapley",
        )
    )


def audited(
    docs: DataFrame,
    labels: DataFrame,
    filters: Sequence[Filter] = FILTERS,
    text: str = "text",
    part: str = "source",
) -> DataFrame:
    """The audit of ``docs`` by ``part``, against ``labels`` (doc_id, quality, toxic).

    A null text is an empty one, a null part the empty string. Rows that repeat are all counted.
    A text fails the filter for repeats where a row with a smaller doc_id holds the same; a row
    without a doc_id neither fails it nor makes another fail. A row is good, or toxic, if any
    label of its doc_id says so. An empty table gives no rows. Columns of any other name, those of
    the result included, play no part.
    """
    letters = "".join(f.letter for f in filters)
    if len(set(letters)) != len(filters):
        raise ValueError("each filter needs a letter of its own")
    parted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(part), F.lit("")).alias("part"),
        F.col(text).alias("text"),
    )
    return interactions(failures(parted, labels, filters), letters)

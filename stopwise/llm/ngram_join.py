"""Jaccard join of documents on word n-grams, filtered under several token orders.

Two sets of similarity t or more share a token among their first ``n - ceil(t * n) + 1`` tokens,
n being the size of either, in whatever order all tokens are put. Candidates have to share such a
prefix token in each of three orders:

* the first puts tokens with a rare word first, by the rarest of their words;
* the second goes by all words of a token, rarest combination first;
* the third is a hash order that knows nothing of frequencies.

Where documents share a common passage and little else, the first two orders push its tokens out
of the prefixes; where frequencies mislead, the third still thins the candidates. Orders only
decide how much is compared, never the result, so words beyond a bounded table of counts may all
rank as rare.

What is linked is found without all pairs of a group. Documents with one and the same set are one
class. Per token of the first order, its members are compared with one of them, the pivot; that
joins near copies, however many, by as many comparisons as members. Two members that still lie in
different components can link only if they differ from the pivot in the same way: of the tokens
in which either differs from it, they must share a number that follows from their sizes. So the
differences are joined by a prefix filter of their own, what the pivot lacks first, and copies
that were each edited elsewhere never meet. Members that sizes or orders kept from the pivot are paired
by their token where it has few. Else they and members they may link to have the tokens of their
whole sets counted and are joined by prefixes in the order of these counts, where a passage that
many share comes last. All pairs found are compared. Every pair that could link has then been
compared or joined through others, so components are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopwise.llm.components import components
from stopwise.llm.hashing import GOLDEN, chained, mixed, small_batches, words_of_texts
from stopwise.llm.text import release_shuffles, small_batches_for, written

RANKED_WORDS = 1 << 18
# Members of a token up to which pairing them is cheaper than counting all their tokens.
PAIRED = 64


@dataclass(frozen=True)
class Similarity:
    """Sets link at ``percent`` or more of their union; tokens are ``words``-grams."""

    percent: int = 80
    words: int = 5

    def least_shared(self, n):
        """How many tokens a set of ``n`` has in common with any it links to."""
        return -(-self.percent * n // 100)

    def prefix(self, n):
        return n - self.least_shared(n) + 1

    def alone(self, n):
        """Whether a set of ``n`` links to its equals only: the next larger size is out of reach,
        and so are smaller ones and other sets of its own."""
        return 100 * n // self.percent == n

    def needed(self, a: Column, b: Column) -> Column:
        """How many tokens sets of these sizes share if they link."""
        return F.ceil(self.percent * (a + b) / F.lit(100.0 + self.percent) - 1e-9)

    def may_differ(self, a: Column, b: Column) -> Column:
        """In how many tokens sets of these sizes differ at most if they link."""
        return F.floor((100 - self.percent) * (a + b) / F.lit(100.0 + self.percent) + 1e-9)

    def largest(self, n: Column, at: Column) -> Column:
        """The largest set that one of ``n`` may link to if ``at`` is the place of the first token
        they share."""
        return F.floor((n - at) * (100 + self.percent) / F.lit(float(self.percent)) - n + 1e-6)


# ---------------------------------------------------------------------- word counts


def word_ranks(docs: DataFrame, ranked: int = RANKED_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the most frequent words, sorted, and the binary logarithms of their counts.

    All words of all texts are counted. What the driver gathers is bounded: the words above the
    least power of two that at most ``ranked`` words reach.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 0):
            hashes, counts = np.unique(words_of_texts(batch.column(0), lower=True).hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(counts.astype(np.int64))], ["word", "n"]
            )

    counted = written(
        docs.sparkSession,
        docs.select("text")
        .mapInArrow(count, "word long, n long")
        .groupBy("word")
        .agg(F.floor(F.log2(F.sum("n"))).cast("int").alias("size")),
        "word-counts",
    )
    sizes = {r["size"]: r["n"] for r in counted.groupBy("size").agg(F.count("*").alias("n")).collect()}
    least, total = 1 + max(sizes, default=0), 0
    while least > 1 and total + sizes.get(least - 1, 0) <= ranked:
        least -= 1
        total += sizes.get(least, 0)
    rows = counted.where(F.col("size") >= least).toPandas()
    words = rows["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(words)
    return words[order], (rows["size"].to_numpy(np.int64) - least + 1)[order]


# ---------------------------------------------------------------------- sets and prefixes


def _sets(batch_texts: pa.Array, similarity: Similarity, ranks=None):
    """Per text: its distinct tokens as sorted hashes, and two frequency classes of each."""
    words = words_of_texts(batch_texts, lower=True)
    size = similarity.words
    if ranks is not None:
        known, levels = ranks
        at = np.searchsorted(known, words.hashes)
        at[at == len(known)] = 0
        level = np.where(known[at] == words.hashes, levels[at], 0) if len(known) else np.zeros(len(words.hashes), np.int64)
    tokens = chained(words.hashes, size)
    if ranks is not None and len(tokens):
        rarest = total = level[: len(tokens)]
        for k in range(1, size):
            rarest = np.minimum(rarest, level[k : k + len(tokens)])
            total = total + level[k : k + len(tokens)]
    for k in range(len(batch_texts)):
        a, b = words.first[k], words.first[k + 1]
        if b == a:
            yield None
        elif b - a < size:
            # Fewer words than a token: the whole sequence, told from longer ones by its length.
            whole = mixed(chained(words.hashes[a:b], b - a) + np.full(1, b - a, np.uint64) * GOLDEN)
            yield (whole, np.zeros(1, np.int64), np.zeros(1, np.int64)) if ranks is not None else whole
        elif ranks is None:
            yield np.unique(tokens[a : b - size + 1])
        else:
            own, at = np.unique(tokens[a : b - size + 1], return_index=True)
            yield own, rarest[a : b - size + 1][at], total[a : b - size + 1][at]


def _first(tokens: np.ndarray, level: np.ndarray, salt: int, n: int) -> np.ndarray:
    """The ``n`` tokens that come first by level, then by a salted hash, in that order."""
    order = (np.minimum(level, 255).astype(np.uint64) << np.uint64(56)) | (
        mixed(tokens ^ np.uint64(salt)) >> np.uint64(8)
    )
    first = np.argpartition(order, n - 1)[:n] if n < len(tokens) else np.arange(len(tokens))
    return tokens[first[np.argsort(order[first])]]


_SKETCH = (
    "doc_id long, n int, set_key binary, first array<long>, second array<int>, third array<int>"
)


def sketches(docs: DataFrame, similarity: Similarity, ranks) -> DataFrame:
    """``doc_id, n, set_key`` of every document with the prefixes of its set in three orders.

    The key digests the whole set. Tokens of the second and third order are cut to 32 bits; what
    that confuses can only let a candidate through. Sets too small to link to any but their
    equals have no prefixes; one that a larger set can hold keeps its prefix of one token.
    """
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            columns: list[list] = [[], [], [], [], []]
            none64, none32 = np.zeros(0, np.int64), np.zeros(0, np.int32)
            for found in _sets(batch.column(1), similarity, ranks):
                if found is None:
                    row = (0, None, none64, none32, none32)
                else:
                    tokens, rarest, total = found
                    n = len(tokens)
                    key = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
                    p = similarity.prefix(n)
                    if similarity.alone(n):
                        row = (n, key, none64, none32, none32)
                    else:
                        row = (
                            n,
                            key,
                            _first(tokens, rarest, 1, p).view(np.int64),
                            _first(tokens, total, 2, p).astype(np.uint32).view(np.int32),
                            _first(tokens, np.zeros(n, np.int64), 3, p).astype(np.uint32).view(np.int32),
                        )
                for column, value in zip(columns, row):
                    column.append(value)
            types = [pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]],
                ["doc_id", "n", "set_key", "first", "second", "third"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _SKETCH)


# ---------------------------------------------------------------------- comparing pairs


def _whole_sets(docs: DataFrame, ids: DataFrame, similarity: Similarity) -> DataFrame:
    """``id, tokens``: the whole sets, as packed 64-bit numbers, of the documents in ``id``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            packed = [b"" if s is None else s.tobytes() for s in _sets(batch.column(1), similarity)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["id", "tokens"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(ids, "id", "left_semi")
    return chosen.mapInArrow(run, "id long, tokens binary")


def _compared(pairs: DataFrame, sets: DataFrame, similarity: Similarity) -> DataFrame:
    """``x, y`` -> ``x, y, shared, either, n, apart, differs``.

    ``shared`` and ``either`` are the sizes of intersection and union, ``n`` that of x, ``apart``
    the number of tokens in one only. ``differs`` are the first of those, what y lacks before
    what x lacks, as many as can hold the first one that x has in common with the differences of
    another set it links to.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, differs = [], []
            for a, b in zip(batch.column(2), batch.column(3)):
                left = np.frombuffer(a.as_buffer(), np.uint64)
                right = np.frombuffer(b.as_buffer(), np.uint64)
                n = len(left)
                own = left[~np.isin(left, right, assume_unique=True, kind="sort")]
                both = n - len(own)
                apart = n + len(right) - 2 * both
                least = max(1, -(-(apart - n * (100 - similarity.percent) // similarity.percent) // 2))
                wanted = apart - least + 1
                if wanted > len(own):
                    lacks = right[~np.isin(right, left, assume_unique=True, kind="sort")]
                    own = np.concatenate([own, lacks])
                counts.append((both, n + len(right) - both, n, apart))
                differs.append(own[: max(0, wanted)].view(np.int64))
            columns = list(zip(*counts)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    *[pa.array(c, pa.int32()) for c in columns],
                    pa.array(differs, pa.list_(pa.int64())),
                ],
                ["x", "y", "shared", "either", "n", "apart", "differs"],
            )

    of_x = sets.select(F.col("id").alias("x"), F.col("tokens").alias("of_x"))
    of_y = sets.select(F.col("id").alias("y"), F.col("tokens").alias("of_y"))
    return (
        pairs.join(of_x, "x")
        .join(of_y, "y")
        .select("x", "y", "of_x", "of_y")
        .mapInArrow(
            run, "x long, y long, shared int, either int, n int, apart int, differs array<long>"
        )
    )


def _may_link(n_a: str, at_a: str, n_b: str, at_b: str, similarity: Similarity) -> Column:
    """Whether sets of these sizes may link if the first token they share has these positions:
    of each enough tokens must be left from there on."""
    a, b = F.col(n_a), F.col(n_b)
    needed = similarity.needed(a, b)
    return (a - F.col(at_a) >= needed) & (b - F.col(at_b) >= needed)


def _pass_other_orders(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose prefixes meet in the second and the third order too."""
    side = lambda end: classes.select(
        F.col("doc_id").alias(end), F.col("second").alias(f"second_{end}"), F.col("third").alias(f"third_{end}")
    )
    return (
        pairs.join(side("x"), "x")
        .join(side("y"), "y")
        .where(F.arrays_overlap("second_x", "second_y") & F.arrays_overlap("third_x", "third_y"))
        .select("x", "y")
    )


def linked(
    docs: DataFrame, similarity: Similarity = Similarity(), ranked: int = RANKED_WORDS
) -> tuple[DataFrame, DataFrame]:
    """``(members, labels)``.

    ``members``: ``doc_id, n_shingles, class_id`` of every row; a class is the documents of one
    set and carries its smallest doc_id. ``labels``: ``node, component`` of every class that
    links to another, directly or through others.
    """
    spark = docs.sparkSession
    small_batches_for(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = written(
        spark, sketches(docs, similarity, word_ranks(docs, ranked)), "ngram-sketches"
    )
    first_of = sketched.where("set_key is not null").groupBy(F.col("set_key").alias("key")).agg(
        F.min("doc_id").alias("class_id")
    )
    members = written(
        spark,
        sketched.select("doc_id", "n", "set_key").join(first_of, F.col("set_key") == F.col("key"), "left").select(
            "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id")
        ),
        "ngram-members",
    )
    chosen = members.where("doc_id = class_id and n_shingles > 0").select("doc_id").distinct()
    classes = sketched.where(F.size("first") > 0).join(chosen, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    classes = written(spark, classes, "ngram-classes")
    release_shuffles(spark)
    postings = classes.select(
        F.col("doc_id").alias("x"), "n", F.posexplode("first").alias("at", "token")
    )
    pivots = (
        postings.groupBy("token")
        .agg(F.count("*").alias("df"), F.min(F.struct("x", "n", "at")).alias("pivot"))
        .where("df > 1")
        .select(
            F.col("token").alias("t"),
            F.col("pivot.x").alias("y"),
            F.col("pivot.n").alias("n_y"),
            F.col("pivot.at").alias("at_y"),
        )
    )
    shared = written(
        spark,
        postings.join(pivots, F.col("token") == F.col("t")).select(
            "token", "x", "n", "at", "y", "n_y", "at_y"
        ),
        "ngram-postings",
    )
    star = _pass_other_orders(
        shared.where((F.col("x") != F.col("y")) & _may_link("n", "at", "n_y", "at_y", similarity))
        .select("x", "y")
        .distinct(),
        classes,
    )
    star = written(spark, star, "ngram-star")
    ids = star.select(F.explode(F.array("x", "y")).alias("id")).distinct()
    compared = written(spark, _compared(star, _whole_sets(docs, ids, similarity), similarity), "ngram-compared")
    release_shuffles(spark)
    enough = F.col("shared") * 100 >= F.col("either") * similarity.percent
    found = compared.where(enough).select(F.col("x").alias("u"), F.col("y").alias("v"))
    label = written(spark, components(found), "ngram-labels")
    rest = written(spark, _unsettled(docs, shared, compared, label, similarity), "ngram-unsettled")
    rest = written(spark, _pass_other_orders(rest, classes), "ngram-rest")
    release_shuffles(spark)
    if not rest.isEmpty():
        ids = rest.select(F.explode(F.array("x", "y")).alias("id")).distinct()
        more = _compared(rest, _whole_sets(docs, ids, similarity), similarity).where(enough)
        stars = label.select(F.col("node").alias("u"), F.col("component").alias("v"))
        found = stars.unionByName(more.select(F.col("x").alias("u"), F.col("y").alias("v")))
        label = written(spark, components(found), "ngram-labels")
    return members, label


def _unsettled(
    docs: DataFrame, shared: DataFrame, compared: DataFrame, label: DataFrame, similarity: Similarity
) -> DataFrame:
    """Pairs that may link and lie in different components so far, pivots' own pairs excepted.

    Members of a token with few of them are paired; those of other tokens are joined by a better
    order, so that pairs do not grow with the square of their number.
    """
    spark = shared.sparkSession
    own = F.coalesce("component", "x").alias("component")
    by_difference = _alike_in_difference(
        compared.join(label, F.col("x") == F.col("node"), "left").select(
            "x", "y", "n", "apart", "differs", own
        ),
        label,
        similarity,
    )
    members = written(spark, _open_members(shared, compared, label, similarity), "ngram-unknown")
    few, many = members.where(F.col("together") <= PAIRED), members.where(F.col("together") > PAIRED)
    other = few.select(*[F.col(c).alias(f"o_{c}") for c in few.columns])
    by_token = few.join(
        other,
        (F.col("token") == F.col("o_token"))
        & (F.col("x") < F.col("o_x"))
        & (F.col("component") != F.col("o_component"))
        & (F.col("open") | F.col("o_open"))
        & (F.col("largest") >= F.col("o_n"))
        & (F.col("o_largest") >= F.col("n")),
    ).select("x", F.col("o_x").alias("y"))
    by_frequency = _by_frequency(docs, _with_partner(many, similarity), similarity)
    return by_difference.unionByName(by_token).unionByName(by_frequency).distinct()


def _open_members(shared: DataFrame, compared: DataFrame, label: DataFrame, similarity: Similarity) -> DataFrame:
    """``token, x, n, component, open, largest, together``: members of the tokens that comparisons
    with pivots left unsettled.

    Those have members of several components, and one at least that is ``open``, not compared with
    the pivot. ``largest`` is the size of the largest set x may link to by the token's place in it,
    ``together`` the number of the token's members.
    """
    known = compared.select(F.col("x").alias("kx"), F.col("y").alias("ky")).distinct()
    members = (
        shared.where("x <> y")
        .join(known, (F.col("x") == F.col("kx")) & (F.col("y") == F.col("ky")), "left")
        .join(label, F.col("x") == F.col("node"), "left")
        .select(
            "token",
            "x",
            "n",
            F.coalesce("component", "x").alias("component"),
            F.col("kx").isNull().alias("open"),
            similarity.largest(F.col("n"), F.col("at")).alias("largest"),
        )
    )
    members = written(shared.sparkSession, members, "ngram-members-of-tokens")
    unsettled = (
        members.groupBy(F.col("token").alias("t"))
        .agg(
            F.count("*").alias("together"),
            F.max("open").alias("any"),
            F.min("component").alias("least"),
            F.max("component").alias("greatest"),
        )
        .where("any and least <> greatest")
        .select("t", "together")
    )
    return members.join(unsettled, F.col("token") == F.col("t")).drop("t")


def _with_partner(members: DataFrame, similarity: Similarity) -> DataFrame:
    """``x, component, open`` of the members that may link to one of another component, either of
    them open. Told per token and size class, without pairing them."""
    size = lambda n: F.floor(F.log(n) * 10).cast("int")
    others = members.groupBy(F.col("token").alias("o_token"), size(F.col("n")).alias("o_size")).agg(
        F.max("largest").alias("o_largest"),
        F.max("open").alias("o_open"),
        F.min("component").alias("least"),
        F.max("component").alias("greatest"),
    )
    smallest = F.ceil(F.col("n") * similarity.percent / F.lit(100.0) - 1e-9)
    sought = members.where(F.col("largest") >= smallest).withColumn(
        "size", F.explode(F.sequence(size(smallest), size(F.col("largest"))))
    )
    return (
        sought.join(
            others,
            (F.col("token") == F.col("o_token"))
            & (F.col("size") == F.col("o_size"))
            & (F.col("o_largest") >= F.col("n"))
            & (F.col("open") | F.col("o_open"))
            & ((F.col("least") != F.col("component")) | (F.col("greatest") != F.col("component"))),
            "left_semi",
        )
        .groupBy("x")
        .agg(F.min("component").alias("component"), F.max("open").alias("open"))
    )


def _single_tokens(docs: DataFrame, ids: DataFrame, similarity: Similarity) -> DataFrame:
    """``id, own, n, token``: each token of the sets of the documents in ``id``. ``own`` tells sets
    of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            sets = [np.zeros(0, np.uint64) if s is None else s for s in _sets(batch.column(1), similarity)]
            sizes = np.array([len(s) for s in sets])
            own = np.array([mixed(s + GOLDEN).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), sizes), pa.int64()),
                    pa.array(np.repeat(own, sizes)),
                    pa.array(np.repeat(sizes, sizes), pa.int32()),
                    pa.array(np.concatenate(sets).view(np.int64)),
                ],
                ["id", "own", "n", "token"],
            )

    chosen = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(ids, "id", "left_semi")
    return chosen.mapInArrow(run, "id long, own long, n int, token long")


def _by_frequency(docs: DataFrame, chosen: DataFrame, similarity: Similarity) -> DataFrame:
    """Pairs ``x, y`` of ``chosen`` that may link, lie in different components and have an open one.

    Their tokens are all counted and put in a fourth order, by the number of chosen sets that
    have them. Tokens that only one has come first and need no place in the join, and those of a
    common passage come last, so sets that share little else do not meet.
    """
    spark = docs.sparkSession
    chosen = written(spark, chosen, "ngram-open")
    tokens = written(spark, _single_tokens(docs, chosen.select(F.col("x").alias("id")), similarity), "ngram-tokens")
    counted = tokens.groupBy(F.col("token").alias("t")).agg(F.count("*").alias("df")).where("df > 1")
    of_set = Window.partitionBy("id", "own")
    # Those in one set only come before all others of the set.
    at = F.col("n") - F.count("*").over(of_set) + F.row_number().over(of_set.orderBy("df", "token")) - 1
    postings = (
        tokens.join(counted, F.col("token") == F.col("t"))
        .dropDuplicates(["id", "own", "token"])
        .select("id", "n", "token", at.alias("at"))
        .where((F.col("n") - F.col("at")) * 100 >= F.col("n") * similarity.percent)
        .join(chosen, F.col("id") == F.col("x"))
        .select("token", "x", "n", "at", "component", "open")
    )
    postings = written(spark, postings, "ngram-frequency")
    other = postings.select(*[F.col(c).alias(f"o_{c}") for c in postings.columns])
    return postings.join(
        other,
        (F.col("token") == F.col("o_token"))
        & (F.col("x") < F.col("o_x"))
        & (F.col("component") != F.col("o_component"))
        & (F.col("open") | F.col("o_open"))
        & _may_link("n", "at", "o_n", "o_at", similarity),
    ).select("x", F.col("o_x").alias("y"))


def _alike_in_difference(placed: DataFrame, label: DataFrame, similarity: Similarity) -> DataFrame:
    """Pairs of different components that were compared with one pivot and may link.

    Sets x and o that differ from a pivot in ``a`` and ``b`` tokens differ from each other in
    ``a + b`` less twice the differences they share. One of them is not linked to the pivot, so
    to link to each other they have to share at least one; how many follows from their sizes.
    """
    spark = placed.sparkSession
    components_of = placed.join(
        label.select(F.col("node").alias("of_y"), F.col("component").alias("of_pivot")),
        F.col("y") == F.col("of_y"),
        "left",
    ).groupBy("y").agg(
        F.min("component").alias("least"),
        F.max("component").alias("greatest"),
        F.min(F.coalesce("of_pivot", "y")).alias("of_pivot"),
    )
    split = components_of.where("least <> greatest or least <> of_pivot").select(F.col("y").alias("p"))
    postings = (
        placed.join(split, F.col("y") == F.col("p"), "left_semi")
        .select("y", "x", "n", "apart", "component", F.posexplode("differs").alias("at", "token"))
    )
    postings = written(spark, postings, "ngram-differences")
    other = postings.select(*[F.col(c).alias(f"o_{c}") for c in postings.columns])
    needed = F.ceil(
        (F.col("apart") + F.col("o_apart") - similarity.may_differ(F.col("n"), F.col("o_n"))) / 2
    )
    return postings.join(
        other,
        (F.col("y") == F.col("o_y"))
        & (F.col("token") == F.col("o_token"))
        & (F.col("x") < F.col("o_x"))
        & (F.col("component") != F.col("o_component"))
        & (F.col("apart") - F.col("at") >= needed)
        & (F.col("o_apart") - F.col("o_at") >= needed),
    ).select("x", F.col("o_x").alias("y"))


def joined(docs: DataFrame, similarity: Similarity = Similarity(), ranked: int = RANKED_WORDS) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``.

    ``component_id`` is the smallest doc_id reachable by links. Null and empty texts have an
    empty set, link with nothing and are components of their own. Rows that repeat a doc_id are
    each a row of the result; they count as one document where their sets differ.
    """
    members, label = linked(docs, similarity, ranked)
    return members.join(label, F.col("class_id") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "class_id").alias("component_id")
    )

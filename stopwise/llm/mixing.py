"""Mix sources to target weights: cut each source's shuffled documents at its word budget.

1. Every document gets a hash-random key; within a source, key order is the mixing order.
2. Each source's budget follows from the weights (see ``targets``).
3. The key space is cut into equal ranges, more of them for a source with more documents, so a
   source that holds a third of all rows is spread over as many tasks as its size asks for.
   Word counts are summed per range, the sums are accumulated over the ranges of a source, and
   a document's prefix sum is its range's offset plus its running sum within the range.
4. Whole epochs come first; the rest of the budget is cut from the prefix sums.

Only ids, keys and counts are shuffled, never texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopwise.llm.text import count_words, written

KEY_SPACE = 1 << 60
MAX_REPEATS = 3
ROWS_A_RANGE = 2_000
RANGES_A_BLOCK = 1_000


def mixing_key(doc_id: Column, seed: int = 0) -> Column:
    """A hash-random number below 2**60 that depends on the id and the seed alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def targets(
    sources: DataFrame, weights: Sequence[float] = (1, 2, 3), max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """One row per source with ``source_size``, ``n_docs`` -> the same with ``target``.

    Sources in code point order, null last, take ``weights`` in turn and share the sum of all
    sizes by weight. No target exceeds ``max_repeats`` times its source's size: ordered by
    size over weight, the smallest are the first to be full, so the rate per unit of weight is
    the one left after the longest prefix of full sources. The input has one row per source of
    the corpus; it is as small as the list of sources whatever the number of documents.
    """
    turn = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.pmod(F.row_number().over(turn) - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    fill = Window.orderBy(F.col("_limit") / F.col("_weight"), F.col("source").isNull(), "source")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    every = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (
        sources.withColumn("_weight", weight)
        .withColumn("_limit", (F.col("source_size") * max_repeats).cast("double"))
        .withColumn("_total", F.sum("source_size").over(every).cast("double"))
        .withColumn("_full", F.coalesce(F.sum("_limit").over(before), F.lit(0.0)))
        .withColumn(
            "_open",
            F.sum("_weight").over(every)
            - F.coalesce(F.sum("_weight").over(before), F.lit(0.0)),
        )
        .withColumn("_rate", (F.col("_total") - F.col("_full")) / F.col("_open"))
        .withColumn("_stops", F.col("_rate") * F.col("_weight") <= F.col("_limit"))
    )
    rate = F.min(F.when(F.col("_stops"), F.struct("_full", "_rate"))).over(every)["_rate"]
    return ranked.withColumn(
        "target",
        F.least("_limit", F.coalesce(rate, F.lit(float("inf"))) * F.col("_weight")),
    ).drop("_weight", "_limit", "_total", "_full", "_open", "_rate", "_stops")


def _offsets(placed: DataFrame) -> DataFrame:
    """What lies before each range of a source: words of the blocks of ranges before its own,
    and of the ranges before it in the block. No task sees more than a block of ranges, or one
    row per block."""
    blocks = placed.groupBy(
        "source", F.floor(F.col("_range") / RANGES_A_BLOCK).alias("_block"), "_range"
    ).agg(F.sum("size").alias("_words"))
    in_block = Window.partitionBy("source", "_block").orderBy("_range")
    of_source = Window.partitionBy("_of").orderBy("_which")
    earlier = (Window.unboundedPreceding, -1)
    by_block = blocks.groupBy(F.col("source").alias("_of"), F.col("_block").alias("_which")).agg(
        F.sum("_words").alias("_block_words")
    )
    by_block = by_block.select(
        "_of",
        "_which",
        F.coalesce(
            F.sum("_block_words").over(of_source.rowsBetween(*earlier)), F.lit(0)
        ).alias("_base"),
    )
    return (
        blocks.withColumn(
            "_inner", F.coalesce(F.sum("_words").over(in_block.rowsBetween(*earlier)), F.lit(0))
        )
        .join(
            by_block,
            F.col("source").eqNullSafe(F.col("_of")) & (F.col("_block") == F.col("_which")),
        )
        .select(
            F.col("source").alias("_in"),
            F.col("_range").alias("_at"),
            (F.col("_base") + F.col("_inner")).alias("_offset"),
        )
    )


def mix(
    sized: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    max_repeats: int = MAX_REPEATS,
    seed: int = 0,
    rows_a_range: int = ROWS_A_RANGE,
) -> DataFrame:
    """Rows of ``doc_id, source, size`` -> ``doc_id, source, size, source_size, target, epochs,
    repeats, taken``.

    ``epochs`` is how often the whole source is taken, ``repeats`` how often this document is:
    once more if the greater part of it lies before the cut. ``taken`` is ``repeats * size``,
    so a source's taken words are within half a document of its target. Rows that share a
    ``doc_id`` share a key and follow in order of size; rows equal in both are taken in an
    order that does not show in the result. A column ``digest`` of ``sized`` is passed on; it tells
    apart rows of one id and size, and rows without an id get their key from it. Documents
    without words are never taken. A null
    source is a source of its own; an empty table gives an empty result.
    """
    if max_repeats < 1:
        raise ValueError("max_repeats must be 1 or more")
    spark = sized.sparkSession
    digest = [c for c in sized.columns if c == "digest"]
    drawn_by = F.col("doc_id")
    if digest:
        drawn_by = F.coalesce(drawn_by.cast("string"), F.concat(F.lit("null:"), F.col("digest").cast("string")))
    keyed = written(
        spark,
        sized.select("doc_id", "source", "size", *digest, mixing_key(drawn_by, seed).alias("_key")),
        "mixing-sizes",
    )
    by_source = keyed.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    plan = targets(by_source, weights, max_repeats).select(
        F.col("source").alias("_source"),
        "source_size",
        "target",
        F.greatest(F.lit(1), F.ceil(F.col("n_docs") / rows_a_range)).cast("long").alias("_ranges"),
    )
    plan = written(spark, plan, "mixing-targets")
    width = F.ceil(F.lit(KEY_SPACE) / F.col("_ranges")).cast("long")
    placed = keyed.join(plan, F.col("source").eqNullSafe(F.col("_source")), "left").withColumn(
        "_range", F.floor(F.col("_key") / width).cast("long")
    )
    within = Window.partitionBy("source", "_range").orderBy("_key", "doc_id", "size", *digest)
    running = placed.join(
        _offsets(placed),
        F.col("source").eqNullSafe(F.col("_in")) & (F.col("_range") == F.col("_at")),
        "left",
    ).withColumn(
        "_before",
        F.col("_offset")
        + F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0))
        - F.col("size"),
    )
    whole = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(F.lit(0)).cast("long")
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    once_more = (F.col("size") > 0) & (F.col("_before") + F.col("size") / 2 <= rest)
    return (
        running.withColumn("epochs", whole)
        .withColumn(
            "repeats",
            F.when(F.col("size") > 0, F.col("epochs") + once_more.cast("long")).otherwise(
                F.lit(0).cast("long")
            ),
        )
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            "epochs",
            "repeats",
            (F.col("repeats") * F.col("size")).alias("taken"),
            *digest,
        )
    )


def sized_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size`` of every document; the size is its number of words."""
    return docs.select("doc_id", "source", count_words(F.col("text")).alias("size"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    The join goes by ``doc_id``, source and a hash of the text, so rows without an id, or that
    share one, are each taken as planned; those equal in all three are taken as often as the
    first of them is.
    """
    digest = F.xxhash64("text")
    plan = (
        mix(
            docs.select("doc_id", "source", count_words(F.col("text")).alias("size"), digest.alias("digest")),
            **options,
        )
        .where("repeats > 0")
        .groupBy(
            F.col("doc_id").alias("_id"), F.col("source").alias("_src"), F.col("digest").alias("_digest")
        )
        .agg(F.max("repeats").cast("int").alias("_repeats"))
    )
    return (
        docs.join(
            plan,
            F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_src"))
            & (digest == F.col("_digest")),
        )
        .withColumn("_epoch", F.explode(F.sequence(F.lit(1), F.col("_repeats"))))
        .select(*docs.columns)
    )

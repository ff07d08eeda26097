"""Remove passages of several lines that the corpus has elsewhere, cut by content.

1. Every line is hashed, and over each two neighbours runs a polynomial hash of their hashes. A
   chunk may end at a line unless that is 0 modulo ``SPACING``, and at the end of the text. A chunk
   starts at every line and goes to the next end, two lines or more. Both ends of a chunk follow
   from its own lines, so a passage has the same chunks wherever it stands; what it loses are the
   lines after its last end, an eighth of the time one, seldom more.
2. Chunks are counted by a 64-bit hash, over the whole corpus; only ids and hashes are shuffled. A
   hash that occurs again keeps its first place, by (doc_id, line).
3. The texts of repeated chunks are compared byte by byte: the least and the greatest text of a
   hash must be the same, two values that are combined before the shuffle however often a chunk
   occurs. Should they differ, the chunks of such a hash are told apart by their whole text.
4. A line goes if it lies in a chunk that is not in its first place and in none that is: the first
   place of every repeated chunk stays whole.

Lines end at ``\\n`` and are compared as they are. A null text has no lines and stays null; a
text whose lines all go becomes empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise.llm.text import let, written

SPACING = 8
# The hash of two lines is a polynomial of base 1000003 modulo 2**31 - 1.
BASE = 1_000_003
MODULUS = (1 << 31) - 1


def _number(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long")


def _hash(lines: Column) -> Column:
    return F.xxhash64(lines)


def _ends(lines: Column, spacing: int) -> Column:
    """The lines (counted from 0) at which chunks end, in order; the first line is none."""
    last = F.size(lines) - 1

    def of_hashes(hashes: Column) -> Column:
        rolled = F.transform(
            hashes,
            lambda own, i: F.pmod(
                F.pmod(F.coalesce(F.get(hashes, i - 1), F.lit(0)) * BASE, F.lit(MODULUS)) + own,
                F.lit(MODULUS),
            ),
        )
        ending = F.transform(
            rolled,
            lambda value, i: F.when(
                (i > 0) & ((F.pmod(value, F.lit(spacing)) != 0) | (i == last)), i
            ),
        )
        return F.filter(ending, lambda i: i.isNotNull())

    return let(F.transform(lines, _number), of_hashes)


def _chunks(lines: Column, spacing: int) -> Column:
    """``_first``, ``_size`` and ``_hash`` of the chunks of a text, one for each line but the last."""

    def of_ends(ends: Column) -> Column:
        # Between two ends, all lines from the first on start chunks that the second ends.
        return F.flatten(
            F.transform(
                ends,
                lambda end, k: F.transform(
                    F.sequence(F.coalesce(F.get(ends, k - 1), F.lit(0)), end - 1),
                    lambda first: F.struct(
                        first.alias("_first"),
                        (end - first + 1).alias("_size"),
                        _hash(F.slice(lines, first + 1, end - first + 1)).alias("_hash"),
                    ),
                ),
            )
        )

    return let(_ends(lines, spacing), of_ends)


def _passage(lines: Column, first: Column, size: Column) -> Column:
    return F.array_join(F.slice(lines, first + 1, size), "\n")


def line_dedup(docs: DataFrame, text: str = "text", spacing: int = SPACING) -> DataFrame:
    """``docs`` with its text less the passages it repeats, ``n_lines`` and ``n_removed``.

    The first of a repeated chunk is the one with the smallest (doc_id, line); rows that repeat an
    id rank among themselves by their texts, and rows that repeat id and text share their fate. A
    null doc_id comes last. Extra columns pass through whatever their names, but for ``n_lines``
    and ``n_removed``, which are replaced. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    base = docs.select(
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in columns if c != text]).alias(
            "_row"
        ),
        F.col("doc_id").alias("_id"),
        F.col(text).alias("_text"),
    )
    # Rows of one id are told apart by their text.
    place = F.struct(F.col("_id").isNull(), F.col("_id"), F.col("_digest"), F.col("_first"))
    based = base.withColumn("_digest", F.xxhash64("_text"))
    found = let(F.split("_text", "\n"), lambda lines: _chunks(lines, spacing))
    chunks = written(
        spark,
        based.where("_text is not null").select("_id", "_digest", F.inline(found)),
        "line-chunks",
    )
    # Written, so that the join has a plain shuffle on both sides: only then can Spark part a hash
    # that a third of all texts have.
    repeated = chunks.groupBy(F.col("_hash").alias("_again")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(place).alias("_keep")
    )
    repeated = written(spark, repeated.where("_n > 1").select("_again", "_keep"), "line-firsts")
    marks = (
        chunks.join(repeated, F.col("_hash") == F.col("_again"))
        .groupBy(F.col("_id").alias("_doc"), F.col("_digest").alias("_same"))
        .agg(
            F.array_distinct(
                F.sort_array(
                    F.collect_list(
                        F.struct("_first", "_size", "_hash", (place != F.col("_keep")).alias("_out"))
                    )
                )
            ).alias("_marks")
        )
    )
    joined = written(
        spark,
        based.join(
            marks,
            F.col("_id").eqNullSafe(F.col("_doc")) & F.col("_digest").eqNullSafe(F.col("_same")),
            "left",
        ).drop("_doc", "_same"),
        "line-dedup",
    )
    with_passages = let(
        F.split("_text", "\n"),
        lambda lines: F.transform(
            "_marks",
            lambda mark: F.struct(
                mark["_first"].alias("_first"),
                mark["_size"].alias("_size"),
                mark["_hash"].alias("_hash"),
                _passage(lines, mark["_first"], mark["_size"]).alias("_passage"),
            ),
        ),
    )
    texts = joined.where(F.col("_marks").isNotNull()).select("_id", "_digest", F.inline(with_passages))
    clashes = (
        texts.groupBy("_hash")
        .agg(F.min("_passage").alias("_least"), F.max("_passage").alias("_greatest"))
        .where(F.col("_least") != F.col("_greatest"))
        .select(F.col("_hash").alias("_clash"))
    )
    clashes = written(spark, clashes, "line-dedup-clashes")
    if not clashes.isEmpty():
        joined = _told_apart(joined, texts, clashes)
    return _without_marked(joined, columns, text)


def _told_apart(joined: DataFrame, texts: DataFrame, clashes: DataFrame) -> DataFrame:
    """The same marks, where those of clashing hashes compare whole passages; a passage that then
    occurs once has none."""
    order = [F.col("_id").isNull(), F.col("_id"), F.col("_digest"), F.col("_first")]
    clashing = texts.join(clashes, F.col("_hash") == F.col("_clash"))
    firsts = clashing.groupBy(F.col("_passage").alias("_same_passage")).agg(
        F.min(F.struct(*order)).alias("_keep"), F.count(F.lit(1)).alias("_times")
    )
    size = F.when(F.col("_times") > 1, F.col("_size")).otherwise(F.lit(0)).alias("_size")
    again = (
        clashing.join(firsts, F.col("_passage") == F.col("_same_passage"))
        .groupBy(F.col("_id").alias("_doc"), F.col("_digest").alias("_same"))
        .agg(
            F.collect_list(
                F.struct("_first", size, "_hash", (F.struct(*order) != F.col("_keep")).alias("_out"))
            ).alias("_mended")
        )
    )
    return (
        joined.join(
            again,
            F.col("_id").eqNullSafe(F.col("_doc")) & F.col("_digest").eqNullSafe(F.col("_same")),
            "left",
        )
        .withColumn(
            "_marks",
            F.when(
                F.col("_mended").isNotNull(),
                F.transform(
                    "_marks",
                    lambda m: F.coalesce(
                        F.get(
                            F.filter("_mended", lambda x: x["_first"] == m["_first"]), F.lit(0)
                        ),
                        m,
                    ),
                ),
            ).otherwise(F.col("_marks")),
        )
        .withColumn("_marks", F.filter("_marks", lambda mark: mark["_size"] > 0))
        .drop("_doc", "_same", "_mended")
    )


def _without_marked(joined: DataFrame, columns: list[str], text: str) -> DataFrame:
    """The rows without the lines that only lie in chunks out of their first place."""

    def lines_in(marks: Column) -> Column:
        return F.flatten(
            F.transform(
                marks,
                lambda mark: F.sequence(mark["_first"], mark["_first"] + mark["_size"] - 1),
            )
        )

    marks = F.coalesce(F.col("_marks"), F.array().cast(joined.schema["_marks"].dataType))
    gone = F.array_except(
        lines_in(F.filter(marks, lambda mark: mark["_out"])),
        lines_in(F.filter(marks, lambda mark: ~mark["_out"])),
    )

    def rest(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    thinned = joined.withColumn("_gone", gone).withColumn(
        "_rest",
        F.when(F.size("_gone") > 0, let(F.split("_text", "\n"), rest)).otherwise(F.col("_text")),
    )
    n_lines = F.length("_text") - F.length(F.replace("_text", F.lit("\n"), F.lit(""))) + 1
    return thinned.select(
        *[(F.col("_rest") if c == text else F.col("_row")[c]).alias(c) for c in columns],
        F.coalesce(n_lines, F.lit(0)).cast("long").alias("n_lines"),
        F.size("_gone").cast("long").alias("n_removed"),
    )

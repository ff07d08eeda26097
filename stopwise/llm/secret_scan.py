"""Secret scans: candidates by shape, false positives removed by a random forest.

A candidate is a run of ``MIN_LENGTH`` or more letters, digits and ``+ / _ -`` within a word. It
is described by its length, its character classes and how often they change, how much of it
the corpus' own frequent words cover, the path of its document, and the words beside it. A random
forest trained on labelled findings then tells secrets from words, names and placeholders.

Everything runs as DataFrame expressions and Spark ML in the JVM.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.llm.text import let, unique_name, words_of, written

MIN_LENGTH = 16
DICTIONARY_WORDS = 1_000
TRAINING_ROWS = 20_000
TREES = 24
DEPTH = 6

# The usual names of credentials, and of things that only look like them.
CREDENTIAL_NAMES = "passwd|password|pwd|secret|token|api_?key|access_?key|auth|bearer|credential"
PLACEHOLDER_NAMES = "example|sample|dummy|placeholder|changeme|your_|xxxx|test|fixture|mock"

FEATURES = (
    "length",
    "digit_share",
    "upper_share",
    "class_changes",
    "distinct_share",
    "is_hexadecimal",
    "longest_letters",
    "dictionary_coverage",
    "path_is_example",
    "path_depth",
    "named_as_credential",
    "named_as_placeholder",
    "is_assigned",
)


def candidates(docs: DataFrame, text: str = "text", path: str = "source") -> DataFrame:
    """``doc_id, word_no, run_no, token, before, inside, after, path``, one row per candidate.

    ``word_no`` counts the words of the text from 0 and ``run_no`` the runs of its word;
    ``inside`` is the rest of the word in front of the run, ``before`` the two words in front,
    ``after`` the one behind. Null and empty texts have none.
    """
    run = f"[A-Za-z0-9+/_-]{{{MIN_LENGTH},}}"

    def found(words: Column) -> Column:
        def described(word: Column, i: Column) -> Column:
            return F.when(
                (F.length(word) >= MIN_LENGTH) & word.rlike(run),
                F.struct(
                    i.alias("word_no"),
                    word.alias("word"),
                    F.array_join(
                        F.slice(words, F.greatest(i - 1, F.lit(1)), F.least(i, F.lit(2))), " "
                    ).alias("before"),
                    F.coalesce(F.get(words, i + 1), F.lit("")).alias("after"),
                ),
            )

        return F.filter(F.transform(words, described), lambda x: x.isNotNull())

    return (
        docs.select(
            "doc_id",
            F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"),
            F.inline(let(words_of(F.col(text)), found)),
        )
        .select(
            "*",
            F.posexplode(F.regexp_extract_all("word", F.lit(f"({run})"), F.lit(1))).alias("run_no", "token"),
        )
        .select(
            "doc_id",
            "word_no",
            "run_no",
            "token",
            "before",
            F.expr("substring(word, 1, instr(word, token) - 1)").alias("inside"),
            "after",
            "path",
        )
    )


def dictionary(docs: DataFrame, text: str = "text", size: int = DICTIONARY_WORDS) -> list[str]:
    """The three-letter parts of the ``size`` most frequent words of three letters or more, over
    all texts, in lower case. Bounded by ``size``, whatever the corpus."""
    words = docs.select(F.explode(words_of(F.col(text))).alias("word"))
    counted = (
        words.groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lower(F.regexp_replace("word", "[^\\p{L}]", "")).alias("word"), "n")
        .where(F.length("word") >= 3)
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "word")
        .limit(size)
    )
    parts = F.transform(
        F.sequence(F.lit(1), F.length("word") - 2), lambda i: F.substr(F.col("word"), i, F.lit(3))
    )
    return sorted(r["part"] for r in counted.select(F.explode(parts).alias("part")).distinct().collect())


def _count(pattern: str) -> Column:
    return F.regexp_count("token", F.lit(pattern)).cast("double")


def featured(found: DataFrame, parts: list[str]) -> DataFrame:
    """Candidates with the columns ``FEATURES``, all double."""
    length = F.length("token").cast("double")
    changes = (
        _count("[a-z](?=[A-Z0-9])") + _count("[A-Z](?=[a-z0-9])") + _count("[0-9](?=[A-Za-z])")
    )
    known = F.expr("split('" + ",".join(p for p in parts if "'" not in p and "," not in p) + "', ',')")
    lowered = F.lower("token")
    covered = F.size(
        F.filter(
            F.sequence(F.lit(1), F.length("token") - 2),
            lambda i: F.array_contains(known, F.substr(lowered, i, F.lit(3))),
        )
    ) / (length - 2)
    letters = F.array_max(
        F.transform(F.split("token", "[^A-Za-z]+"), lambda part: F.length(part))
    )
    named = F.lower(F.concat_ws(" ", "before", "inside"))
    around = F.lower(F.concat_ws(" ", "before", "inside", "after"))
    values = {
        "length": length,
        "digit_share": _count("[0-9]") / length,
        "upper_share": _count("[A-Z]") / length,
        "class_changes": changes / length,
        "distinct_share": F.size(F.array_distinct(F.split("token", ""))) / length,
        "is_hexadecimal": F.col("token").rlike("^[0-9a-f]+$|^[0-9A-F]+$"),
        "longest_letters": letters / length,
        "dictionary_coverage": covered,
        "path_is_example": F.lower("path").rlike(PLACEHOLDER_NAMES),
        "path_depth": F.regexp_count("path", F.lit("/")),
        "named_as_credential": named.rlike(f"({CREDENTIAL_NAMES})[^\\p{{L}}]{{0,4}}$"),
        "named_as_placeholder": around.rlike(PLACEHOLDER_NAMES),
        "is_assigned": named.rlike("[=:][\\s\"'`]*$"),
    }
    return found.select("*", *[values[name].cast("double").alias(name) for name in FEATURES])


def train(labelled: DataFrame, rows: int = TRAINING_ROWS, seed: int = 7) -> RandomForestClassificationModel | None:
    """A forest of featured findings with a ``label`` of 0.0 or 1.0; None if it has not both.

    Fitted on up to about ``rows`` findings of each label, drawn by a hash of the finding, and
    put in one order, so that the same findings always give the same forest.
    """
    spark = labelled.sparkSession
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if {0.0, 1.0} - counts.keys():
        return None
    at = F.pmod(F.xxhash64("doc_id", "word_no", "run_no", "token"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("label") == 1.0, min(1.0, rows / counts[1.0])).otherwise(min(1.0, rows / counts[0.0]))
    drawn = (
        labelled.where(at < share)
        .select("label", *FEATURES, at.alias("at"), "token")
        .orderBy("at", "token", *FEATURES)
        .coalesce(1)
    )
    drawn = written(spark, drawn, "secret-training")
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=seed
    )
    return forest.fit(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(drawn))


def scored(found: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """Featured candidates with ``score`` (0 to 1) and ``is_secret`` (0.5 or more); with no model
    nothing is removed: the score is 1."""
    if model is None:
        return found.withColumn("score", F.lit(1.0)).withColumn("is_secret", F.lit(True))
    vector = unique_name(found, "_features")
    model = model.setFeaturesCol(vector).setPredictionCol("").setRawPredictionCol("").setProbabilityCol("_votes")
    judged = model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol=vector).transform(found))
    return (
        judged.withColumn("score", F.round(F.get(vector_to_array("_votes"), F.lit(1)), 6))
        .withColumn("is_secret", F.col("score") >= 0.5)
        .drop(vector, "_votes")
    )


def known_format() -> Column:
    """A label for findings that need no model: keys of a fixed format, and hexadecimal values
    assigned to a credential's name. All others are labelled as no secret."""
    cloud_key = F.col("token").rlike("^AKIA[0-9A-Z]{16}$")
    assigned = (
        (F.col("named_as_credential") == 1.0) & (F.col("is_hexadecimal") == 1.0) & (F.col("digit_share") > 0)
    )
    return (cloud_key | assigned).cast("double")


def scan(spark: SparkSession, docs: DataFrame, text: str = "text", path: str = "source") -> DataFrame:
    """All candidates of ``docs`` with features, ``score`` and ``is_secret``.

    The forest learns from the findings of documents whose crc32(doc_id) modulo 5 is not 0,
    labelled by ``known_format``. Pass other findings to ``train`` where better labels exist.
    Rows that repeat are scanned like any other; an empty table gives an empty result.
    """
    found = written(
        spark, featured(candidates(docs, text, path), dictionary(docs, text)), "secret-candidates"
    )
    teaches = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) != 0
    model = train(found.where(teaches).withColumn("label", known_format()))
    return scored(found, model)

"""One query per operator over whole tables of the test data, under the names of the task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.llm import (
    filter_audit,
    fingerprints,
    language,
    line_dedup,
    mixing,
    ngram_join,
    pieces,
    prefix_trie,
    quality,
    rule_ensemble,
    secret_scan,
    substring_dedup,
    url_filter,
)
from stopwise.llm.url_filter import UrlRule

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# The rules of the URL filter query.
URL_RULES = (
    UrlRule("com", "/", "allow"),
    UrlRule("example.com", "/en/", "block"),
    UrlRule("www.example.com", "/en/", "allow"),
    UrlRule("net", "/es/", "block"),
    UrlRule("net", "/fr/", "block"),
)


def query(function):
    REGISTRY[function.__name__] = function
    return function


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


@query
def op4_url_filter(spark, sf):
    pages = read(spark, sf, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, URL_RULES).drop("url")


@query
def op5_line_dedup(spark, sf):
    kept = line_dedup.line_dedup(read(spark, sf, "documents").select("doc_id", "text"))
    return kept.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


@query
def op7_quality_rules(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    return quality.judged(spark, docs).select(
        "doc_id", *quality.MEASURES, "base_failed", "kept"
    )


@query
def op9_mixing(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "source", "text")
    return mixing.mix(mixing.sized_documents(docs)).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


@query
def op1_fingerprints(spark, sf):
    return fingerprints.with_next_edited(read(spark, sf, "documents").select("doc_id", "text"))


@query
def op8_language_id(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", language.held_out())
    model = language.train(docs.where("not held_out"))
    return language.identify(docs.drop("lang"), model).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected"
    )


# The public SentencePiece model the queries encode with; any other is a matter of its path.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


@query
def op3_sentencepiece(spark, sf):
    vocabulary = pieces.Vocabulary.load(PIECES)
    docs = read(spark, sf, "documents").select("doc_id", "text")
    return pieces.round_trips(pieces.encode(docs, vocabulary), vocabulary)


@query
def op10_ngram_join(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    return ngram_join.joined(docs, ngram_join.Similarity(percent=90, words=3))


@query
def op6_substring_dedup(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    return substring_dedup.substring_dedup(docs).select(
        "doc_id",
        "n_words",
        "n_removed",
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


@query
def op2_secret_scan(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text", "source")
    return secret_scan.scan(spark, docs).select(
        "doc_id",
        "word_no",
        "run_no",
        F.sha2(F.col("token").cast("binary"), 256).alias("token_sha256"),
        F.col("length").cast("long").alias("n_chars"),
        "score",
        "is_secret",
    )


@query
def op13_filter_audit(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "source", "text")
    return filter_audit.audited(docs, read(spark, sf, "labels"))


@query
def op12_prefix_trie(spark, sf):
    conversations = read(spark, sf, "conversations")
    return prefix_trie.trie(*prefix_trie.branched(*prefix_trie.sequences(conversations)))


@query
def op11_rule_ensemble(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", language.held_out())
    marks = read(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    model = rule_ensemble.train(docs, marks.where(~language.held_out()))
    return rule_ensemble.scored(docs, model).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )

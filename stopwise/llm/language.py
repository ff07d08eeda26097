"""Language identification by compression.

For each language a raw-content zstandard dictionary is filled with training text. A text is
compressed, lower-cased, less its punctuation and in blocks, once with each dictionary, and gets the language whose
dictionary makes it smallest. Every block is used, so long texts are judged as a whole while a
block cannot grow so long that the compressor learns from the text instead of the dictionary.
Where the runner-up comes closer than ``min_margin``, the text is rejected: its language is still
named, with ``rejected`` set.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise.llm.text import small_batches_for

DICTIONARY_BYTES = 48 * 1024
SAMPLE_DOCS = 400
BLOCK_BYTES = 2048
MIN_MARGIN = 0.01
UNDETERMINED = "und"


# ASCII other than letters separates words; letters are lower case; bytes beyond ASCII stay.
_LETTERS = bytes(
    b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256)
)


def _spoken(text: str) -> bytes:
    """The words of a text in lower case, of a word said several times in a row the first."""
    words = text.lower().encode("utf-8", "replace").translate(_LETTERS).split()
    return b" ".join(word for word, _ in groupby(words))


def _parameters() -> zstandard.ZstdCompressionParameters:
    """A greedy search for matches of four bytes on: short ones tell languages apart."""
    return zstandard.ZstdCompressionParameters(
        window_log=17,
        chain_log=16,
        hash_log=16,
        search_log=4,
        min_match=4,
        target_length=32,
        strategy=zstandard.STRATEGY_GREEDY,
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
    )


@dataclass(frozen=True)
class CompressionModel:
    """A dictionary's content for each language, and how to use it."""

    contents: dict[str, bytes]
    block_bytes: int = BLOCK_BYTES
    min_margin: float = MIN_MARGIN


def train(
    labelled: DataFrame,
    dictionary_bytes: int = DICTIONARY_BYTES,
    sample_docs: int = SAMPLE_DOCS,
    **options,
) -> CompressionModel:
    """A model of ``lang, text`` rows; rows where either is null teach nothing.

    The sample is bounded: per language about ``sample_docs`` distinct texts, drawn by a hash
    of the text, of which up to ``dictionary_bytes`` are kept, the same share of each document's
    beginning. What the driver gathers is thus at most ``2 * dictionary_bytes`` or so per
    language, whatever the size of the corpus. The distinct texts of each label are counted first,
    so copies, which are drawn together or not at all, do not lower the share.
    """
    rows = labelled.where("lang is not null and text is not null").select("lang", "text")
    texts = rows.groupBy("lang").agg(F.count_distinct(F.xxhash64("text")).alias("n"))
    counts = {r["lang"]: r["n"] for r in texts.collect()}
    if not counts:
        return CompressionModel({}, **options)
    a_document = max(64, 2 * dictionary_bytes // sample_docs)
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(None).cast("double")
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample_docs / n))).otherwise(share)
    drawn = (
        rows.where(draw < share)
        .select("lang", F.xxhash64("text").alias("at"), F.substring("text", 1, a_document).alias("text"))
        .distinct()
        .collect()
    )
    contents = {}
    for lang in sorted(counts):
        ranked = sorted((r["at"], r["text"]) for r in drawn if r["lang"] == lang)
        contents[lang] = b" ".join(_spoken(text) for _, text in ranked)[-dictionary_bytes:]
    return CompressionModel({k: v for k, v in contents.items() if v}, **options)


class _Judge:
    """The compressors of one Python worker."""

    def __init__(self, model: CompressionModel):
        self.block, self.margin = model.block_bytes, model.min_margin
        self.languages = list(model.contents)
        self.compressors = []
        for content in model.contents.values():
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(compression_params=_parameters())
            self.compressors.append(
                zstandard.ZstdCompressor(dict_data=held, compression_params=_parameters())
            )

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        if not self.languages or text is None or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, True
        data, block = _spoken(text) or b" ", self.block
        pieces = [data[i : i + block] for i in range(0, len(data), block)]
        sizes = [
            (sum(len(c.compress(piece)) for piece in pieces), lang)
            for c, lang in zip(self.compressors, self.languages)
        ]
        sizes.sort()
        best = sizes[0]
        if len(sizes) == 1:
            return best[1], 1.0, False
        score = 1.0 - best[0] / sizes[1][0]
        return best[1], score, score < self.margin


def judged_language(text: Column, model: CompressionModel) -> Column:
    """``struct<lang_pred, score, rejected>`` for a text.

    ``score`` is the share by which the best dictionary beats the runner-up, 0 to 1. A text
    that is null or has no letter, or any text under a model that learned nothing, is ``und``
    with score 0, and rejected. Ties go to the language that comes first in code point order,
    with score 0.
    """

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        judge_one = _Judge(model)
        for batch in batches:
            yield pd.DataFrame(
                [judge_one(x) for x in batch], columns=["lang_pred", "score", "rejected"]
            )

    return judge(text)


def identify(docs: DataFrame, model: CompressionModel) -> DataFrame:
    """``docs`` with ``lang_pred, score, rejected``; columns of those names are replaced."""
    small_batches_for(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    return docs.select(*kept, judged_language(F.col("text"), model).alias("_judged")).select(
        *kept, "_judged.lang_pred", "_judged.score", "_judged.rejected"
    )


def held_out() -> Column:
    """Whether a document is kept from training: the checksum of its id is a multiple of 5."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0

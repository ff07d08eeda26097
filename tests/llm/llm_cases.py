from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def documents(spark):
    """Rows of (doc_id, text[, lang, source]) as a table of documents."""

    def make(rows, **extra):
        full = [
            (r[0], r[1], *(list(r[2:]) + [None, None])[:2], None if r[1] is None else len(r[1]))
            for r in rows
        ]
        df = spark.createDataFrame(full, DOCUMENT)
        for name, value in extra.items():
            df = df.withColumn(name, value)
        return df

    return make


ODD_TEXTS = [
    (0, None),
    (1, ""),
    (2, "\n\n"),
    (3, " \t\r\n"),
    (4, "one"),
    (5, "a b\nc  d\n a b\nc  d"),
    (6, "ÀÉ ñandú 日本語 😀 ▁ x\u00a0y\u2003z"),
    (7, "word " * 30_000),
    (8, "x" * 60_000),
    (9, "same text\nof two lines\nand three"),
    (10, "same text\nof two lines\nand three"),
    (10, "same text\nof two lines\nand three"),
    (None, "same text\nof two lines\nand three"),
    (None, None),
]

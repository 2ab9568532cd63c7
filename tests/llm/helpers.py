"""Small document tables with the awkward cases every operator must take."""

from __future__ import annotations

import re

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, texts, first=0, lang="en"):
    return spark.createDataFrame(
        [(first + i, t, lang, f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)], DOCS)


def awkward(spark):
    """Null and empty texts, a null id, repeated rows, one long text, and extra
    columns whose names operators might use themselves."""
    long_text = " ".join(f"word{i % 977}x{i % 13}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, "   \n\t "), (None, "a text without an id"), (4, "one two three four"),
            (4, "one two three four"), (5, "one two three four"), (6, long_text), (7, long_text), (8, "\n\n")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    return df.selectExpr("*", "'x' AS id", "1 AS row", "2 AS mark", "'y' AS node", "3 AS label", "4 AS part",
                         "5 AS place", "6 AS fingerprint", "7 AS text_id", "8 AS ids", "9 AS _pieces")


def no_documents(spark):
    return spark.createDataFrame([], DOCS)

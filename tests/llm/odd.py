"""Documents that every operator must take: nulls, empty and long texts, repeats, clashing columns."""

from __future__ import annotations

LONG = " ".join(f"word{i % 977} of a long text," for i in range(9000))
ODD = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "s1"),
    (2, None, "s1"),
    (3, "", "s2"),
    (4, " \t\n\r ", None),
    (None, "A text without an id stands here, under CC BY 4.0.", "s2"),
    (5, "The quick brown fox jumps over the lazy dog near the river bank today.", "s3"),
    (5, "The quick brown fox jumps over the lazy dog near the river bank today.", "s3"),
    (7, "Ünïcödé ÀÉ ΣΑΣ İstanbul <|endoftext|> 12345 it's 中文 🙂🙂 é", "s3"),
    (8, LONG, "s1"),
    (9, "!!! ??? $$$", "s1"),
    (10, "x", ""),
]


def odd_docs(spark, rows=ODD):
    """The rows with extra columns whose names operators use inside."""
    schema = "doc_id long, text string, source string, id string, score string, key int, row int, _text int, label int"
    return spark.createDataFrame([(*r, "a", "b", 1, 2, 3, 4) for r in rows], schema)


def empty_docs(spark):
    return odd_docs(spark, [])

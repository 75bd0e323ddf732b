"""Small tables for the training-data operators."""

from __future__ import annotations

SF = "/root/testdata/sf0.001"

LONG = "lorem ipsum dolor sit amet consectetur " * 4000          # 160,000 characters
SOLID = "abcdefghijklmnopqrstuvwxyz0123456789" * 300              # no space at all
NEAR = " ".join(f"word{i}" for i in range(60))
NEAR2 = NEAR.replace("word59", "changed")                        # 55 of 57 shingles in common

#: Names that the operators use themselves, as extra columns of the caller.
CLASH = ("row", "id", "tk", "body", "key", "node", "score", "h", "n", "seq", "keys", "dropped", "mix_copies", "piece_ids", "digest", "clean")

ROWS = [
    (1, "Hello World, this is a line.\nsecond line of the text here\n\nthird", "en", "a", 10),
    (2, "hello world, this is a line.\nSecond line of the text here", "en", "a", 11),
    (2, "hello world, this is a line.\nSecond line of the text here", "en", "a", 11),   # repeated row
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, "   \n \t ", "en", "b", 6),
    (None, "a text without an id, twice with the same words here", "en", "c", 3),
    (None, "another text without an id that is not the same at all", None, "c", 3),
    (6, LONG, "en", "a", len(LONG)),
    (7, SOLID, "en", "a", len(SOLID)),
    (8, NEAR, "en", "hot", 1), (9, NEAR2, "en", "hot", 1), (10, NEAR, "en", "hot", 1), (11, NEAR, "en", "hot", 1),
    (12, "é ▁ literal mark ▁▁ and   spaces \t\n 中文字符 🙂 end ", "fr", "d", 9),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows=None, clash=True, parts=3):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS if rows is None else rows, SCHEMA).repartition(parts)
    return df.select("*", *[F.lit(f"x_{c}").alias(c) for c in CLASH]) if clash else df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=lambda r: tuple((x is None, str(x)) for x in r))

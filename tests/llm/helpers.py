"""Small tables with the awkward rows every operator must bear, and what brute force makes of texts."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names the operators use inside.
        T.StructField("text_hash", T.StringType()),
        T.StructField("copies", T.StringType()),
        T.StructField("fp", T.LongType()),
        T.StructField("row", T.LongType()),
        T.StructField("removed_spans", T.StringType()),
    ]
)


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(words))


def texts() -> list[tuple[int | None, str | None]]:
    base = prose(1, 60)
    passage = prose(2, 15)
    return [
        (1, base),
        (2, base),  # exact copy
        (3, base.replace("a", "A", 1)),  # equal but for case
        (4, prose(3, 10) + passage + prose(4, 10)),
        (5, passage + " é😀 " + prose(5, 5)),
        (6, None),
        (7, ""),
        (8, " \n\t "),
        (9, "word"),
        (10, prose(6, 30_000)),  # very long
        (11, "same line of text here\n" * 40),
        (11, "same line of text here\n" * 40),  # repeated row
        (12, "naïve café " * 30),
        (None, base),
        (None, None),
        (13, prose(7, 40) + "\n" + prose(8, 40)),
        (14, "x" * 5000),
        (15, "x" * 49),
    ]


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    sources = ["a", "b", None]
    return spark.createDataFrame(
        [(i, t, "en", sources[k % 3], len(t or ""), "h", "c", 5, 7, "s") for k, (i, t) in enumerate(rows)], DOCS
    )

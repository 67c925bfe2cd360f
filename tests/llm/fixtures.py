"""Small tables with nulls, empty, long and repeated texts, and columns whose names clash."""

import random

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000))
DOCS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today. Mail jo.do@mail.example.com now.", "en", "src0", 100),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today. Mail jo.do@mail.example.com now.", "en", "src0", 100),
    (3, None, None, None, None),
    (4, "", "en", "src1", 0),
    (5, LONG, "de", "src2", len(LONG)),
    (6, "Ünïcödé  words\n\n here ▁ and 漢字 テスト, 10.0.0.1 +1 (555) 123-4567 <|endoftext|>", "fr", None, 60),
    (7, "   ", "en", "src1", 3),
    (8, "Released under the MIT License.", "en", "src1", 31),
    (9, "!!! ??? ###", "en", "src1", 11),
    (9, "!!! ??? ###", "en", "src1", 11),
    (None, "a row without an id", "en", "src1", 19),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("spans", "base", "keep", "state", "copy", "class_id", "n_words", "p_quality", "parts", "length", "media")


def docs(spark, clash: bool | str = False, rows=DOCS):
    """clash: columns named as those that operators add; "case": and one that differs from `text` by case only."""
    df = spark.createDataFrame(rows, SCHEMA)
    more = (*CLASH, "TEXT") if clash == "case" else CLASH if clash else ()
    return df.select("*", *(F.lit(k).alias(n) for k, n in enumerate(more)))


def labels(spark, rows=()):
    return spark.createDataFrame([*rows], "doc_id long, quality int, toxic int")


def texts(seed: int, n: int, words: int = 120) -> list[str]:
    rnd = random.Random(seed)
    known = [f"w{i}" for i in range(5000)]
    return [" ".join(rnd.choice(known) for _ in range(words)) for _ in range(n)]

"""Inputs with nulls, ties, repeated rows, odd texts and columns whose names operators use themselves."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = (
    "id key n line size digest kept keep_id group_size component_id n_words left gone least target copies "
    "score predicted ids bucket hub salt content rank offset sid doc"
).split() + ["a.b"]


def prose(seed, n, words=400):
    rng = random.Random(seed)
    stock = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(words)]
    return " ".join(rng.choice(stock) for _ in range(n))


def odd_rows():
    base = prose(1, 120)
    near = base.split(" ")
    near[60] = "changed"
    rows = [
        (1, base, "en", "b", 1), (2, base, "en", None, None), (3, " ".join(near), None, "a", 2),
        (4, base.replace(" ", "\n\t", 7), "en", "b", 3), (5, None, "en", "b", 4), (6, "", "en", "a", 5),
        (7, " \t\r\n ", None, None, 6), (8, "one", "en", "c", 7), (9, "one two three", "en", "c", 8),
        (None, base, "en", "c", 9), (None, None, None, None, None), (10, prose(2, 200), "en", "b", 10),
        (10, prose(2, 200), "en", "b", 10), (11, prose(3, 30_000), "en", "a", 11), (12, "é" * 20_000, "fr", "a", 12),
        (13, "One TWO three", "en", "c", 13), (14, "a b c\x1cd", "en", "c", 14),
        (15, "the <|endoftext|> mark, it's  here", "en", "c", 15), (16, "w " * 500, "en", "d", 16),
    ]
    return rows


def odd_docs(spark, clashes=True):
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    return df.withColumns({c: F.lit(c) for c in CLASHES}) if clashes else df


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def whole_table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")

"""Small tables with what goes wrong in large ones: nulls, empty and long texts, repeats, ties."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string"


def prose(seed: int, words: int = 120) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("bdfgklmnprst") + draw.choice("aeiou") for _ in range(draw.randint(1, 3))) for _ in range(words)) + "."


def changed(text: str, at: int, word: str = "xyzzy") -> str:
    parts = text.split(" ")
    parts[at] = word
    return " ".join(parts)


def documents(spark, rows):
    return spark.createDataFrame(rows, DOCS)


# names that the operators use inside
CLASHING = ("node", "bucket", "print", "hits", "likely", "keys", "key", "quality", "n", "shard", "rank", "score", "words", "text_", "own_id_")


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *(F.lit(i).alias(name) for i, name in enumerate(CLASHING)))


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)

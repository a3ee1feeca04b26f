"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import types as T

TOKENIZERS = "/opt/tokenizers"
SPACES = " \t\n\x0b\x0c\r"

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())]
)


def words_of(text: str | None) -> list[str]:
    out, word = [], ""
    for c in text or "":
        if c in SPACES:
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out + [word] if word else out


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def random_text(rng: random.Random, n: int, letters: str = "abcdeé") -> str:
    return " ".join(
        "".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(n)
    )


def hard_rows(seed: int = 7) -> list[tuple]:
    """Rows that every operator must take."""
    rng = random.Random(seed)
    base = random_text(rng, 60)
    return [
        (1, None, "en", "a"), (2, "", "en", None), (3, " \n\t ", None, "a"), (4, "x", "fr", "b"),
        (5, base, "en", "a"), (6, base, None, "b"), (6, base, None, "b"), (7, base + " tail", "fr", ""),
        (None, base, "fr", "b"), (None, None, None, None), (8, "1234 !?", "en", "a"),
        (9, random_text(rng, 20000), "en", "b"), (10, "ÀÉÎ Ünïcode \x0b tail\x85end", "fr", "c"),
        (11, "line\nline\nline\n\nother", "en", "c"), (5, "same id, other text", "en", "a"),
    ]


def docs(spark, rows=None):
    return spark.createDataFrame(hard_rows() if rows is None else rows, DOCS)

"""Small tables with the awkward rows every corpus operator must take."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("abcdefghijklmnop") for _ in range(pick.randint(2, 8))) for _ in range(n))


def documents(spark, texts, first=0):
    """doc_id from ``first`` in the order of ``texts``; pairs give their own id."""
    rows = []
    for i, t in enumerate(texts):
        doc, text = t if isinstance(t, tuple) else (first + i, t)
        rows.append((doc, text, "en", "src0", None if text is None else len(text)))
    return spark.createDataFrame(rows, SCHEMA)


def write(df, folder, name):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


AWKWARD = [None, "", " \t\n ", "word", "two words", "\n\n\n", "é" * 3, "a" * 50_000, words(1, 30_000), "x " * 5_000]

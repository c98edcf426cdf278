"""Small tables with nulls, empty and long texts, ties, repeated rows and columns whose names clash."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def rows(seed: int = 1, n: int = 40) -> list[tuple]:
    """Documents of invented words, with exact and near copies, repeated lines and passages, nulls and empties."""
    rng = random.Random(seed)
    passage, line = words(rng, 40), words(rng, 14)
    texts: list[str | None] = []
    for i in range(n):
        lines = [words(rng, rng.randrange(3, 30)) for _ in range(rng.randrange(1, 6))]
        if i % 3 == 0:
            lines.insert(rng.randrange(len(lines) + 1), line)
        if i % 7 == 0:
            lines.append(line.replace("w1", "w2", 1))
        if i % 4 == 0:
            lines.append(passage + " " + words(rng, 3))
        texts.append("\n".join(lines))
    texts += [texts[0], texts[1], texts[2] + " tail", texts[3].replace("w3", "W3"), None, "", " \n\t ", "one", "Ünï cödé wörds " * 60, words(rng, 4000), "a" * 5000]
    out = [(i, t, "en", f"src{i % 3}" if i % 11 else None, len(t or "")) for i, t in enumerate(texts)]
    return [*out, out[5], out[-5]]


def table(spark, data: list[tuple], **extra: str):
    """The rows as a table; `extra` adds columns of text by name."""
    df = spark.createDataFrame(data, DOCS).repartition(3)
    for name, value in extra.items():
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit(value))
    return df

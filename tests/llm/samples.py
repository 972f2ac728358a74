"""Small documents with all that is awkward: nulls, empties, copies, repeats, long texts, odd characters, clashing names."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, gram long, digest string, bits long, sequence_id long, shard int, words string, doc long"


def texts(seed: int = 1, n: int = 60) -> list[str | None]:
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefgäéñ") for _ in range(r.randint(1, 7))) for _ in range(400)]

    def prose(k: int) -> str:
        return "".join(r.choice(vocabulary).capitalize() + r.choice([" ", " ", " ", "\n", ", ", ".  ", "\t"]) for _ in range(k))

    passage = prose(70)
    out: list[str | None] = [prose(r.randint(1, 160)) for _ in range(n)]
    for i in range(5, n, 7):
        out[i] = prose(r.randint(0, 30)) + passage + prose(r.randint(0, 30))
    for i in range(8, n, 9):
        out[i] = out[i - 3]
    for i in range(10, n, 13):
        words = (out[i - 1] or "").split(" ")
        words[len(words) // 2] = "changed"
        out[i] = " ".join(words)
    out[3] = None
    out[4] = ""
    out[6] = " \n\t "
    out[11] = "the same " * 300
    out[12] = "x" * 5000
    out[13] = "same " * 90 + "\U0001f600 Ünïcode     \x1c end"
    out[14] = None
    out[15] = prose(4000)
    out[16] = "<|endoftext|> a  b   c \n d"
    return out


def rows(seed: int = 1, n: int = 60) -> list[tuple[int | None, str | None]]:
    """(doc_id, text), ids not in the order of rows; one row is there twice and one has no id."""
    held = [((7 * i) % 1000, t) for i, t in enumerate(texts(seed, n))]
    held.append(held[2])
    held.append((None, held[5][1]))
    return held


def frame(spark: SparkSession, held: list[tuple[int | None, str | None]]) -> DataFrame:
    filled = [(i, t, None, "src", None if t is None else len(t), 1, "d", None, 5, 3, "w", 9) for i, t in held]
    return spark.createDataFrame(filled, SCHEMA).repartition(3)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)

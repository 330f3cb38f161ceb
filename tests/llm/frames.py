"""Small tables with every awkward case, and columns whose names the operators use themselves."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

CLASH = ["row", "id", "text_hash", "digest", "run", "rank", "size", "copy", "node", "label", "score", "order", "base"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
EXTRA = SCHEMA + "".join(f", `{name}` string" for name in CLASH)


def documents(spark: SparkSession, rows: list[tuple], clash: bool = True) -> DataFrame:
    """Rows of (doc_id, text, lang, source); the rest is filled in."""
    full = [(*r, len(r[1] or "")) for r in rows]
    if not clash:
        return spark.createDataFrame(full, SCHEMA)
    return spark.createDataFrame([(*r, *("x" for _ in CLASH)) for r in full], EXTRA)


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    parts = ["th", "er", "an", "ou", "in", "st", "re", "ea", "to", "né", "go", "li"]
    return " ".join("".join(draw.choice(parts) for _ in range(draw.randint(1, 4))) for _ in range(words))


def awkward() -> list[tuple]:
    """Nulls in every column, empty and blank texts, repeated rows and ids, copies, a very long text."""
    a, b = prose(1, 120), prose(2, 90)
    return [
        (1, a, "en", "s0"),
        (2, a.replace(" ", "  "), "en", "s0"),
        (3, a + " ", None, "s0"),
        (4, b, "fr", None),
        (4, b, "fr", None),
        (5, None, "en", "s1"),
        (6, "", "en", "s1"),
        (7, " \t\n", None, None),
        (None, b, "fr", "s1"),
        (None, prose(3, 40), None, "s0"),
        (8, prose(4, 60_000), "de", "s0"),
        (9, "été 🙂 naïve x", "fr", "s2"),
        (10, "one two three", "en", "s0"),
        (11, a[: len(a) // 2] + "changed " + a[len(a) // 2 :], "en", "s0"),
    ]

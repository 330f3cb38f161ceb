"""Fine likeness sees what two texts share when no leaf of the fixed stride does."""

from pyspark.sql import functions as F

from faregate.llm import fingerprints
from tests.llm.frames import awkward, documents, prose


def test_short_texts_of_one_line(spark):
    signs = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/é🙂"
    rows = [(n, "".join(signs[(7 * n + (n * n + 3) * i) % len(signs)] for i in range(n)), "en", "s") for n in (4, 9, 20, 37, 61, 88)]
    rows += [(100 + i, prose(i, 8)[:88], "en", "s") for i in range(8)]
    for r in fingerprints.edit_probe(documents(spark, rows), fine=True).collect():
        assert r["near_edited"] > 0.4 and r["near_edited"] > r["near_next"], r


def test_insertion_in_a_long_line(spark):
    for words in (60, 600):
        line = prose(words, words)
        texts = spark.createDataFrame([(line, line[:30] + "#" + line[30:], prose(words + 1, words))], "a string, b string, c string")
        no = F.lit(False)
        near, other = texts.select(
            fingerprints.fine_likeness(fingerprints.grams(F.col("a")), fingerprints.grams(F.col("b")), no),
            fingerprints.fine_likeness(fingerprints.grams(F.col("a")), fingerprints.grams(F.col("c")), no),
        ).first()
        assert near > 0.9 and other < near - 0.2
        stride = texts.select(fingerprints.likeness(fingerprints.leaves(F.col("a")), fingerprints.leaves(F.col("b")), no)).first()[0]
        assert stride < 0.1  # the loss that leaves have


def test_awkward_and_empty_tables(spark):
    assert fingerprints.edit_probe(documents(spark, awkward()), fine=True).filter("near_edited is null").count() == 0
    assert fingerprints.edit_probe(documents(spark, []), fine=True).count() == 0

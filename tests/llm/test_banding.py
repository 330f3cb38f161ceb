"""No threshold of the near-dedup loses links to its bands."""

import random

import pytest

from faregate.llm import minhash
from tests.llm.frames import documents, prose
from tests.llm.test_minhash import shingle_set


@pytest.mark.parametrize("percent", range(1, 101))
def test_a_pair_at_the_threshold_is_missed_as_stated(percent):
    bands, rows = minhash.banding(percent)
    assert (1 - (percent / 100) ** rows) ** bands <= minhash.MISSED
    assert rows == 1 or bands * rows <= minhash.MINIMA


def test_bands_of_the_query_and_of_the_pipeline():
    assert minhash.banding(85) == (25, 5) and minhash.banding(80) == (28, 4)
    assert minhash.slack(85) == minhash.SLACK and minhash.slack(50) > 0.28
    for wrong in (0, 101):
        with pytest.raises(ValueError):
            minhash.banding(wrong)


@pytest.mark.parametrize("percent", [80, 50, 5])
def test_pairs_just_above_a_threshold_are_linked(spark, percent):
    draw, texts = random.Random(percent), []
    while len(texts) < 120:
        base = prose(7000 + len(texts) * 100 + percent, 100).split()
        other = list(base)
        while True:
            other[draw.randrange(100)] = f"w{draw.randrange(10**9)}"
            a, b = shingle_set(" ".join(base)), shingle_set(" ".join(other))
            if 100 * len(a & b) < percent * len(a | b):
                break
            near = " ".join(other)
        texts += [" ".join(base), near]
    rows = [(i, t, "en", "s0") for i, t in enumerate(texts)]
    got = {r["id"]: r["component_id"] for r in minhash.near_duplicates(documents(spark, rows, clash=False), percent=percent).collect()}
    assert got == {i: i - i % 2 for i in range(len(rows))}

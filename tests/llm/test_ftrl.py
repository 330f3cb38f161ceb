"""The learner against follow-the-regularised-leader written out one coordinate at a time."""

import math
import random

import numpy as np
import pytest

from faregate.llm import quality


def plain_ftrl(rows):
    """Weights by coordinate; rows of ({slot: value}, label)."""
    z, n = {}, {}

    def weight(i):
        own = z.get(i, 0.0)
        if abs(own) <= quality.L1:
            return 0.0
        shrunk = own - math.copysign(quality.L1, own)
        return -shrunk / ((quality.BETA + math.sqrt(n.get(i, 0.0))) / quality.ALPHA + quality.L2)

    for _ in range(quality.EPOCHS):
        for features, label in rows:
            now = {i: weight(i) for i in features}
            total = sum(now[i] * x for i, x in features.items())
            guess = 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))
            for i, x in features.items():
                gradient = (guess - label) * x
                before = n.get(i, 0.0)
                sigma = (math.sqrt(before + gradient**2) - math.sqrt(before)) / quality.ALPHA
                z[i] = z.get(i, 0.0) + gradient - sigma * now[i]
                n[i] = before + gradient**2
    return {i: w for i in z if (w := weight(i))}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_learner_equals_the_plain_one(seed):
    draw = random.Random(seed)
    bias = 1 << quality.BITS
    rows = []
    for _ in range(120):
        label = draw.randint(0, 1)
        slots = draw.sample(range(0, 40), 6) + ([100 + draw.randint(0, 3)] if label else [200])
        rows.append(({**{i: float(np.float32(draw.random())) for i in slots}, bias: 1.0}, label))
    packed = [
        (np.array(list(f), dtype=np.int32), np.array(list(f.values()), dtype=np.float32), label) for f, label in rows
    ]
    want = {(-1 if i == bias else i): w for i, w in plain_ftrl(rows).items()}
    got = quality.learn(packed)
    assert set(got) == set(want) and len(got) > 3
    for slot, weight in want.items():
        assert abs(got[slot] - weight) < 1e-9 * max(1.0, abs(weight))


def test_order_of_rows_matters_to_both():
    rows = [({1: 1.0, 2: 0.5}, 1), ({1: 1.0, 3: 0.5}, 0), ({2: 1.0}, 1)]
    packed = lambda rows: [(np.array(list(f)), np.array(list(f.values())), y) for f, y in rows]
    for some in (rows, rows[::-1]):
        want, got = plain_ftrl(some), quality.learn(packed(some))
        assert set(got) == set(want) and all(abs(got[i] - w) < 1e-12 for i, w in want.items())

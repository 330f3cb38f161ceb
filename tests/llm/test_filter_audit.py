"""Filter audit against a plain walk of every order over every document."""

import itertools
import random
import re

import numpy as np

from faregate.llm import filter_audit
from tests.llm.frames import awkward, documents, prose


def plain_fails(rows):
    out = []
    for doc_id, text, *_ in rows:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        smaller = [r for r in rows if doc_id is not None and r[0] is not None and r[0] < doc_id and (r[1] or "") == text]
        fails = ""
        fails += "A" * (len(words) < 200)
        fails += "B" * (100 * len(set(words)) < 50 * len(words))
        fails += "C" * (100 * len(re.findall("[A-Z]", text)) > 2 * len(text))
        fails += "D" * bool(re.search("[#$%&*|]", text))
        fails += "E" * bool(smaller)
        out.append(set(fails))
    return out


def plain_audit(rows, good, toxic):
    fails, out = plain_fails(rows), {}
    for part in {r[3] or "" for r in rows}:
        own = [(f, r[0]) for f, r in zip(fails, rows) if (r[3] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        made = []
        for order in itertools.permutations("ABCDE"):
            left = list(own)
            for step, letter in enumerate(order, 1):
                removed = [x for x in left if letter in x[0]]
                left = [x for x in left if letter not in x[0]]
                failing = sum(letter in f for f, _ in own)
                shapley[letter] += len(removed)
                made.append((
                    part, "".join(order), step, letter, len(left), len(removed), failing - len(removed),
                    sum(f == {letter} for f, _ in own), sum(i in good for _, i in removed), sum(i in toxic for _, i in removed),
                ))
        for row in made:
            out[row[:3]] = (*row[4:], shapley[row[3]])
    return out


def as_dict(df):
    return {tuple(r[:3]): tuple(r[3:]) for r in df.collect()}


def test_equals_a_plain_audit(spark):
    draw = random.Random(5)
    pieces = [prose(1, 250), prose(2, 30), "up " * 300, "LOUD Words " * 150, "cost $5 # 1 " + prose(3, 220), ""]
    rows = awkward() + [
        (100 + i // 2, draw.choice(pieces) + draw.choice(["", " x", " & Y"]), None, draw.choice(["s0", "s1", "", None])) for i in range(60)
    ]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1])) for i in [*range(12), *range(100, 125), 100, None, None]]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    got = filter_audit.audit(documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    assert as_dict(got) == plain_audit(rows, good, toxic)


def test_no_documents_no_labels(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(documents(spark, []), none).count() == 0
    got = filter_audit.audit(documents(spark, [(1, "a", None, "s")]), none).collect()
    assert len(got) == 600 and {r["good_lost"] for r in got} == {0}


def test_words_edges(spark):
    texts = {"nbsp": "a b", "bell": "a\x1cb", "blank": " \t\x0b\x0c\r\n", "tail": "a b ", "vt": "a\x0bb"}
    counted = spark.createDataFrame(list(texts.items()), "name string, text string")
    for name, mask in counted.select("name", filter_audit.text_fails(counted["text"])).collect():
        words = re.findall("[^\x20\x09-\x0d]+", texts[name])
        assert mask == 1 + 2 * (100 * len(set(words)) < 50 * len(words)), name


def test_walk_states_are_survivors():
    weights = np.random.default_rng(1).integers(0, 9, (3, 32, 3))
    states = filter_audit.walk(weights)
    for active in range(32):
        alive = [m for m in range(32) if not m & active]
        assert (states[:, active] == weights[:, alive].sum(axis=1)).all()

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from faregate.llm import suffix_dedup
from faregate.llm.suffix_array import suffix_array
from tests.llm.frames import awkward, documents, prose


@given(st.lists(st.integers(1, 3), max_size=40))
@settings(max_examples=500, deadline=None)
def test_suffix_array_like_sorting(symbols):
    text = [*symbols, 0]
    assert suffix_array(np.array(text)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def brute(rows, length=200):
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for row, t in zip(rows, texts):
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        rest = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((row[0], len(t), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def result(df):
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def passages(seed):
    """Texts that share passages of about the threshold's length at any place, and periodic ones."""
    draw = random.Random(seed)
    shared = [prose(seed * 100 + i, draw.randint(20, 70)) for i in range(4)]
    rows = []
    for i in range(60):
        parts = [prose(seed * 10_000 + i, draw.randint(0, 60))]
        for passage in draw.sample(shared, draw.randint(0, 3)):
            low = draw.randint(0, 20)
            parts += [passage[low : len(passage) - draw.randint(0, 20)], prose(seed * 20_000 + i, draw.randint(0, 5))]
        rows.append((i, " ".join(parts), "en", "s0"))
    rows += [(100, "ab" * 300, "en", "s0"), (101, "x" * 199, "en", "s0"), (102, "y" * 200, "en", "s0")]
    return [*rows, (103, "y" * 201, "en", "s0"), (104, "z" * 199 + "q", "en", "s0")]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("group", [2_048, 3])
def test_removes_like_brute_force(spark, seed, group, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)  # 3: nearly all go the way of hot anchors
    rows = passages(seed)
    assert result(suffix_dedup.remove_repeats(documents(spark, rows, clash=False))) == brute(rows)


def test_awkward_rows(spark):
    rows = [r for r in awkward() if r[0] != 8] + [(8, prose(4, 3_000), "de", "s0")]
    assert result(suffix_dedup.remove_repeats(documents(spark, rows))) == brute(rows)


def test_very_long_text_and_kept_bytes(spark):
    long = prose(9, 300_000)
    rows = [(1, long, "en", "s"), (2, "start " + long[1000:1600] + " end", "en", "s")]
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(documents(spark, rows), with_kept=True).collect()}
    assert got[1]["n_removed"] == got[2]["n_removed"] >= 600 and got[1]["n_spans"] == 1
    a, b = got[2]["spans"][0]
    assert bytes(got[2]["kept"]) == (rows[1][1].encode()[:a] + rows[1][1].encode()[b:])


def test_empty_table(spark):
    assert suffix_dedup.remove_repeats(documents(spark, [])).count() == 0


def low_entropy():
    """Rules, padding and short periods, alone, inside prose and cut off at either end."""
    rule, dots = "=" * 700, "-." * 300
    rows = [(1, rule, "en", "s"), (2, f"{prose(1, 40)}\n{rule}\n{prose(2, 40)}", "en", "s"), (3, "=" * 200, "en", "s")]
    rows += [(4, f"{prose(3, 30)} {dots} {prose(4, 30)} {dots[:350]}", "en", "s"), (5, "abc" * 150 + "ab" * 150, "en", "s")]
    return [*rows, (6, "\0" * 900 + prose(5, 50) + "\0" * 201, "en", "s"), (7, "q" * 199, "en", "s")]


@pytest.mark.parametrize("cut", [1 << 24, 64, 331])
@pytest.mark.parametrize("group", [2_048, 1])
def test_short_periods_and_cut_texts_like_brute_force(spark, cut, group, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CUT", cut)
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    rows = low_entropy() + passages(5)[:25]
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    assert result(suffix_dedup.remove_repeats(documents(spark, rows, clash=False))) == brute(rows)


@pytest.mark.parametrize("cut", [1, 7, 100, 1000])
def test_pieces_hold_every_window_once(cut):
    data = np.frombuffer(prose(6, 300).encode(), dtype=np.uint8)
    found = [
        low + at
        for low, piece, edges in suffix_dedup.pieces(data, np.array([0, len(data)]), 200, cut)
        for at in range(len(piece) - 200 + 1)
    ]
    assert found == list(range(len(data) - 200 + 1))


def test_equal_characters_are_two_blocks():
    data = np.full(5_000_000, 61, dtype=np.uint8)
    found = suffix_dedup.collapsed(suffix_dedup.blocks(data, np.array([0, len(data)]), 200))
    assert len(found[0]) == 2 and found[-1][0] + 200 == len(data)


def test_millions_of_equal_characters(spark):
    rows = [(1, "=" * 5_000_000, "en", "s"), (2, "=" * 150 + prose(7, 100), "en", "s")]
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(documents(spark, rows, clash=False)).collect()}
    assert (got[1]["n_removed"], got[1]["n_spans"], got[2]["n_removed"]) == (5_000_000, 1, 0)

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from faregate.llm import packing
from tests.llm.frames import awkward, documents


@pytest.fixture(scope="module")
def slow():
    return Tokenizer.from_file(packing.public_path(packing.VOCABULARY))


def brute_pieces(rows, slow, size):
    out = []
    for doc_id, text, *_ in rows:
        ids = [*slow.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % size or size
        cuts = [0, *range(first, len(ids) + 1, size)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out.append((doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [16, 1024])
def test_pieces_and_places(spark, slow, size):
    rows = awkward()
    got = packing.pack(documents(spark, rows), size=size).collect()
    names = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted((tuple(r[n] for n in names) for r in got), key=str) == brute_pieces(rows, slow, size)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= size
    assert len(sequences) <= 1.25 * sum(r["length"] for r in got) / size + 2


def test_ids_can_be_kept(spark):
    rows = packing.pack(documents(spark, [(1, "a b", "en", "s")]), with_ids=True).collect()
    assert rows[0]["ids"][-1] == 2 and len(rows[0]["ids"]) == rows[0]["length"]


def test_empty_table(spark):
    assert packing.pack(documents(spark, [])).count() == 0


@given(st.dictionaries(st.integers(1, 32), st.integers(1, 50)))
@settings(max_examples=200, deadline=None)
def test_plan_gives_every_piece_its_own_room(histogram):
    room = defaultdict(list)
    for length, low, high, sequence, each, offset in packing.plan(histogram, 32):
        for rank in range(low, high):
            nth = rank - low
            room[sequence + nth // each].append((offset + nth % each * length, length))
    assert sum(map(len, room.values())) == sum(histogram.values())
    for places in room.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 32


@given(st.text(st.characters(max_codepoint=0x52F), max_size=80))
@settings(max_examples=500, deadline=None)
def test_both_encoders_agree(text):
    encode = packing.encoder(None, None)
    assert encode(text).tolist() == encode.slow.encode(text, add_special_tokens=False).ids


def test_special_text_and_contractions(slow):
    encode = packing.encoder(None, None)
    for text in ("a<|endoftext|>b", "don't we'll I'D 's ''s", "  x \n\n y\u0085z  ", "1½²", "漢字 🙂"):
        assert encode(text).tolist() == slow.encode(text, add_special_tokens=False).ids

import base64
import hashlib
import struct

import pytest
import zstandard

from faregate.llm import warc
from tests.llm.frames import CLASH

SCHEMA = "page_id bigint, url string, html string" + "".join(f", `{n}` string" for n in CLASH)


def pages(spark, rows):
    return spark.createDataFrame([(*r, *("x" for _ in CLASH)) for r in rows], SCHEMA)


ROWS = [
    (1, "http://a/1", "<p>same</p>"),
    (2, "http://a/2", "<p>same</p>"),
    (3, None, "<p>other é 🙂</p>"),
    (4, "http://a/4\r\nX: y", None),
    (5, "", ""),
    (6, "http://a/6", "<p>same</p>"),
    (6, "http://a/6", "<p>same</p>"),
    (None, "http://a/n", "<p>same</p>"),
    (None, "http://a/m", "<p>without an id</p>"),
    (7, "http://a/7", "long " * 400_000),
    (8, "http://a/8", "\r\n\r\nWARC/1.1\r\nP*M\x18"),
]


def expected(rows, least=0):
    largest = {}
    for page_id, _, html in rows:
        if page_id is not None:
            largest[html or ""] = max(largest.get(html or "", page_id), page_id)
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        first = largest.get(html or "")
        again = len(data) >= least and first is not None and first != page_id
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        name = lambda i: f"urn:x-page:{'' if i is None else i}"
        out.append((name(page_id), len(data), digest, "revisit" if again else "response", name(first) if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, out, least):
    warc.write_archives(pages(spark, ROWS), out, revisit_bytes=least)
    read = warc.read_archives(spark, out).collect()
    names = ("record_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert all(r["error"] is None for r in read)
    assert sorted((tuple(r[n] for n in names) for r in read), key=str) == expected(ROWS, least)
    payload = {r["record_id"]: bytes(r["payload"]) for r in read if r["record_type"] == "response"}
    assert payload["urn:x-page:7"] == ROWS[9][2].encode() and payload["urn:x-page:8"] == ROWS[10][2].encode()
    uri = {r["record_id"]: r["target_uri"] for r in read}
    assert uri["urn:x-page:3"] is None and uri["urn:x-page:4"] == "http://a/4%0D%0AX: y"


def test_empty_table(spark, out):
    warc.write_archives(pages(spark, []), out)
    assert warc.read_archives(spark, out).count() == 0


def test_dictionary_is_leading_and_used(spark, out):
    rows = [(i, f"http://a/{i}", f"<html><body class='page'><p>Page number {i}</p></body></html>" * 3) for i in range(600)]
    warc.write_archives(pages(spark, rows).coalesce(1), out)
    content = bytes(spark.read.format("binaryFile").load(out).first()["content"])
    magic, size = struct.unpack_from("<II", content)
    assert magic == warc.DICTIONARY_MAGIC
    plain = zstandard.ZstdDecompressor()
    at = 8 + size + 8  # the dictionary and the separator after it
    with pytest.raises(zstandard.ZstdError):  # no frame decodes without the dictionary
        plain.decompressobj().decompress(content[at:])
    assert warc.read_archives(spark, out).filter("error is null").count() == 600


def archive(*records, dictionary=None, squeeze=False):
    parts = []
    if dictionary is not None:
        data = dictionary.as_bytes()
        data = zstandard.ZstdCompressor().compress(data) if squeeze else data
        parts.append(struct.pack("<II", warc.DICTIONARY_MAGIC, len(data)) + data)
    packer = zstandard.ZstdCompressor(dict_data=dictionary)
    return b"".join([*parts, *(packer.compress(r) for r in records)])


GOOD = warc.record("urn:x-page:1", "http://a", b"<p>x</p>", None, "2020-01-01T00:00:00Z")


def errors(content):
    found = []
    for _, data in warc.decoded(content):
        try:
            if isinstance(data, ValueError):
                raise data
            warc.parsed(data)
            found.append(None)
        except ValueError as error:
            found.append(str(error))
    return found


def test_dictionary_may_be_compressed():
    samples = [GOOD.replace(b"<p>x</p>", b"<p>%06d</p>" % i) for i in range(2000)]
    trained = zstandard.train_dictionary(4096, samples)
    assert errors(archive(GOOD, GOOD, dictionary=trained, squeeze=True)) == [None, None]
    assert errors(archive(GOOD, dictionary=trained)) == [None]


def test_bad_records_are_reported_and_others_read():
    def broken(old, new):
        return GOOD.replace(old, new, 1)

    cases = [
        (broken(b"WARC/1.1", b"WARC/9.9"), "no WARC version line or header end"),
        (broken(b"WARC-Date: ", b"Other: "), "missing field warc-date"),
        (broken(b"WARC-Date: ", b"WARC-Type: x\r\nWARC-Date: "), "repeated field warc-type"),
        (broken(b"WARC-Date: ", b"no colon here\r\nWARC-Date: "), "malformed header line"),
        (GOOD + b"x", "content-length does not match the block"),
        (GOOD[:-1], "content-length does not match the block"),
        (broken(b"<p>x</p>", b"<p>y</p>"), "block digest does not match"),
        (broken(b"<urn:x-page:1>", b"urn"), "record id is not in angle brackets"),
    ]
    content = archive(*(c for c, _ in cases), GOOD)
    assert errors(content) == [*(e for _, e in cases), None]


def test_cut_off_archives():
    content = archive(GOOD, GOOD)
    assert errors(content[:-3]) == [None, "archive ends inside a frame"]
    assert errors(content + b"\x50") == [None, None, "archive ends inside a frame header"]
    assert errors(content + struct.pack("<II", 0x184D2A51, 9))[2] == "archive ends inside a skippable frame"
    assert errors(content + b"garbage that is no frame")[2].startswith("frame can't be decoded")

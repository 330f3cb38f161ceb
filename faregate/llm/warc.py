"""WARC archives compressed with Zstandard: one frame per record, a dictionary up front.

An archive starts with a skippable frame that holds a dictionary; every record
after it is one Zstandard frame. Writing goes through Spark's text writer: each
row is one frame, and the line separator between rows is an empty skippable
frame, which every decoder passes over. So archives are committed by Spark, on
any file system it can write, and a lost task leaves nothing behind. One task
writes one archive of about the size of its scan split, with a dictionary
trained on its own first records (none where they are too few to train on).

Reading takes whole archives as binary files, loads the dictionary, decodes one
frame at a time and validates it: version line, header syntax, required and
repeated fields, block length, trailing line ends, block and payload digests.
A record that fails is returned with its ``error``; after a frame that can't be
decoded the rest of that archive is given up, with one row that says so.

Equal payloads: the row with the largest id is written as a response, the
others as revisits that refer to it; the HTTP header of a revisit keeps the
payload's length. Payloads below ``revisit_bytes`` are always responses. A null
payload is empty. Rows with a null id never are what others refer to; if all ids
of a payload are null, all rows are responses. Rows that repeat the largest id
are all responses. A null address is left out; line ends in one are escaped.
An empty table gives no record. Further columns of the input are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faregate.operators.joins import broadcast_if_small
from faregate.operators.layout import written

# Of the two formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
EMPTY_FRAME = struct.pack("<II", SKIPPABLE[0], 0).decode("ascii")
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")

DICTIONARY_BYTES, SAMPLE_BYTES, LEVEL = 16_384, 1 << 20, 3
RECORDS = (
    "archive string, offset bigint, record_id string, record_type string, target_uri string, date string, "
    "payload_bytes bigint, payload_digest string, refers_to string, error string, payload binary"
)


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def record(name: str, uri: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """One record; a revisit's block ends with the HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode("ascii") + (payload if refers_to is None else b"")
    head = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": f"<{name}>", "WARC-Date": date}
    if uri is not None:
        head["WARC-Target-URI"] = uri.replace("\r", "%0D").replace("\n", "%0A")
    if refers_to is not None:
        head |= {"WARC-Refers-To": f"<{refers_to}>", "WARC-Profile": PROFILE}
    head |= {
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "WARC-Block-Digest": f"sha1:{digest(block)}",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def compressed(records: Iterator[bytes]) -> Iterator[bytes]:
    """The dictionary's frame, if one could be trained, then one frame per record."""
    samples, held = [], 0
    for item in records:
        samples.append(item)
        held += len(item)
        if held >= SAMPLE_BYTES:
            break
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=512, d=8)
        yield struct.pack("<II", DICTIONARY_MAGIC, len(trained.as_bytes())) + trained.as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few samples
        trained = None
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
    for group in (samples, records):
        for item in group:
            yield packer.compress(item)


def write_archives(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    revisit_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """One record per row into archives below ``path``, which must not exist."""
    body = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(f"`{page_id}`").alias("id"), F.col(f"`{url}`").alias("uri"), body.alias("payload"), F.sha1(body).alias("sha1")
    )
    same = (
        rows.filter(F.octet_length("payload") >= revisit_bytes)
        .groupBy("sha1")
        .agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 and first is not null")
        .select("sha1", "first")
    )
    rows = rows.join(broadcast_if_small(written(same)), "sha1", "left").select(
        F.col("id").cast("string"),
        "uri",
        "payload",
        F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")).cast("string").alias("refers_to"),
    )

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for i in range(batch.num_rows):
                    name, uri, data, other = (batch.column(k)[i].as_py() for k in range(4))
                    yield record(f"urn:x-page:{name or ''}", uri, data, other and f"urn:x-page:{other}", date)

        ready, held = [], 0
        for frame in compressed(records()):
            ready.append(frame)
            held += len(frame)
            if held >= 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(ready, pa.binary())], ["frame"])
                ready, held = [], 0
        if ready:
            yield pa.RecordBatch.from_arrays([pa.array(ready, pa.binary())], ["frame"])

    (
        rows.mapInArrow(frames, "frame binary")
        .select(F.col("frame").cast("string").alias("value"))
        .write.option("lineSep", EMPTY_FRAME)
        .option("compression", "none")
        .text(path)
    )


def decoded(content: bytes) -> Iterator[tuple[int, bytes | ValueError]]:
    """Offset and bytes of each record of an archive, or what ended the reading."""
    view, at, unpacker = memoryview(content), 0, zstandard.ZstdDecompressor()
    while at < len(view):
        if len(view) - at < 8:
            yield at, ValueError("archive ends inside a frame header")
            return
        magic, size = struct.unpack_from("<II", view, at)
        if magic in SKIPPABLE:
            end = at + 8 + size
            if end > len(view):
                yield at, ValueError("archive ends inside a skippable frame")
                return
            if magic == DICTIONARY_MAGIC and at == 0:
                data = bytes(view[8:end])
                if data[:4] == struct.pack("<I", FRAME_MAGIC):  # the dictionary may be compressed itself
                    data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
                unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data))
            at = end
            continue
        frame, start, parts = unpacker.decompressobj(), at, []
        try:
            while not frame.eof and at < len(view):
                step = view[at : at + (1 << 16)]
                parts.append(frame.decompress(step))
                at += len(step)
        except zstandard.ZstdError as error:
            yield start, ValueError(f"frame can't be decoded, archive given up: {error}")
            return
        if not frame.eof:
            yield start, ValueError("archive ends inside a frame")
            return
        at -= len(frame.unused_data)
        yield start, b"".join(parts)


FIELD = re.compile(r"([!#$%&'*+.^_`|~0-9A-Za-z-]+):[ \t]*(.*?)[ \t]*\Z", re.DOTALL)


def fields(lines: list[bytes]) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in lines:
        matched = FIELD.match(line.decode("utf-8"))
        if not matched:
            raise ValueError("malformed header line")
        name = matched[1].lower()
        if name in found:
            raise ValueError(f"repeated field {name}")
        found[name] = matched[2]
    return found


def parsed(data: bytes) -> dict:
    """The parts of a record, or ValueError saying what is wrong with it."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not mark or not re.fullmatch(rb"WARC/1\.[01]", version):
        raise ValueError("no WARC version line or header end")
    named = fields(lines)
    for name in REQUIRED:
        if not named.get(name):
            raise ValueError(f"missing field {name}")
    if not re.fullmatch(r"[0-9]+", named["content-length"]):
        raise ValueError("content-length is no number")
    length = int(named["content-length"])
    block = rest[:length]
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("content-length does not match the block")
    if not re.fullmatch(r"<\S+>", named["warc-record-id"]):
        raise ValueError("record id is not in angle brackets")
    said = named.get("warc-block-digest")
    if said is not None and said != f"sha1:{digest(block)}":
        raise ValueError("block digest does not match")
    payload, size = block, length
    kind = named["warc-type"]
    if named.get("content-type", "").replace(" ", "").startswith("application/http"):
        status, mark, payload = block.partition(b"\r\n\r\n")
        if not mark or not status.startswith(b"HTTP/"):
            raise ValueError("no HTTP header")
        size = len(payload)
        sent = fields(status.split(b"\r\n")[1:]).get("content-length")
        if sent is not None:
            if not re.fullmatch(r"[0-9]+", sent) or kind != "revisit" and int(sent) != size:
                raise ValueError("HTTP content-length does not match the payload")
            size = int(sent)
    said = named.get("warc-payload-digest")
    if said is not None and kind != "revisit" and said != f"sha1:{digest(payload)}":
        raise ValueError("payload digest does not match")
    other = named.get("warc-refers-to")
    if kind == "revisit" and not other:
        raise ValueError("revisit without what it refers to")
    return {
        "record_id": named["warc-record-id"][1:-1],
        "record_type": kind,
        "target_uri": named.get("warc-target-uri"),
        "date": named["warc-date"],
        "payload_bytes": size,
        "payload_digest": said.removeprefix("sha1:") if said else digest(payload),
        "refers_to": other[1:-1] if other else None,
        "payload": payload,
    }


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of all archives below ``path``; ``error`` says what is wrong with a bad one."""
    names = [part.split()[0] for part in RECORDS.split(", ")]
    schema = pa.schema(
        [(n, pa.binary() if n == "payload" else pa.int64() if n in ("offset", "payload_bytes") else pa.string()) for n in names]
    )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ready, held = [], 0
                name = batch.column(0)[i].as_py()
                for offset, data in decoded(batch.column(1)[i].as_py()):
                    row = {"archive": name, "offset": offset}
                    try:
                        if isinstance(data, ValueError):
                            raise data
                        row |= parsed(data)
                    except ValueError as error:
                        row["error"] = str(error)
                    if not with_payload:
                        row["payload"] = None
                    ready.append(row)
                    held += len(row.get("payload") or b"") + 500
                    if held >= 4 << 20:
                        yield pa.RecordBatch.from_pylist(ready, schema)
                        ready, held = [], 0
                if ready:
                    yield pa.RecordBatch.from_pylist(ready, schema)

    archives = spark.read.format("binaryFile").load(path).select("path", "content")
    return archives.mapInArrow(records, RECORDS)

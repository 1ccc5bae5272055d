"""Web archives (WARC 1.1) in Zstandard files, written from a table of pages and read back.

File: first a skippable frame (magic 0x184D2A5D) that holds the dictionary, then one frame per record.
The dictionary is trained on the first records of the file; where they are too few for training,
the file has no dictionary. Of equal payloads one record is the response, the others are revisits
that refer to it and carry only the header of the answer.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.llm.shared import make_folder, open_input, open_output, staged

# Formats of the two standards.
VERSION = b"WARC/1.1"
DICTIONARY_MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Record-ID", "WARC-Type", "WARC-Date", "Content-Length")

DATE = "2024-01-01T00:00:00Z"
RECORD_URN = "<urn:page:{}>"
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 256, 1 << 20, 16 << 10


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id, url: str | None, payload: bytes, first_id, revisit: bool, date: str = DATE) -> bytes:
    """One record with its closing blank lines."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    named = lambda x: RECORD_URN.format("none" if x is None else x)
    head = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": named(page_id), "WARC-Date": date}
    if url:
        head["WARC-Target-URI"] = quote(url, safe="%:/?#[]@!$&'()*+,;=~-._")
    if revisit:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": named(first_id)}
    head |= {"WARC-Payload-Digest": f"sha1:{digest(payload)}", "WARC-Block-Digest": f"sha1:{digest(block)}",
             "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Headers and payload of one record; raises ValueError where a header, length or digest is wrong."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] != VERSION:
        raise ValueError("not a WARC/1.1 record")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(":")
        if not colon or not re.fullmatch(r"[!#-'*+.0-9A-Z^-z|~-]+", name) or name in headers:
            raise ValueError(f"bad header line {line!r}")
        headers[name] = value.strip()
    if missing := [x for x in REQUIRED if x not in headers]:
        raise ValueError(f"header {missing[0]} is missing")
    kind = headers["WARC-Type"]
    if kind not in ("response", "revisit") or kind == "revisit" and "WARC-Refers-To" not in headers:
        raise ValueError(f"bad record type {kind}")
    if not re.fullmatch(r"\d+", headers["Content-Length"]) or len(rest) != int(headers["Content-Length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError("record length is wrong")
    block = rest[:-4]
    if headers.get("WARC-Block-Digest", f"sha1:{digest(block)}") != f"sha1:{digest(block)}":
        raise ValueError("block digest is wrong")
    answer, found, payload = block.partition(b"\r\n\r\n")
    size = re.search(rb"(?im)^content-length: (\d+)\r?$", answer)
    if not found or not answer.startswith(b"HTTP/") or not size:
        raise ValueError("block holds no answer")
    if kind == "response" and (len(payload) != int(size[1]) or headers.get("WARC-Payload-Digest") != f"sha1:{digest(payload)}"):
        raise ValueError("payload length or digest is wrong")
    if kind == "revisit" and payload:
        raise ValueError("revisit with a payload")
    return {
        "record_id": headers["WARC-Record-ID"], "record_type": kind, "target_uri": headers.get("WARC-Target-URI"),
        "date": headers["WARC-Date"], "refers_to_record": headers.get("WARC-Refers-To"),
        "payload_digest": headers["WARC-Payload-Digest"].removeprefix("sha1:"), "payload_bytes": int(size[1]),
        "payload": payload if kind == "response" else None,
    }


class Writer:
    """Writes records to one archive; the first ones wait until the dictionary is trained."""

    def __init__(self, sink):
        self.sink, self.waiting, self.bytes, self.packer = sink, [], 0, None

    def add(self, raw: bytes) -> None:
        if self.packer:
            self.sink.write(self.packer.compress(raw))
            return
        self.waiting.append(raw)
        self.bytes += len(raw)
        if len(self.waiting) >= SAMPLE_RECORDS or self.bytes >= SAMPLE_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.packer:
            return
        dictionary = None
        try:
            dictionary = zstandard.train_dictionary(
                DICTIONARY_BYTES, [x[: SAMPLE_BYTES // 8] for x in self.waiting], k=256, d=8)
        except zstandard.ZstdError:
            pass  # too few or too equal records: no dictionary frame
        if dictionary is not None:
            raw = dictionary.as_bytes()
            self.sink.write(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
        self.packer = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True)
        for raw in self.waiting:
            self.sink.write(self.packer.compress(raw))
        self.waiting = []


def frames(source, piece: int = 1 << 18) -> Iterator[bytes]:
    """Decoded frames of an archive; raises ValueError where a frame is broken or cut off."""
    data, dictionary = source.read(8), None
    if len(data) == 8 and struct.unpack("<II", data)[0] == DICTIONARY_MAGIC:
        size = struct.unpack("<II", data)[1]
        raw = source.read(size)
        if len(raw) != size:
            raise ValueError("dictionary is cut off")
        if raw[:4] == b"\x28\xb5\x2f\xfd":  # the dictionary itself may be a frame
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        dictionary, data = zstandard.ZstdCompressionDict(raw), b""
    decoder = zstandard.ZstdDecompressor(dict_data=dictionary)
    while data or (data := source.read(piece)):
        one, parts = decoder.decompressobj(), []
        try:
            while not one.eof:
                if not data and not (data := source.read(piece)):
                    raise ValueError("frame is cut off")
                parts.append(one.decompress(data))
                data = one.unused_data if one.eof else b""
        except zstandard.ZstdError as error:
            raise ValueError(f"broken frame: {error}") from error
        yield b"".join(parts)


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, date: str = DATE) -> DataFrame:
    """Write a record per page; returns the list of archives (path, records).

    Payload: the html in UTF-8, null is empty. Among payloads of at least `least_bytes` that are equal
    (SHA-1 and length), the row with the smallest page_id is the response; rows that repeat that id
    are responses too. A null id comes after all others and is the response only where no row of
    the group has an id. A null url has no target header. Other columns are ignored; no rows, no file.
    """
    make_folder(folder)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    keyed = rows.withColumn("sha", F.sha1(F.encode("html", "UTF-8"))).withColumn("bytes", F.octet_length("html"))
    firsts = keyed.groupBy("sha", "bytes").agg(F.min("page_id").alias("first_id"))
    # a payload that a third of all pages share is one key of this join: adaptive execution splits it
    records = keyed.join(firsts, ["sha", "bytes"]).select("page_id", "url", "html", "first_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, n, sink = f"{folder}/pages-{uuid.uuid4().hex}.warc.zst", 0, None
        for batch in batches:
            for page_id, url, html, first_id in zip(*(c.to_pylist() for c in batch.columns)):
                if sink is None:
                    sink = open_output(path)
                    writer = Writer(sink)
                payload = html.encode()
                writer.add(record(page_id, url, payload, first_id, len(payload) >= least_bytes and page_id != first_id, date))
                n += 1
        if sink is not None:
            writer.flush()
            sink.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [n]})

    return staged(records.mapInArrow(run, "path string, records long"), "archives")


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the listed archives; an invalid one ends the job with an error."""
    names = ["record_id", "record_type", "target_uri", "date", "refers_to_record", "payload_digest", "payload_bytes"] + ["payload"] * payloads
    types = [pa.string()] * 6 + [pa.int64()] + [pa.binary()] * payloads
    schema = ", ".join(f"{n} {'long' if n == 'payload_bytes' else 'binary' if n == 'payload' else 'string'}" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, expected in zip(*(c.to_pylist() for c in batch.columns)):
                rows, size, n = [], 0, 0
                with open_input(path) as source:
                    for raw in frames(source):
                        parsed = parse(raw)
                        rows.append([parsed[x] for x in names])
                        n, size = n + 1, size + len(raw) * payloads
                        if len(rows) >= 5000 or size >= 1 << 23:
                            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)
                            rows, size = [], 0
                if n != expected:
                    raise ValueError(f"{path} has {n} records, {expected} were written")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

    # a task for every few archives, whatever the size of the small list
    spread = archives.select("path", "records").repartition(int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")
    return spread.mapInArrow(run, schema)


def page_records(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of records written from pages."""
    number = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1).try_cast("long")
    return records.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          number("refers_to_record").alias("refers_to"))

"""Archives against a plain grouping of the pages, and broken files."""

import base64
import hashlib
import io
from collections import defaultdict

import pytest

from opsloom.llm import archives as ar
from opsloom.llm.shared import shared_folder


def plain(rows):
    groups = defaultdict(list)
    for page_id, _, html in rows:
        groups[html or ""].append(page_id)
    for page_id, _, html in rows:
        ids = [x for x in groups[html or ""] if x is not None]
        first, raw = min(ids, default=None), (html or "").encode()
        kind = "response" if page_id == first else "revisit"
        yield page_id, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), kind, None if kind == "response" else first


ROWS = [
    [(3, "http://a/ b\n", "<p>é</p>"), (1, None, "<p>é</p>"), (2, "u", None), (4, "", ""), (None, "u", ""), (5, "x", "y" * 300_000)],
    [(None, "u", "same"), (None, "u", "same"), (7, "u", "other"), (7, "u", "other"), (8, "v", "other")], [],
    [(k, f"http://h/{k}", f"<html>page {k % 40} {'words of a page ' * (k % 13)}</html>") for k in range(400)],
]


@pytest.mark.parametrize("rows", ROWS)
def test_records_come_back(spark, rows):
    pages = spark.createDataFrame([(*r, 1, "s") for r in rows], "page_id long, url string, html string, bytes int, sha string")
    listed = ar.write_archives(pages, shared_folder(spark, "warc"))
    records = ar.read_archives(listed)
    assert sorted(map(str, (tuple(r) for r in ar.page_records(records).collect()))) == sorted(map(str, plain(rows)))
    sent = {(r.payload or b"").decode() for r in records.collect() if r.record_type == "response"}
    assert sent == {h or "" for _, _, h in rows}


def archive(n=300):
    sink = io.BytesIO()
    writer = ar.Writer(sink)
    for k in range(n):
        writer.add(ar.record(k, "u", f"<p>payload {k} of a page with some words {k * 7}</p>".encode() * 5, k, False))
    writer.flush()
    return sink.getvalue()


def test_dictionary_frame_leads():
    raw = archive()
    assert int.from_bytes(raw[:4], "little") == 0x184D2A5D
    assert [ar.parse(f)["record_id"] for f in ar.frames(io.BytesIO(raw), 1000)] == [f"<urn:page:{k}>" for k in range(300)]
    assert len(list(ar.frames(io.BytesIO(archive(2))))) == 2  # too few to train


@pytest.mark.parametrize("cut", [3, 200, -1])
def test_broken_files_are_refused(cut):
    with pytest.raises(ValueError):
        list(ar.frames(io.BytesIO(archive()[:cut])))


@pytest.mark.parametrize("change", [
    (b"WARC/1.1", b"WARC/0.9"), (b"Content-Length: 5", b"Content-Length: 6"), (b"WARC-Date", b"WARC-Day"), (b"hello", b"hullo"),
    (b"WARC-Type: response", b"WARC-Type: revisit"), (b"sha1:", b"sha1:A"),
])
def test_invalid_records_are_refused(change):
    good = ar.record(1, "u", b"hello", 1, False)
    assert ar.parse(good)["payload"] == b"hello"
    with pytest.raises(ValueError):
        ar.parse(good.replace(*change))

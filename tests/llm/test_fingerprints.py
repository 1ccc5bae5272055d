"""Fingerprints against string comparison, and the neighbour query against a plain loop."""

import hashlib

import pytest

from opsloom.llm import fingerprints as fp

TEXTS = {9: "abc" * 40, 7: "", 5: None, 4: "x", 3: "héllo wörld " * 30, 2: "héllo wörld " * 30, -1: "€𝄞" * 500 + "z" * 3000}


def plain(rows):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    for k, (doc_id, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        yield doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), fp._marked(text)[2], fp._marked(edited)[2]


@pytest.mark.parametrize("rows", [
    list(TEXTS.items()), [(1, "alone here")], [], [(None, "a"), (None, "b"), (3, "c"), (3, "c"), (3, None)],
    [(k, f"text {k} " * (k % 7)) for k in range(300)],
])
def test_query_equals_plain_loop(spark, rows):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, bucket string, place int")
    got = fp.fingerprint_neighbours(docs).collect()
    assert sorted(map(str, ((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in got))) \
        == sorted(map(str, plain(rows)))
    assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))


def test_spans_and_extensions():
    a, b = fp.PrefixArrays("the cat sat on the mat"), fp.PrefixArrays("a cat sat on a mat")
    assert a.span(4, 11) == b.span(2, 9) and a.span(4, 15) == b.span(2, 13) and a.span(0, 3) == a.span(15, 18)
    assert fp.longest_extension(a, 3, b, 1) == len(" cat sat on ")
    assert fp.longest_extension(a, 0, b, 0) == 0


def test_likeness():
    one, same, other = (fp._marked(t)[2] for t in ("abcdefgh" * 9 + "tail", "abcdefgh" * 9 + "tail", "zyxw" * 30))
    assert one == same and fp.read_likeness(one, same) == 1 and fp.read_likeness(one, other) == 0
    base = " ".join(str(k * 7919 % 10007) for k in range(2000))
    half = base[: len(base) // 2] + " ".join(str(k * 104729 % 99991) for k in range(2000))[: len(base) // 2]
    assert 0.3 < fp.read_likeness(fp._marked(base)[2], fp._marked(half)[2]) < 0.7

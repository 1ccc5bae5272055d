"""Removed bytes against a count of all 400-byte strings; the merge against sorted()."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from opsloom.llm import substrings as sb


def plain(rows):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(r[k : k + 400] for r in raws for k in range(len(r) - 399))
    for (doc_id, _), raw in zip(rows, raws):
        gone = np.zeros(len(raw) + 1, bool)
        for k in range(len(raw) - 399):
            if seen[raw[k : k + 400]] > 1:
                gone[k : k + 400] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        yield doc_id, len(raw), int(gone.sum()), int(np.diff(np.concatenate([[False], gone]).astype(int)).clip(0).sum()), hashlib.sha256(kept).hexdigest()


def tables():
    rng = random.Random(6)
    word = lambda: rng.choice(["ta", "é", "ronk", "mi", "of", "the", "ß"]) + str(rng.randrange(90))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared, long = prose(90), prose(400)
    rows = [(k, prose(rng.randrange(5, 250))) for k in range(12)]
    rows += [(100 + k, prose(rng.randrange(40)) + shared + prose(rng.randrange(60))) for k in range(8)]
    rows += [(200, long), (201, long), (202, long[:900] + "X" + long[901:]), (203, long[37:1200] + prose(30)), (204, shared[:399]), (205, shared[:400]), (206, shared[1:402])]
    rows += [(300, "a" * 399), (301, "b" * 400), (302, "c" * 401), (303, "Le " * 500), (304, "xy" * 300 + prose(50)), (305, "Le " * 400 + "z")]
    cut = [(400 + k, long[k * 13 : k * 13 + 420 + 3 * k]) for k in range(20)]
    edges = [(1, None), (2, ""), (3, "short"), (None, shared), (None, shared), (None, None), (7, "é" * 250), (7, "é" * 250)]
    return [rows, cut, edges, [(1, long)], []]


@pytest.mark.parametrize("k", range(5))
@pytest.mark.parametrize("at_once", [sb.SORTED_AT_ONCE, 50])
def test_same_bytes_as_counting_all_strings(spark, k, at_once, monkeypatch):
    rows = tables()[k]
    if at_once == 50:
        texts = [(t or "").encode() for _, t in rows if len((t or "").encode()) >= 400]
        together = sb.repeated_windows(texts, [False] * len(texts))
        monkeypatch.setattr(sb, "SORTED_AT_ONCE", 50)
        assert all(np.array_equal(a, b) for a, b in zip(together, sb.repeated_windows(texts, [False] * len(texts))))
        return
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, name int, place int")
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sb.repeated_bytes(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain(rows)))


def test_hot_names_are_not_gathered(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(sb, "HOT", 4, raising=False)
    monkeypatch.setattr(sb, "MERGED_AT_ONCE", 3, raising=False)
    real = sb._runs

    def watched(n):
        inner, folder = real(n), str(tmp_path)

        def run(batches):
            for batch in batches:
                for wanted in batch.column(0).to_pylist():
                    for s in wanted:
                        open(f"{folder}/{s['name']}_{s['digest']}", "w").close()
                yield from inner(iter([batch]))

        return run

    monkeypatch.setattr(sb, "_runs", watched)
    rng = random.Random(9)
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = prose(700)
    rows = [(k, prose(rng.randrange(300, 400)) + passage + prose(rng.randrange(300, 400))) for k in range(60)] + tables()[0]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sb.repeated_bytes(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain(rows)))
    gathered = Counter(p.name.split("_")[0] for p in tmp_path.iterdir())
    assert gathered and max(gathered.values()) <= 4, gathered.most_common(2)  # before: all segments of the passage's ends


def test_hot_segments_are_compared_by_parts(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(sb, "HOT", 4)
    folder = str(tmp_path)

    def counting(real):
        def run(batches):
            for batch in real(batches):
                open(f"{folder}/{batch.num_rows}_{random.random()}", "w").close()
                yield batch

        return run

    for step in ("_hot_parts", "_hot_windows"):
        if hasattr(sb, step):
            monkeypatch.setattr(sb, step, counting(getattr(sb, step)))
    rng = random.Random(12)
    base = "".join(rng.choice("abcdefgh ") for _ in range(1300))
    rows = []
    for k in range(80):  # one or two other letters each, some ends missing
        text = list(base)
        for at in rng.sample(range(1300), 1 + k % 2):
            text[at] = "XY"[k % 2]
        rows.append((k, "".join(text)[(k % 5) * 11 : 1300 - (k % 7) * 9]))
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sb.repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain(rows)))
    kinds = {}
    for _, text in rows:
        for start, end, name, digest in zip(*sb.segments(np.frombuffer(text.encode(), np.uint8))):
            kinds.setdefault(name, {})[digest] = end - start
    windows = sum(sum(of.values()) for of in kinds.values() if len(of) > 4)
    made = sum(int(p.name.split("_")[0]) for p in tmp_path.iterdir())
    assert 0 < made < windows / 2, (made, windows)  # before: every window start of every hot segment


def test_equal_windows_are_in_parts_with_equal_cores():
    rng = random.Random(3)
    prose = lambda n: bytes(rng.choice(b"abcd") for _ in range(n))
    shared = prose(800)
    cores = [{}, {}]
    for k in range(2):
        text = prose(150 * k) + shared + prose(90)
        for start, end, *_ in zip(*sb.segments(np.frombuffer(text, np.uint8))):
            data, seen = text[start : end + 399], []
            for low, high, core, part in sb.parts(data):
                assert len(part) == high - low + 400
                for at in range(low, high + 1):
                    cores[k][data[at : at + 400]] = core
                    assert core in data[at : at + 400]
                    seen.append(at)
            assert sorted(seen) == list(range(end - start))
    both = cores[0].keys() & cores[1].keys()
    assert len(both) >= 401 and all(cores[0][w] == cores[1][w] for w in both)


def test_merge_of_front_coded_runs():
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 40))) for _ in range(700)] + [b"a" * 100] * 5
    for n in (1, 2, 3, 7, 16):
        runs = [sorted({t: b"123456789" for t in texts[k::n]}.items()) for k in range(n)]
        merged = list(sb.merge([sb.read_run(sb.pack_run(r)) for r in runs]))
        assert [m[1] for m in merged] == sorted(t for r in runs for t, _ in r)
        for before, after in zip(merged, merged[1:]):
            assert after[0] == sb.shared_prefix(before[1], after[1])
    assert list(sb.merge([])) == []


def test_equal_windows_have_equal_names():
    rng = np.random.default_rng(1)
    shared = rng.integers(97, 123, 900, dtype=np.uint8)
    names = []
    for lead in (0, 333):
        data = np.concatenate([rng.integers(97, 123, lead, dtype=np.uint8), shared, rng.integers(97, 123, 50, dtype=np.uint8)])
        start, end, name, _ = sb.segments(data)
        assert (end - start).max() <= sb.REACH and end[-1] == len(data) - 399
        names.append(np.repeat(name, end - start)[lead : lead + 501])
    assert np.array_equal(*names)


def test_many_equal_rows_without_id(spark):
    import random

    rng = random.Random(11)
    text = "".join(rng.choice("abcdefgh ") for _ in range(5000))
    docs = spark.createDataFrame([(None, text)] * 600 + [(1, text[:2000] + "x" * 50), (2, "short")], "doc_id long, text string")
    got = sorted((r.n_bytes, r.n_removed, r.n_spans) for r in sb.repeated_bytes(docs).collect())
    assert got == [(5, 0, 0), (2050, 2000, 1)] + [(5000, 5000, 1)] * 600

"""Leaks against the edit distance of every window, and the recall of the sampling."""

import random

import numpy as np

from opsloom.llm import decontamination as dc

SF = "/root/testdata/sf0.001"


def distance_to_best_run(item, text):
    before = [0] * (len(text) + 1)
    for k, word in enumerate(item):
        row = [k + 1]
        for j, other in enumerate(text):
            row.append(min(before[j] + (word != other), before[j + 1] + 1, row[j] + 1))
        before = row
    return min(before)


def edited(rng, item, edits):
    out = list(item)
    for _ in range(edits):
        kind, at = rng.randrange(3), rng.randrange(len(out))
        if kind == 0:
            out[at] = f"new{rng.randrange(10**6)}"
        elif kind == 1:
            out.insert(at, f"more{rng.randrange(10**6)}")
        elif len(out) > 4:
            del out[at]
    return out


def test_same_pairs_as_all_windows(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id): r.distance for r in dc.leaks(docs, items).collect()}
    split = lambda t: (t or "").lower().split()
    known = [(r.item_id, split(r.text)) for r in items.collect()]
    expected = {}
    for r in docs.collect():
        text = split(r.text)
        for item_id, item in known:
            if len(item) >= 5 and len(set(item) & set(text)) >= len(set(item)) - len(item) // 5:
                d = distance_to_best_run(item, text)
                if d <= len(item) // 5:
                    expected[r.doc_id, item_id] = d
    assert expected and got == expected


def test_recall_at_the_threshold():
    rng, found, n = random.Random(9), 0, 0
    items = [[f"w{rng.randrange(3000)}" for _ in range(rng.choice([10, 25, 40, 80]))] for _ in range(30)]
    index = dc.build_index(list(range(30)), [" ".join(i) for i in items])
    for k, item in enumerate(items):
        for _ in range(8):
            copy = edited(rng, item, len(item) // 5)
            text = [f"c{rng.randrange(500)}" for _ in range(50)] + copy + [f"c{rng.randrange(500)}" for _ in range(50)]
            raw = " ".join(text).encode()
            _, _, hashes, first = dc.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), lower=True)
            hits = dc.search(index, [(0, hashes, first)])
            n += 1
            found += any(h[1] == k for h in hits)
            assert all(h[2] == distance_to_best_run(items[h[1]], text) for h in hits)
    assert found / n >= 0.95


def test_edges_and_filter(spark):
    item = "Alpha beta gamma delta epsilon zeta eta theta iota kappa"
    items = spark.createDataFrame([(1, item), (1, item), (None, item), (2, "too short"), (3, None), (4, "")], "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "x " + item.upper() + " y", 1), (2, None, 2), (3, "", 3), (None, item, 4), (5, "alpha beta gamma delta epsilon", 5),
        (6, "q " * 30_000 + item, 6), (7, item, 7), (7, item, 7)], "doc_id long, text string, item_id int")
    got = dc.leaks(docs, items).collect()
    assert len(got) == 15 and {r.doc_id for r in got} == {1, None, 6, 7} and all(r.distance == 0 and r.n_words == 10 for r in got)
    assert {r.end_word for r in got if r.doc_id == 6} == {30_010}
    small = dc.leaks(docs, items, block=2).collect()
    assert sorted(map(str, small)) == sorted(map(str, got))
    kept = dc.without_leaks(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 5]
    assert dc.leaks(docs, items.limit(0)).count() == 0 and dc.without_leaks(docs.limit(0), items).count() == 0


def test_short_items_match_unchanged(spark):
    items = spark.createDataFrame([(-1, "One"), (2, "one two"), (3, "two three four"), (4, "a b c d"), (None, "five"), (6, " .\t"), (7, "")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "zero ONE two"), (2, "one three two three four"), (3, "a b c x d"), (4, "five a b c d"), (5, "ones"), (6, "one")], "doc_id long, text string")
    expected = {}
    for r in docs.collect():
        for i in items.collect():
            text, item = r.text.lower().split(), i.text.lower().split()
            ends = [k + len(item) for k in range(len(text)) if item and text[k : k + len(item)] == item]
            if ends:
                expected[r.doc_id, i.item_id] = (0, len(item), ends[0])
    for block in (1, 3, 4000):
        got = dc.leaks(docs, items, block=block).collect()
        assert len(got) == len(expected) and {(r.doc_id, r.item_id): (r.distance, r.n_words, r.end_word) for r in got} == expected
    assert {(1, -1), (4, None), (2, 3)} <= expected.keys() and not any(5 in k or 3 == k[0] for k in expected)


def test_blocks_are_full_and_of_bounded_size(spark):
    items = spark.range(0, 1000, 1, 7).selectExpr("id AS item_id", "concat('word', id) AS text")
    sizes = dc.numbered(items, 64).groupBy("block").count().collect()
    assert len(sizes) == 16 and sorted(r["count"] for r in sizes)[1:] == [64] * 15

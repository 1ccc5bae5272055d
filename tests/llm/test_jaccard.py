"""Components against all pairs of documents."""

import random
import re

import pytest

from opsloom.llm import jaccard as jc
from opsloom.llm.graph import components


def shingles(text):
    found = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(found[k : k + 3]) for k in range(len(found) - 2)} or ({tuple(found)} if found else set())


def plain(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    for k, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(k) and rows[j][0] is not None]
        yield doc_id, len(sets[k]), min(ids, default=None)


def near_copies(rng, n, words, most, first=0):
    base = [f"w{rng.randrange(900)}" for _ in range(words)]
    for k in range(n):
        copy = list(base)
        for _ in range(rng.randrange(most + 1)):
            copy[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        yield first + k, " ".join(copy)


def tables():
    rng = random.Random(3)
    mixed = [(1000 + k, " ".join(f"t{rng.randrange(400)}" for _ in range(rng.randrange(60)))) for k in range(60)]
    mixed += list(near_copies(rng, 40, 300, 6)) + list(near_copies(rng, 30, 120, 3, 100)) + [(500, "A b C"), (501, "a B c"), (502, "a b"), (503, "A\tb\n")]
    return [mixed, [], [(1, None), (2, ""), (3, " \n"), (3, " \n"), (4, "one"), (None, "ONE"), (None, None)],
            [(None, "p q r s")] * 3 + [(9, "p q r s"), (9, "p q r s"), (8, "p\x0bq r\rs")]]


@pytest.mark.parametrize("k", range(4))
def test_components_equal_all_pairs(spark, k):
    rows = tables()[k]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, class string, part int")
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jc.shingle_components(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain(rows)))
    kept = jc.one_per_component(docs)
    assert kept.columns == docs.columns
    groups = {(c, None if n else k) for k, (_, n, c) in enumerate(plain(rows))}
    assert kept.count() == len(groups)


def test_clusters_of_many_parts(spark, monkeypatch):
    monkeypatch.setattr(jc, "PART", 12)
    monkeypatch.setattr(jc, "PIVOTS", 2)
    rows = list(near_copies(random.Random(8), 120, 200, 9))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = sorted(map(str, plain(rows)))
    assert len({r.split(", ")[2] for r in expected}) > 5  # outliers and a large component
    assert sorted(map(str, ((r.doc_id, r.n_shingles, r.component_id) for r in jc.shingle_components(docs).collect()))) == expected


def test_open_classes_stay_in_bounded_groups(spark, monkeypatch):
    monkeypatch.setattr(jc, "PART", 12)
    monkeypatch.setattr(jc, "PIVOTS", 2)
    monkeypatch.setattr(jc, "BLOCK", 1, raising=False)
    rng = random.Random(5)
    template = [f"w{k}" for k in range(150)]
    # one cluster: a shared passage at about 0.6 that links nothing, and linked pairs here and there
    rows = [(k, " ".join(template + [f"u{k}_{x}" for x in range(50)])) for k in range(150)]
    rows += [(1000 + k, rows[k][1] + f" v{k}") for k in rng.sample(range(150), 40)]
    held, dealt = [], jc._dealt

    def watched(parts, *rest):
        held.append(max(r["count"] for r in parts.select("cluster", "part", "class").distinct().groupBy("cluster", "part").count().collect()))
        return dealt(parts, *rest)

    monkeypatch.setattr(jc, "_dealt", watched)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(str, ((r.doc_id, r.n_shingles, r.component_id) for r in jc.shingle_components(docs, 90).collect())))
    assert got == sorted(map(str, plain(rows)))
    assert max(held) < 60, held  # before: a part held each of the 190 open classes


def test_long_chains(spark):
    chain = spark.createDataFrame([(f"{k * 7919 % 211:03d}", f"{(k + 1) * 7919 % 211:03d}") for k in range(200)] + [("x", "y")], "a string, b string")
    roots = components(chain).collect()
    assert len(roots) == 203 and len({r.root for r in roots}) == 2
    assert components(chain.limit(0)) is None

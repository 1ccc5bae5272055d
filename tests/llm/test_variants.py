"""Spelling variants against all single edits of every word."""
import random
import re
import zlib
from collections import Counter

import numpy as np

from opsloom.llm import variants


def _words(rows):
    out = Counter()
    for doc_id, text in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def _expected(rows):
    words, out = _words(rows), {}
    alphabet = sorted({c for w in words for c in w})
    for w, n in words.items():
        near = {w[:k] + w[k + 1:] for k in range(len(w))}
        near |= {w[:k] + c + w[k + 1:] for k in range(len(w)) for c in alphabet}
        near |= {w[:k] + c + w[k:] for k in range(len(w) + 1) for c in alphabet}
        near = (near & words.keys()) - {w}
        top = min(near, key=lambda x: (-words[x], x), default=None)
        form = top if top and words[top] >= 10 * n else None
        out[w] = (form, n, len(near), words[form] if form else None)
    roots = {}
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        roots[w] = root
    return {w: (form, roots[w], *rest) for w, (form, *rest) in out.items()}


def _found(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def _frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def _varied(seed, n):
    """Texts over few stems with edits, so that forms chain over several steps."""
    rng, rows = random.Random(seed), []
    stems = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(6, 11))) for _ in range(25)]
    for k in range(n):
        text = []
        for _ in range(60):
            w = stems[min(int(rng.expovariate(0.3)), 24)]
            while rng.random() < 0.15:
                i = rng.randrange(len(w))
                w = rng.choice((w[:i] + w[i + 1:], w[:i] + rng.choice("abcdeéÀ") + w[i:], w[:i] + rng.choice("abÿ×") + w[i + 1:]))
            text.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((k, rng.choice([" ", ", ", "\n", "1"]).join(text)))
    return rows


def test_made_texts_against_all_edits(spark):
    rows = _varied(3, 250)
    expected = _expected(rows)
    assert any(form and root != form for form, root, *_ in expected.values())
    result = variants.variant_groups(_frame(spark, rows))
    assert result.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert _found(result) == expected


def test_sample_against_all_edits(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert _found(variants.variant_groups(docs)) == _expected([tuple(r) for r in docs.collect()])


def test_many_small_boxes_and_split_boxes(spark, monkeypatch):
    monkeypatch.setattr(variants, "BOX_WORDS", 40)
    rows = _varied(4, 200)
    assert _found(variants.variant_groups(_frame(spark, rows))) == _expected(rows)
    # anagrams: no plane divides them, the box is split by hash
    rng = random.Random(1)
    grams = {"".join(rng.sample("aabbccdd", 8)) for _ in range(900)} | {"".join(rng.sample("aabbccde", 8)) for _ in range(300)}
    rows = [(k, " ".join(grams)) for k in range(3)]
    assert _found(variants.variant_groups(_frame(spark, rows))) == _expected(rows)


def test_special_rows(spark):
    rows = [(None, "Schreiben schreiben schreibenn schreibenn"), (1, None), (1, ""), (2, "wordword"), (2, "wordword"), (3, "y" * 3_000_000 + " wordword"),
            (3, "y" * 3_000_000 + " ÀÉÎÕÜÿþ ÀÉÎÕÜÿþ")]
    frame = _frame(spark, rows).selectExpr("*", "'x' AS word", "1 AS n", "2 AS length")
    found = _found(variants.variant_groups(frame))
    expected = _words(rows)
    assert {w: v[2] for w, v in found.items()} == expected
    assert {w: v[3] for w, v in found.items() if len(w) < 100} == {w: v[3] for w, v in _expected([(d, (t or "").replace("y" * 3_000_000, "")) for d, t in rows]).items()}
    assert variants.variant_groups(_frame(spark, [])).collect() == []


def test_tree_finds_every_neighbour():
    rng = random.Random(7)
    words = sorted({"".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(3000)})
    data = [w.encode() for w in words]
    tree = variants.KdTree(variants.letter_counts(variants.letters(data, 7)), 12, tight=True, most=31)
    counts = variants.letter_counts(variants.letters(data, 7)).astype(int)
    query, point = tree.points_near(tree.points[np.argsort(tree.order)][:200], 2)
    near = {(q, p) for q, p in zip(query.tolist(), point.tolist())}
    assert near >= {(q, p) for q in range(200) for p in np.flatnonzero(np.abs(counts[q] - counts).sum(1) <= 2).tolist()}
    assert len(near) < 0.2 * 200 * len(words)

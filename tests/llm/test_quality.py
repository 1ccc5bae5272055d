"""Held-out accuracy, gradients and edge rows of the quality model."""

import zlib

import numpy as np

from opsloom.llm import quality as ql
from opsloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def features(text):
    raw = text.encode()
    return ql.passages(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))


def test_held_out_accuracy(spark):
    scored = {r.doc_id: r for r in QUERIES["op10_quality_scores"](spark, SF).collect()}
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    assert len(scored) == docs.count()
    for r in scored.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    test = [(scored[r.doc_id], r.quality) for r in labels.collect() if scored[r.doc_id].held_out]
    assert np.mean([s.predicted == q for s, q in test]) > 0.95
    good, bad = ([s.score for s, q in test if q == v] for v in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97


def test_gradient_lowers_loss_and_one_class_is_constant():
    bags = [features("good words stand here and there " * 30)[0], features("x!! y!! z!! " * 90)[0]] * 20
    labels = np.array([1.0, 0.0] * 20)
    model = ql.fit(bags, labels, epochs=20)
    assert model.score(bags[0], np.array([0, len(bags[0])]))[0] > 0.9 > 0.1 > model.score(bags[1], np.array([0, len(bags[1])]))[0]
    assert abs(ql.fit(bags[:2], np.ones(2)).score(bags[1], np.array([0, 1]))[0] - 0.75) < 1e-9
    assert ql.fit([], np.zeros(0)).score(bags[1], np.array([0, 1]))[0] == 0.5


def test_passages_of_rows_do_not_mix():
    texts = ["", "one two", "  lead " + "word " * 200, "é ñ", "\n"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    together, starts = ql.passages(np.frombuffer(b"".join(raw), np.uint8), offsets)
    assert np.diff(starts).tolist() == [1, 1, 4, 1, 1]
    for k, t in enumerate(texts):
        assert np.allclose(together[starts[k] : starts[k + 1]], features(t)[0])


def test_nulls_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, None, 9), (None, "a b", 9), (2, "", 9), (2, "", 9)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, None, 0)], "doc_id long, quality int, text int")
    got = ql.score(docs, ql.train(docs, labels)).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "2", "2", "None"] and {r.score for r in got} == {0.5}
    assert ql.score(docs.limit(0), ql.train(docs.limit(0), labels)).count() == 0


def _plain_score(model, text):
    """Gated attention in plain loops over the passages of one text."""
    x = np.clip((features(text)[0] - model.centre) / model.scale, -8, 8)
    w, raw, hidden = model.weights, [], []
    for row in x:
        h = np.tanh(row @ w["encode"] + w["encode0"])
        hidden.append(h)
        raw.append(float((np.tanh(h @ w["tanh"]) / (1 + np.exp(-(h @ w["gate"])))) @ w["attend"]))
    share = np.exp(np.array(raw) - max(raw))
    pooled = sum(s * h for s, h in zip(share / share.sum(), hidden))
    return 1 / (1 + np.exp(-(pooled @ w["out"] + w["out0"])))


def test_scores_against_plain_loops(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    model = ql.train(docs, labels)
    texts = {r.doc_id: r.text or "" for r in docs.collect()} | {-1: "good words " * 60_000, -2: "!" * 5000, -3: "good words " * 60_000}
    frame = spark.createDataFrame([(k, t) for k, t in texts.items()], "doc_id long, text string")
    found = {r.doc_id: r.score for r in ql.score(frame, model).collect()}
    assert all(abs(found[k] - _plain_score(model, t)) < 1e-4 for k, t in texts.items()) and found[-1] == found[-3]


def test_contradicting_and_repeated_labels(spark):
    docs = spark.createDataFrame([(k, f"text {k} " * 100) for k in range(40)] * 2 + [(None, "x")], "doc_id long, text string")
    rows = [(k, k % 2) for k in range(40)]
    model = ql.train(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
    again = ql.train(docs, spark.createDataFrame(rows * 3 + [(None, 1), (5, None), (6, 7)], "doc_id long, quality int"))
    assert all(np.array_equal(model.weights[k], again.weights[k]) for k in model.weights)
    less = ql.train(docs, spark.createDataFrame(rows + [(k, 1 - k % 2) for k in range(20)], "doc_id long, quality int"))
    only = ql.train(docs, spark.createDataFrame(rows[20:], "doc_id long, quality int"))
    assert all(np.array_equal(less.weights[k], only.weights[k]) for k in less.weights)

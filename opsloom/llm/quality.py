"""Document quality by attention over passages (multiple-instance learning).

A document is a bag of passages of 64 words. Every passage is described by byte and word statistics,
encoded by one hidden layer, weighted by gated attention (tanh times sigmoid), and the weighted sum of
the encodings gives the score. Only documents carry labels; the attention learns which passages
decide. The model is fitted with numpy on a sample of labelled documents whose number and size are bounded
(`most_documents`, `most_bytes`; chosen by a hash of the id); every document is fitted and scored with all its passages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opsloom.llm.arrays import slices, words

PASSAGE = 64
HIDDEN, GATE = 32, 16

# byte classes: each small letter and ASCII mark on its own, the rest by kind
_FINE = np.zeros(256, np.int64)
_FINE[:32], _FINE[32], _FINE[10], _FINE[48:58], _FINE[65:91], _FINE[127], _FINE[128:192], _FINE[192:] = 0, 1, 2, 3, 4, 0, 5, 6
_next = 7
for _k in list(range(97, 123)) + [c for c in range(33, 127) if not chr(c).isalnum()]:
    _FINE[_k] = _next
    _next += 1
FINE = _next
# kinds for pairs of neighbours: control, blank, line feed, digit, capital, small, mark, other letters
_KIND = np.full(256, 6)
_KIND[:32], _KIND[32], _KIND[10], _KIND[48:58], _KIND[65:91], _KIND[97:123], _KIND[128:] = 0, 1, 2, 3, 4, 5, 7
PAIRS = 64
STATS = 7
FEATURES = FINE + PAIRS + STATS


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of some rows, and the first passage of each row (rows + 1 numbers).

    A row without words is one empty passage.
    """
    begin, end, hashes, first = words(data, offsets)
    counts = np.diff(first)
    per_row = np.maximum(1, -(-counts // PASSAGE))
    starts = np.concatenate([[0], np.cumsum(per_row)])
    n = int(starts[-1])
    row = np.repeat(np.arange(len(counts)), counts)
    own = starts[row] + (np.arange(len(begin)) - first[row]) // PASSAGE
    out = np.zeros((n, FEATURES), np.float32)
    if not len(begin):
        return out, starts
    # a passage's bytes go from its first word to the next passage; bytes before the first word are left out
    heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    edge = np.concatenate([begin[heads], [len(data)]])
    stop = np.minimum(edge[1:], offsets[1:][row[heads]])
    keep = np.zeros(len(data) + 1, np.int64)
    np.add.at(keep, edge[:-1], 1)
    np.add.at(keep, stop, -1)
    where = np.flatnonzero(np.cumsum(keep[:-1]))
    passage = np.repeat(own[heads], stop - edge[:-1])
    size = np.bincount(passage, minlength=n).astype(np.float32)[:, None]
    byte = data[where]
    fine = np.bincount(passage * FINE + _FINE[byte], minlength=n * FINE).reshape(n, FINE)
    kind = _KIND[byte]
    same = passage[1:] == passage[:-1]
    pair = np.bincount((passage[1:] * PAIRS + kind[:-1] * 8 + kind[1:])[same], minlength=n * PAIRS).reshape(n, PAIRS)
    out[:, :FINE] = np.sqrt(fine / np.maximum(size, 1))
    out[:, FINE : FINE + PAIRS] = np.sqrt(pair / np.maximum(size, 1))
    total = np.bincount(own, minlength=n).astype(np.float64)
    mean = lambda x: np.bincount(own, weights=x, minlength=n) / np.maximum(total, 1)
    length = (end - begin).astype(np.float64)
    repeated = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])])
    order = np.lexsort((hashes, own))
    seen = np.zeros(len(own), bool)
    seen[order[1:]] = (hashes[order][1:] == hashes[order][:-1]) & (own[order][1:] == own[order][:-1])
    marked = (_KIND[data[end - 1]] == 6)
    out[:, FINE + PAIRS :] = np.stack([
        mean(length) / 10, np.sqrt(mean(length**2)) / 20, mean(repeated), mean(seen), mean(marked), mean(length == 1), total / PASSAGE], 1)
    return out, starts


@dataclass
class Model:
    centre: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def score(self, features: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return _forward(self.weights, self.scaled(features), starts)[0]

    def scaled(self, features: np.ndarray) -> np.ndarray:
        """The one transformation that fitting and scoring share."""
        return np.clip((features - self.centre) / self.scale, -8, 8)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _forward(w: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray):
    """Scores of the documents, and what the gradient needs. starts: first passage of each, and the end."""
    sizes, heads = np.diff(starts), starts[:-1]
    hidden = np.tanh(x @ w["encode"] + w["encode0"])
    tanh, gate = np.tanh(hidden @ w["tanh"]), _sigmoid(hidden @ w["gate"])
    raw = (tanh * gate) @ w["attend"]
    raw = np.exp(raw - np.repeat(np.maximum.reduceat(raw, heads), sizes))
    share = raw / np.repeat(np.add.reduceat(raw, heads), sizes)
    pooled = np.add.reduceat(share[:, None] * hidden, heads)
    return _sigmoid(pooled @ w["out"] + w["out0"]), hidden, tanh, gate, share, pooled


def fit(bags: list[np.ndarray], labels: np.ndarray, epochs: int = 40, batch: int = 128, rate: float = 3e-3, seed: int = 5) -> Model:
    """Fit by Adam on the log loss; without labels, or with one class only, the score is their smoothed mean."""
    rng = np.random.default_rng(seed)
    shapes = {"encode": (FEATURES, HIDDEN), "encode0": (HIDDEN,), "tanh": (HIDDEN, GATE), "gate": (HIDDEN, GATE), "attend": (GATE,), "out": (HIDDEN,), "out0": ()}
    w = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) if k[-1] != "0" else np.zeros(s) for k, s in shapes.items()}
    if len(set(labels.tolist())) < 2:
        prior = (labels.sum() + 1) / (len(labels) + 2)
        return Model(np.zeros(FEATURES), np.ones(FEATURES), {k: v * 0 for k, v in w.items()} | {"out0": np.array(np.log(prior / (1 - prior)))})
    everything = np.concatenate(bags).astype(np.float64)
    centre, scale = everything.mean(0), everything.std(0) + 1e-3
    bags = [Model(centre, scale, w).scaled(b) for b in bags]
    first, second, step = {k: v * 0 for k, v in w.items()}, {k: v * 0 for k, v in w.items()}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            x, y = np.concatenate([bags[k] for k in own]), labels[own]
            starts = np.concatenate([[0], np.cumsum([len(bags[k]) for k in own])])
            sizes, heads = np.diff(starts), starts[:-1]
            p, hidden, tanh, gate, share, pooled = _forward(w, x, starts)
            error = (p - y) / len(own)
            g = {"out": pooled.T @ error, "out0": error.sum()}
            d_pool = np.repeat(error[:, None] * w["out"], sizes, axis=0)
            d_share = (hidden * d_pool).sum(1)
            d_raw = share * (d_share - np.repeat(np.add.reduceat(share * d_share, heads), sizes))
            g["attend"] = (tanh * gate).T @ d_raw
            both = d_raw[:, None] * w["attend"]
            d_tanh, d_gate = both * gate * (1 - tanh**2), both * tanh * gate * (1 - gate)
            g["tanh"], g["gate"] = hidden.T @ d_tanh, hidden.T @ d_gate
            d_hidden = (share[:, None] * d_pool + d_tanh @ w["tanh"].T + d_gate @ w["gate"].T) * (1 - hidden**2)
            g["encode"], g["encode0"] = x.T @ d_hidden, d_hidden.sum(0)
            step += 1
            for k in w:
                grad = g[k] + 1e-4 * w[k]
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad**2
                w[k] = w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(centre, scale, w)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (label, text): the features of all passages of each text."""
    for batch in batches:
        for first, data, offsets in slices(batch.column(1)):
            features, starts = passages(data, offsets)
            for k in range(len(offsets) - 1):
                own = features[starts[k] : starts[k + 1]]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first + k, 1), pa.array([own.astype("<f4").tobytes()], pa.binary())], ["label", "bag"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most_documents: int = 5000, most_bytes: int = 64 << 20) -> Model:
    """Fit on labelled documents whose crc32(id as text) mod 5 is not 0.

    The sample that reaches the driver is bounded by two parameters: documents in hash order, up to `most_documents`
    and as long as their texts together hold at most `most_bytes`; each of them whole, with all passages. Labels
    other than 0 and 1, null ids and ids with both labels do not count, repeated labels count once; of
    documents with one id the smallest text counts. Ties cannot change the sample: equal hashes are ordered by id.
    """
    order = F.xxhash64("doc_id")
    chosen = (
        labels.filter((F.crc32(F.col("doc_id").cast("string")) % 5 != 0) & F.col(label).isin(0, 1))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(F.col(label).cast("int")).alias("label"), F.max(F.col(label).cast("int")).alias("other"))
        .filter("label = other").select("doc_id", "label").orderBy(order, "doc_id").limit(most_documents)
    )
    # at most `most_documents` rows of two numbers: safe to broadcast
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    upto = F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).over(Window.orderBy(order, "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    sized = texts.select("doc_id", upto.alias("upto")).filter(F.col("upto") <= most_bytes).select("doc_id")  # of the chosen few
    rows = texts.join(F.broadcast(sized), "doc_id").select("label", "text").mapInArrow(_bags, "label int, bag binary").collect()
    rows.sort(key=lambda r: (r["label"], bytes(r["bag"])))  # the same order in every run
    bags = [np.frombuffer(r["bag"], "<f4").reshape(-1, FEATURES) for r in rows]
    return fit(bags, np.array([r["label"] for r in rows], np.float64))


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; null and empty texts are one empty passage.

    Repeated rows and null ids (never held out) keep a row each; equal texts have equal scores; a very long text is
    scored alone over all its passages.
    """
    names = ["doc_id", "held_out", "score", "predicted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in slices(batch.column(2)):
                p = np.round(model.score(*passages(data, offsets)), 12)  # sums may differ in the last bits by their neighbours
                n = len(p)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, n), batch.column(1).slice(first, n), pa.array(p.astype(np.float64)),
                    pa.array((p >= threshold).astype(np.int32))], names)

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")

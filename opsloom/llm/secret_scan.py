"""Secrets in texts: fixed patterns, and random strings by the likelihood ratio of two Markov models.

A second-order character model of random strings and one of ordinary identifiers are trained from labelled strings:
either a table of samples, or the documents themselves, where the values that the patterns find are labelled
random and other runs of letters, digits and `+/_-` ordinary. Both are counted over all rows. A run of at least
16 such characters that no pattern touches becomes a span of kind `random` when its log-likelihood ratio
reaches a threshold. The models are tables over 67 symbols, whatever the corpus.

Special rows: a null text has no spans; repeated rows and null ids keep a result each; without labelled strings the
ratio is 0 everywhere and no span is added; an empty table gives an empty result; further columns are
ignored. Texts are scanned whole, a long one alone, in time proportional to its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.llm.arrays import slices

# The patterns to find, and the kinds of span in their order.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex", "random")
LEAST = {"assign": 12, "access": 18, "hex": 16, "random": 16}
HINTS = (b"passw", b"secret", b"token", b"api")  # every match of ASSIGN holds one of them

ORDINARY_LEAST = 8  # letters of a run that is counted as an ordinary identifier
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
N = len(SYMBOLS) + 1  # symbol 0 stands before the first character
SMOOTHING = 50.0
HELD_RUNS = 100_000
UNIFORM_SHARE = 0.3  # of the random model: strings over the whole alphabet, which samples may lack
THRESHOLD = 12.0

_CODE = np.zeros(256, np.int32)
_CODE[np.frombuffer(SYMBOLS.encode(), np.uint8)] = np.arange(1, N)
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_HEX = np.zeros(256, bool)
_HEX[np.frombuffer(b"0123456789abcdef", np.uint8)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _runs(inside: np.ndarray, heads: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of True of at least `least`; a run never crosses a position in `heads`."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(len(inside) + 1, bool)
    cut[heads] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | cut[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    long = end - start >= least
    return start[long], end[long]


def _base(data: np.ndarray, offsets: np.ndarray) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Spans (kind number, start, end) of the patterns in bytes, and the values in them."""
    raw, lowered = data.tobytes(), _LOWER[data].tobytes()
    spans, values = [], []

    def rows_with(text: bytes, hint: bytes, out: set) -> set:
        at = text.find(hint)
        while at >= 0:
            row = int(np.searchsorted(offsets, at, side="right")) - 1
            out.add(row)
            at = text.find(hint, int(offsets[row + 1]))
        return out

    hinted: set = set()
    for hint in HINTS:
        rows_with(lowered, hint, hinted)
    for row in sorted(hinted):
        for m in ASSIGN.finditer(raw, int(offsets[row]), int(offsets[row + 1])):
            if m.end(2) - m.start(2) >= LEAST["assign"]:
                spans.append((0, *m.span()))
                values.append(m.span(2))
    for row in sorted(rows_with(raw, b"AKIA", set())):
        for m in ACCESS.finditer(raw, int(offsets[row]), int(offsets[row + 1])):
            if m.end() - m.start() >= LEAST["access"]:
                spans.append((1, *m.span()))
                values.append(m.span())
    for start, end in zip(*(x.tolist() for x in _runs(_HEX[data], offsets[:-1][offsets[:-1] < len(data)], LEAST["hex"]))):
        spans.append((2, start, end))
        values.append((start, end))
    return spans, values


def _covered(spans: list[tuple[int, int]], n: int) -> np.ndarray:
    steps = np.zeros(n + 1, np.int32)
    if spans:
        ends = np.array(spans)
        np.add.at(steps, ends[:, 0], 1)
        np.add.at(steps, ends[:, 1], -1)
    return np.cumsum(steps)[:n] > 0


def _grams(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbol triples of all characters of the runs, and where each run begins among them."""
    sizes = end - start
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) + np.repeat(start - first, sizes)
    depth = np.arange(len(place)) - np.repeat(first, sizes)
    code = _CODE[data]
    before = np.where(depth >= 1, code[np.maximum(place - 1, 0)], 0)
    earlier = np.where(depth >= 2, code[np.maximum(place - 2, 0)], 0)
    return (earlier * N + before) * N + code[place], first


# training

def _counted(batches: Iterator[pa.RecordBatch], labelled) -> Iterator[pa.RecordBatch]:
    """Rows (label, gram, n) of short ordinary runs and rows (label, run) of all other runs."""
    held, runs = np.zeros(N**3, np.int64), set()
    for batch in batches:
        for label, data, start, end in labelled(batch):
            alone = (end - start >= LEAST["random"]) | (label == 1)
            held += np.bincount(_grams(data, start[~alone], end[~alone])[0], minlength=N**3)
            raw = data.tobytes() if alone.any() else b""
            runs.update((label, raw[a:b].decode()) for a, b in zip(start[alone].tolist(), end[alone].tolist()))
            if len(runs) > HELD_RUNS:
                yield _rows(np.zeros(0, np.int64), held, runs)
                runs.clear()
    yield _rows(np.flatnonzero(held), held, runs)


def _rows(grams: np.ndarray, held: np.ndarray, runs: set) -> pa.RecordBatch:
    first = [label for label, _ in runs]
    return pa.RecordBatch.from_arrays(
        [pa.array([*first, *[0] * len(grams)], pa.int64()), pa.array([*[-1] * len(first), *grams.tolist()], pa.int64()),
         pa.array([*[0] * len(first), *held[grams].tolist()], pa.int64()),
         pa.array([*(run for _, run in runs), *[None] * len(grams)], pa.string())], names=["label", "gram", "n", "run"])


def _spelt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grams of the distinct runs; rows of grams pass."""
    held = np.zeros((2, N**3), np.int64)
    for batch in batches:
        label, gram, n = (np.asarray(batch.column(c)) for c in ("label", "gram", "n"))
        np.add.at(held, (label[gram >= 0], gram[gram >= 0]), n[gram >= 0])
        for k in range(2):
            for _, data, offsets in slices(batch.column("run").filter(pa.array((gram < 0) & (label == k)))):
                held[k] += np.bincount(_grams(data, offsets[:-1], offsets[1:])[0], minlength=N**3)
    for k in range(2):
        seen = np.flatnonzero(held[k])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), k)), pa.array(seen), pa.array(held[k][seen])], names=["label", "gram", "n"])


def _summed(texts: DataFrame, labelled) -> DataFrame:
    rows = texts.mapInArrow(lambda batches: _counted(batches, labelled), "label long, gram long, n long, run string")
    distinct = rows.groupBy("label", "gram", "run").agg(F.sum("n").alias("n")).select("label", "gram", "n", "run")
    return distinct.mapInArrow(_spelt, "label long, gram long, n long").groupBy("label", "gram").agg(F.sum("n").alias("n"))


def counts_from_documents(docs: DataFrame) -> DataFrame:
    """(label, gram, n): character triples of the values of the patterns (1) and of the other runs (0) of all texts.

    Ordinary are runs whose digits stand at their end, as few long random strings do. Values, and ordinary runs
    long enough to be found, count once however often they occur, so copies do not teach a string.
    """

    def labelled(batch):
        for _, data, offsets in slices(batch.column(0)):
            spans, values = _base(data, offsets)
            symbols, heads = _CODE[data] > 0, offsets[:-1][offsets[:-1] < len(data)]
            taken = _covered([s[1:] for s in spans], len(data))
            start, end = _runs(symbols, heads, ORDINARY_LEAST)
            sums = np.concatenate([[0], np.cumsum(taken)])
            back = np.concatenate([[0], np.cumsum(_DIGIT[data[:-1]] & symbols[1:] & ~_DIGIT[data[1:]])]) if len(data) else np.zeros(1, np.int64)
            free = (sums[end] == sums[start]) & (back[np.maximum(end - 1, 0)] == back[start])
            yield 0, data, start[free], end[free]
            marks = np.unique([*heads.tolist(), *(s for v in values for s in v if s < len(data))]).astype(np.int64)
            yield 1, data, *_runs(symbols & _covered(values, len(data)), marks, 2)

    return _summed(docs.select(F.col("text").cast("string")), labelled)


def counts_from_samples(samples: DataFrame) -> DataFrame:
    """The same counts from a table (text, label) of strings; rows whose label is neither 0 nor 1 do not count."""

    def labelled(batch):
        for label in range(2):
            column = batch.column(0).filter(pc.equal(batch.column(1), label))
            for _, data, offsets in slices(column):
                yield label, data, *_runs(_CODE[data] > 0, offsets[:-1][offsets[:-1] < len(data)], 1)

    return _summed(samples.select(F.col("text").cast("string"), F.col("label").cast("long")), labelled)


def _chain(n: np.ndarray, floor: np.ndarray) -> np.ndarray:
    """P(symbol | the two before) from counts [earlier, before, symbol], smoothed by shorter contexts and `floor`."""
    def smoothed(counts, below):
        return (counts + SMOOTHING * below) / (counts.sum(-1, keepdims=True) + SMOOTHING)

    return smoothed(n, smoothed(n.sum(0), smoothed(n.sum((0, 1)), floor)))


def fit(counts: DataFrame) -> np.ndarray:
    """Log-likelihood ratio, random to ordinary, of each symbol triple (at most 2 * 67**3 counts reach the driver)."""
    rows = counts.toArrow()
    n = np.zeros((2, N**3))
    n[np.asarray(rows["label"], dtype=np.int64), np.asarray(rows["gram"], dtype=np.int64)] = np.asarray(rows["n"], dtype=np.int64)
    n = n.reshape(2, N, N, N)
    n[0] = np.maximum(n[0] - 1, 0)  # a triple that stands in one string only is no evidence for that string
    even = np.full(N, 1 / (N - 1))
    even[0] = 0
    if not n[0].any() or not n[1].any():
        return np.zeros(N**3, np.float32)
    ordinary, random = _chain(n[0], even), (1 - UNIFORM_SHARE) * _chain(n[1], even) + UNIFORM_SHARE * even
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.log(random) - np.log(ordinary)
    ratio[..., 0] = 0  # the start symbol is never drawn
    return ratio.astype(np.float32).ravel()


# scanning

def scan(docs: DataFrame, ratio: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id and spans (kind, start, end, ratio) of every row: code points, end exclusive, by start, then kind.

    `ratio` is null for the patterns. One pass over the texts, without a shuffle.
    """
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("ratio", pa.float64())])

    def found(data: np.ndarray, offsets: np.ndarray) -> list[list[tuple]]:
        base, _ = _base(data, offsets)
        start, end = _runs(_CODE[data] > 0, offsets[:-1][offsets[:-1] < len(data)], LEAST["random"])
        rows = [(k, a, b, None) for k, a, b in base]
        if len(start):
            taken = np.concatenate([[0], np.cumsum(_covered([s[1:] for s in base], len(data)))])
            free = taken[end] == taken[start]
            start, end = start[free], end[free]
        if len(start):
            grams, first = _grams(data, start, end)
            sums = np.add.reduceat(ratio[grams].astype(np.float64), first)
            over = sums >= threshold
            rows += zip([3] * int(over.sum()), start[over].tolist(), end[over].tolist(), sums[over].tolist())
        if not rows:
            return [[] for _ in offsets[1:]]
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        out: list[list] = [[] for _ in offsets[1:]]
        for k, a, b, r in sorted(rows, key=lambda row: (row[1], row[0])):
            doc = int(np.searchsorted(offsets, a, side="right")) - 1
            shift = int(points[offsets[doc]])
            out[doc].append((KINDS[k], int(points[a]) - shift, int(points[b]) - shift, r))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [row for _, data, offsets in slices(batch.column(1)) for row in found(data, offsets)]
            listed = [[dict(zip(("kind", "start", "end", "ratio"), s)) for s in row] for row in spans]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(listed, pa.list_(kind))], names=["doc_id", "spans"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    name = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {name}, spans array<struct<kind: string, start: bigint, end: bigint, ratio: double>>")


def secret_report(docs: DataFrame) -> DataFrame:
    """Train on the documents, scan them, and write the spans of every document as text."""
    found = scan(docs, fit(counts_from_documents(docs)))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in KINDS[:3]],
                        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "random")), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))

"""Find benchmark items in documents up to word edits.

An item of n words leaks into a document if some run of the document's words is within edit distance
floor(n / 5) of it (similarity 0.8); items of one to four words must occur unchanged. Words are compared
in lower case.

1. Windows: an item within distance e must hold one of its e + 1 equal pieces unchanged, and all but e
   of its words must stand around it, so only windows of the item's size around such pieces are
   looked at (nothing is lost by this).
2. CGK embedding: a random walk copies the word under its head and moves on or not by a random bit of
   (step, word); edit distance becomes Hamming distance. 24 walks, each sampled 12 times at 4 steps;
   a window and an item that agree in all 4 steps of a sample are a candidate pair.
3. Candidates are verified by the exact edit distance of the item to the best run inside the window's
   surroundings.

Items are numbered without a sort and indexed in blocks of at most `block`, each by a task that writes its
index to the shared folder. The documents are read once: a task keeps the words of a batch and goes over the
indexes one after the other, so what it holds is bounded whatever the size of the benchmark.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opsloom.llm.arrays import U, flat, mixed, shingled, slices, words
from opsloom.llm.shared import make_folder, open_input, open_output, shared_folder, staged

#: items of an index; indexes that a Python worker keeps (more are read again for each batch)
BLOCK, KEPT_INDEXES = 4000, 4
WALKS, SAMPLES, STEPS = 24, 12, 4
SHIFTS = 5


def allowed(n: int) -> int:
    return n // 5


def embed(rows: np.ndarray) -> np.ndarray:
    """CGK embeddings of equally long rows of words, (walk, row, step); 0 stands behind the end."""
    n, steps = rows.shape[1], 2 * rows.shape[1]
    padded = np.concatenate([rows, np.zeros((len(rows), 1), U)], axis=1)
    salts = mixed(np.arange(WALKS * steps, dtype=U) + U(1), n).reshape(WALKS, steps)
    head, own = np.zeros((WALKS, len(rows)), np.int64), np.arange(len(rows))
    out = np.empty((WALKS, len(rows), steps), U)
    for step in range(steps):
        word = out[:, :, step] = padded[own, head]
        move = mixed(word ^ salts[:, step : step + 1]) >> U(63)
        head = np.minimum(head + move.astype(np.int64), n)
    return out


def sample_keys(rows: np.ndarray) -> np.ndarray:
    """Keys of all samples: (row, walk * sample). The same for windows and items of one length."""
    n = rows.shape[1]
    places = np.stack([
        np.stack([np.random.default_rng((walk, sample, n)).choice(2 * n, min(STEPS, 2 * n), replace=False) for sample in range(SAMPLES)])
        for walk in range(WALKS)])
    names = (np.arange(WALKS * SAMPLES, dtype=U) * U(1_000_003) + U(n)).reshape(WALKS, 1, SAMPLES)
    keys = []
    for at in range(0, len(rows), 512):
        paths = embed(rows[at : at + 512])
        key = np.broadcast_to(names, (WALKS, paths.shape[1], SAMPLES))
        for k in range(places.shape[2]):
            key = mixed(key + np.take_along_axis(paths, np.broadcast_to(places[:, None, :, k], key.shape), axis=2))
        keys.append(key.transpose(1, 0, 2).reshape(paths.shape[1], -1))
    return np.concatenate(keys) if keys else np.zeros((0, WALKS * SAMPLES), U)


@dataclass
class Index:
    ids: np.ndarray
    missing: np.ndarray  # where the id is null
    items: list[np.ndarray]
    grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # by size: sorted keys, item, word offset
    keys: np.ndarray
    owners: np.ndarray


def build_index(ids: list[int | None], texts: list[str]) -> Index:
    """Pieces and sample keys of a block of items; items without words are left out."""
    data, offsets = flat(pa.array(texts, pa.string()))
    _, _, hashes, first = words(data[offsets[0] : offsets[-1]], offsets - offsets[0], lower=True)
    kept, items = [], []
    for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        if b > a:
            kept.append(ids[k])
            items.append(hashes[a:b])
    found: dict[int, list[tuple[int, int, int]]] = {}
    for k, item in enumerate(items):
        pieces = allowed(len(item)) + 1
        size = len(item) // pieces
        runs = shingled(item, size)
        found.setdefault(size, []).extend((int(runs[p * size]), k, p * size) for p in range(pieces))
    grams = {}
    for size, rows in found.items():
        rows.sort()
        grams[size] = (np.array([r[0] for r in rows], U), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
    keys, owners = [np.zeros(0, U)], [np.zeros(0, np.int64)]
    for n in sorted({len(i) for i in items}):
        own = [k for k, i in enumerate(items) if len(i) == n]
        table = sample_keys(np.stack([items[k] for k in own]))
        keys.append(table.reshape(-1))
        owners.append(np.repeat(own, table.shape[1]))
    keys, owners = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(keys, kind="stable")
    missing = np.array([i is None for i in kept], bool)
    return Index(np.array([0 if i is None else i for i in kept], np.int64), missing, items, grams, keys[order], owners[order])


def write_index(index: Index, uri: str) -> None:
    parts = {"ids": index.ids, "missing": index.missing, "keys": index.keys, "owners": index.owners,
             "words": np.concatenate([np.zeros(0, U), *index.items]), "sizes": np.array([len(i) for i in index.items], np.int64),
             "gram_sizes": np.array(list(index.grams), np.int64)}
    for size, columns in index.grams.items():
        parts |= {f"gram_{size}_{k}": column for k, column in enumerate(columns)}
    held = io.BytesIO()
    np.savez(held, **parts)
    with open_output(uri) as out:
        out.write(held.getvalue())


@lru_cache(maxsize=KEPT_INDEXES)
def read_index(uri: str) -> Index:
    with open_input(uri) as file:
        parts = np.load(io.BytesIO(file.read()), allow_pickle=False)
    items = np.split(parts["words"], np.cumsum(parts["sizes"])[:-1]) if len(parts["sizes"]) else []
    grams = {size: tuple(parts[f"gram_{size}_{k}"] for k in range(3)) for size in parts["gram_sizes"].tolist()}
    return Index(parts["ids"], parts["missing"], items, grams, parts["keys"], parts["owners"])


def expanded(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (place in wanted, place in sorted keys) with equal values."""
    low, high = np.searchsorted(keys, wanted, "left"), np.searchsorted(keys, wanted, "right")
    n = high - low
    hit = np.repeat(np.arange(len(wanted)), n)
    return hit, np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


def best_runs(item: np.ndarray, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edit distance of the item to the best run of each region (rows), and where that run ends."""
    width = regions.shape[1]
    places = np.arange(width + 1)
    before = np.zeros((len(regions), width + 1), np.int64)
    for k, word in enumerate(item):
        row = np.empty_like(before)
        row[:, 0] = k + 1
        row[:, 1:] = np.minimum(before[:, :-1] + (regions != word), before[:, 1:] + 1)
        before = np.minimum.accumulate(row - places, axis=1) + places
    return before.min(axis=1), before.argmin(axis=1)


def surroundings(index: Index, hashes: np.ndarray, first: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By item size: (row, start in the row, words from e before the start to e behind the end).

    Starts where a piece of an item stands unchanged and all but e of the item's words stand around.
    """
    row_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    starts = []
    for size, (keys, owner, offset) in index.grams.items():
        if len(hashes) < size:
            continue
        runs = shingled(hashes, size)
        place = np.minimum(np.searchsorted(keys, runs), len(keys) - 1)
        at = np.flatnonzero((keys[place] == runs) & (row_of[: len(runs)] == row_of[size - 1 :]))
        hit, gram = expanded(keys, runs[at])
        starts.append(np.stack([row_of[at[hit]], owner[gram], at[hit] - offset[gram]], 1))
    if not starts or not (found := np.unique(np.concatenate(starts), axis=0)).size:
        return {}
    parts: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
    order = np.argsort(found[:, 1], kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(found[order, 1])) + 1):
        item = index.items[found[own[0], 1]]
        reach, known, row, start = allowed(len(item)), np.unique(item), found[own, 0], found[own, 2]
        place = start[:, None] - reach + np.arange(len(item) + 2 * reach)
        inside = (place >= first[row][:, None]) & (place < first[row + 1][:, None])
        around = np.where(inside, hashes[np.clip(place, 0, len(hashes) - 1)], U(0))
        same = (known[np.minimum(np.searchsorted(known, around), len(known) - 1)] == around) & inside
        keep = same.sum(axis=1) >= len(item) - reach
        parts.setdefault(len(item), []).append((row[keep], (start - first[row])[keep], around[keep]))
    return {n: tuple(np.concatenate(c) for c in zip(*p)) for n, p in parts.items()}


def matches(index: Index, n: int, row: np.ndarray, start: np.ndarray, around: np.ndarray) -> dict[tuple[int, int], tuple[int, int]]:
    """(row, item) to (distance, last word of the run) for the surroundings of items of n words."""
    reach, out = allowed(n), {}
    for at in range(0, len(row), 2048):
        part = around[at : at + 2048]
        shifts = np.unique(np.round(np.linspace(0, 2 * reach, SHIFTS)).astype(int)).tolist()
        keys = sample_keys(np.concatenate([part[:, s : s + n] for s in shifts]))
        hit, place = expanded(index.keys, keys.reshape(-1))
        pairs = np.unique(np.stack([index.owners[place], hit // keys.shape[1] % len(part)], 1), axis=0)
        for own in np.split(pairs, np.flatnonzero(np.diff(pairs[:, 0])) + 1) if len(pairs) else []:
            item, near = int(own[0, 0]), own[:, 1]
            distance, end = best_runs(index.items[item], part[near])
            for k, d, e in zip((at + near).tolist(), distance.tolist(), end.tolist()):
                if d <= reach:
                    key, value = (int(row[k]), item), (d, int(start[k]) - reach + e)
                    out[key] = min(out.get(key, value), value)
    return out


def search(index: Index, parts: Iterable[tuple[int, np.ndarray, np.ndarray]]) -> list[tuple[int, int, int, int]]:
    """Verified (row, item number, distance, last word), best per row and item.

    parts: (number of the first row, word hashes, first word of each row); surroundings of all parts
    are embedded together, because the walks take one array operation per step.
    """
    held: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
    for base, hashes, first in parts:
        for n, (row, start, around) in surroundings(index, hashes, first).items():
            held.setdefault(n, []).append((row + base, start, around))
    out: dict[tuple[int, int], tuple[int, int]] = {}
    for n, found in held.items():
        out |= matches(index, n, *(np.concatenate(c) for c in zip(*found)))
    return [(row, item, d, end) for (row, item), (d, end) in out.items()]


def numbered(items: DataFrame, block: int) -> DataFrame:
    """Written items with the number of their block, at most `block` rows each.

    Rows are numbered inside the partition that writes them, and a partition starts where the one before
    ends, so no task sees all items.
    """
    listed = staged(items.withColumn("place", F.monotonically_increasing_id()), "items")
    part, row = F.shiftright("place", 33), F.col("place").bitwiseAND(2**33 - 1)
    sizes = listed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")  # a row per partition
    starts = sizes.select("part", before.alias("start"))
    return listed.withColumn("part", part).join(starts, "part").select(
        F.floor((F.col("start") + row) / block).alias("block"), "item_id", "text")


def write_indexes(items: DataFrame, block: int) -> list[str]:
    """Index files of the items (item_id, text), a file for each block, built by the tasks."""
    folder = shared_folder(items.sparkSession, "item-indexes")
    make_folder(folder)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        index = build_index([None if pd.isna(i) else int(i) for i in rows["item_id"]], rows["text"].tolist())
        uri = f"{folder}/{uuid.uuid4().hex}.npz"  # a task that runs twice writes two files, and one of them is named
        if index.items:
            write_index(index, uri)
        return pd.DataFrame({"uri": [uri] if index.items else []}, dtype=object)

    # ids as texts: a null would turn a column of whole numbers into floating point
    rows = numbered(items.withColumn("item_id", F.col("item_id").cast("string")), block)
    files = staged(rows.groupBy("block").applyInPandas(build, "uri string"), "index-files")
    return sorted(r["uri"] for r in files.collect())  # a name for each block


FOUND = "doc_id long, text_key long, item_id long, distance int, n_words int, end_word int"


def leaks(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, text_key, item_id, distance, n_words, end_word): every document and item that match.

    One row per document row and item row: the smallest distance, the item's words, and the number of
    document words up to the end of the best run. Null texts have no words; items without words match
    nothing; null ids stay null; repeated rows give repeated rows.
    """
    items = benchmark.filter(F.col("text").isNotNull()).select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    uris = write_indexes(items, block)
    if not uris:
        return docs.sparkSession.createDataFrame([], FOUND)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_search(uris), FOUND)


def _search(uris: list[str]):
    names = ["doc_id", "text_key", "item_id", "distance", "n_words", "end_word"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = ((base, *words(data, offsets, lower=True)[2:]) for base, data, offsets in slices(batch.column(2)))
            if len(uris) > 1:
                parts = list(parts)  # the words of a batch, read once for all indexes
            for uri in uris:
                index = read_index(uri)
                if found := search(index, parts):
                    at, item = pa.array([f[0] for f in found]), np.array([f[1] for f in found])
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(at), batch.column(1).take(at), pa.array(index.ids[item], pa.int64(), mask=index.missing[item]),
                        pa.array([f[2] for f in found], pa.int32()), pa.array([len(index.items[i]) for i in item.tolist()], pa.int32()),
                        pa.array([f[3] for f in found], pa.int32())], names)

    return run


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that match no item, with all their columns; rows of equal id and text go together."""
    # written first, so that Spark broadcasts the list only if it is small
    found = staged(leaks(docs.select("doc_id", "text"), benchmark).select(
        F.coalesce("doc_id", F.lit(-(2**63))).alias("_place"), F.col("text_key").alias("_key")).distinct(), "leaks")
    marked = docs.withColumns({"_place": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))), "_key": F.xxhash64("text")})
    return marked.join(found, ["_place", "_key"], "left_anti").drop("_place", "_key")

"""Remove every byte covered by a string of 400 bytes that also starts somewhere else.

Anchors. Each window of 400 bytes is named by the smallest hash of its 273-grams (the rightmost of equal
ones). Equal windows have equal names at equal offsets, so the windows of a text fall into segments
(runs of at most 128 window starts with one anchor), and only segments of one name can share windows.
Counting names and segment digests by a grouped aggregation leaves few segments to look into:

- a name that occurs once has no repeated window
- a segment whose (name, digest) occurs twice is repeated with all its windows
- names with different segments go on: one occurrence of each segment is sorted
- names with more than HOT different segments are not gathered. All windows of a name hold its anchor, so equal
  windows start at equal distances before it. One occurrence of each segment is cut into parts of PART neighbouring
  distances, dealt by the bytes that all windows of the part have in common (128-bit digests): a part that is alone
  there has no repeated window, and equal parts are repeated with all their windows. Only where different parts share
  those bytes, the windows of one of each are dealt by name and a 128-bit digest of their 400 bytes, and equal
  neighbours are repeated

Sort. Tasks sort the segments of their documents (name, then bytes) and exchange front-coded runs: the
length of the prefix shared with the entry before, and the rest. The receiving task merges the runs
of one target after the other (a target has about MERGED_AT_ONCE segments) with a loser tree that keeps, for every contender, its common prefix with the last winner: unequal
prefixes decide without looking at the bytes, equal ones are compared only behind them. In the merged
order all segments of a name are neighbours; their window suffixes are sorted, and neighbours that
share 400 bytes are repeated.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opsloom.llm.arrays import Prefixes, mixed, slices
from opsloom.llm.shared import LOWEST, staged, tasks

LENGTH, REACH = 400, 128
GRAM = LENGTH - REACH + 1
SORTED_AT_ONCE = 1 << 15
HOT = SORTED_AT_ONCE // REACH  # segments of one name that are sorted together
PART = 8  # window starts that are compared together in hot segments
MERGED_AT_ONCE = 20_000  # segments of one target, on average


def _grams(prefix: Prefixes, n: int) -> np.ndarray:
    return mixed((prefix.sums[GRAM:] - prefix.sums[:-GRAM]) * prefix.back[: n - GRAM + 1], 77)


def segments(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window start, end of window starts, name, digest) of the segments of one text."""
    n = len(data)
    if n < LENGTH:
        return (np.zeros(0, np.int64),) * 4
    prefix = Prefixes(data)
    grams = _grams(prefix, n)
    least, step = grams, 1
    while step < REACH:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (grams[REACH:] == least[1:])
    start = np.flatnonzero(new)
    end = np.concatenate([start[1:], [len(least)]])
    return start, end, least[start].view(np.int64), prefix.spans(start, end - 1 + LENGTH).view(np.int64)


def _per_row(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    for first, data, offsets in slices(column):
        for k in range(len(offsets) - 1):
            yield first + k, data[offsets[k] : offsets[k + 1]]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, digest, n), summed over chunks of the task's segments."""

    def summed(names: list[np.ndarray], digests: list[np.ndarray]) -> pa.RecordBatch:
        pairs = np.stack([np.concatenate(names), np.concatenate(digests)], 1)
        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
        heads = np.flatnonzero(np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(axis=1)]))
        return pa.RecordBatch.from_arrays([
            pa.array(pairs[heads, 0]), pa.array(pairs[heads, 1]), pa.array(np.diff(np.append(heads, len(pairs))))], ["name", "digest", "n"])

    names, digests, held = [], [], 0
    for batch in batches:
        for _, data in _per_row(batch.column(0)):
            _, _, name, digest = segments(data)
            if len(name):
                names.append(name)
                digests.append(digest)
                held += len(name)
            if held >= 1 << 19:
                yield summed(names, digests)
                names, digests, held = [], [], 0
    if held:
        yield summed(names, digests)


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, text_key, name, digest, first, last) of every segment; last is the last window start."""
    for batch in batches:
        places, keys = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        rows, held = [], 0
        for k, data in _per_row(batch.column(2)):
            start, end, name, digest = segments(data)
            rows.append((np.full(len(start), places[k]), np.full(len(start), keys[k]), name, digest, start, end - 1))
            held += len(start)
            if held >= 1 << 17:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows)], _LOCATED)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows)], _LOCATED)


_LOCATED = ["place", "text_key", "name", "digest", "first", "last"]


# --- front-coded runs and their merge


def shared_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix of two strings that are known to share `start` bytes."""
    most, step = min(len(a), len(b)), 16
    while start < most:
        stop = min(start + step, most)
        if a[start:stop] != b[start:stop]:
            if step == 1:
                return start
            step = max(1, step // 4)
        else:
            start, step = stop, step * 2 if step >= 16 else step
    return most


def pack_run(entries: list[tuple[bytes, bytes]]) -> bytes:
    """Sorted (string, payload of 9 bytes) entries, front-coded."""
    out, before = [], b""
    for text, payload in entries:
        common = shared_prefix(before, text)
        out.append(struct.pack("<II", common, len(text) - common) + payload + text[common:])
        before = text
    return b"".join(out)


def read_run(raw: bytes) -> Iterator[tuple[int, bytes, bytes]]:
    """(common prefix with the entry before, string, payload)."""
    at, before = 0, b""
    while at < len(raw):
        common, rest = struct.unpack_from("<II", raw, at)
        payload = raw[at + 8 : at + 17]
        before = before[:common] + raw[at + 17 : at + 17 + rest]
        at += 17 + rest
        yield common, before, payload


def merge(runs: Iterable[Iterator[tuple[int, bytes, bytes]]]) -> Iterator[tuple[int, bytes, bytes]]:
    """Merge sorted runs; yields (common prefix with the output before, string, payload).

    A loser tree: every inner node holds the contender that lost there, with the length of the prefix it
    shares with the last string that went past. The longer shared prefix wins unseen; equal ones are
    compared from there on.
    """
    runs = list(runs)
    size = 1
    while size < len(runs):
        size *= 2
    current: list[tuple[int, bytes, bytes] | None] = [None] * size
    common = [0] * size

    def advance(k: int) -> None:
        current[k] = next(runs[k], None) if k < len(runs) else None
        common[k] = current[k][0] if current[k] else 0

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two contenders; sets the loser's common prefix with the winner."""
        if current[a] is None or current[b] is None:
            return (b, a) if current[a] is None else (a, b)
        if common[a] != common[b]:
            return (a, b) if common[a] > common[b] else (b, a)
        one, two = current[a][1], current[b][1]
        both = shared_prefix(one, two, common[a])
        winner, loser = (a, b) if one[both : both + 1] <= two[both : both + 1] else (b, a)
        common[loser] = both
        return winner, loser

    for k in range(size):
        advance(k)
    losers, level = [0] * size, list(range(size))
    node = size
    while len(level) > 1:  # the first match-ups, from the leaves up
        node //= 2
        played = [play(level[2 * k], level[2 * k + 1]) for k in range(node)]
        for k, (_, loser) in enumerate(played):
            losers[node + k] = loser
        level = [winner for winner, _ in played]
    champion = level[0]
    while current[champion] is not None:
        yield common[champion], current[champion][1], current[champion][2]
        advance(champion)
        node = (champion + size) // 2
        while node:
            champion, losers[node] = play(champion, losers[node])
            node //= 2


def repeated_windows(texts: list[bytes], whole: list[bool]) -> list[np.ndarray]:
    """For distinct segments of one name: which window starts are repeated (in whole ones all are)."""
    out = [np.full(len(t) - LENGTH + 1, w) for t, w in zip(texts, whole)]
    places = [(k, s) for k, t in enumerate(texts) for s in range(len(t) - LENGTH + 1)]
    if len(places) <= SORTED_AT_ONCE:
        suffixes = sorted((texts[k][s : s + LENGTH], k, s) for k, s in places)
        for a, b in zip(suffixes, suffixes[1:]):
            if a[0] == b[0]:
                out[a[1]][a[2]] = out[b[1]][b[2]] = True
        return out
    # many segments: order the suffixes by their hash instead of all their bytes, compare neighbours exactly
    joined = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.cumsum([0] + [len(t) for t in texts[:-1]])
    at = np.concatenate([b + np.arange(len(o)) for b, o in zip(begin, out)])
    flags = np.concatenate(out)
    hashes = Prefixes(joined).spans(at, at + LENGTH)
    order = np.argsort(hashes, kind="stable")
    raw = joined.tobytes()
    for j in np.flatnonzero(hashes[order][1:] == hashes[order][:-1]).tolist():
        a, b = at[order[j]], at[order[j + 1]]
        if raw[a : a + LENGTH] == raw[b : b + LENGTH]:
            flags[order[j]] = flags[order[j + 1]] = True
    return np.split(flags, np.cumsum([len(o) for o in out])[:-1])


def _runs(n: int):
    """Rows (segments of a document to sort, text): front-coded runs by receiving task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[bytes, bytes]] = {}
        size = 0

        def sent() -> pa.RecordBatch:
            targets = sorted(held)
            packed = [pack_run(sorted(held[t].items())) for t in targets]
            return pa.RecordBatch.from_arrays([pa.array(targets, pa.int32()), pa.array(packed, pa.large_binary()).cast(pa.binary())], ["target", "run"])

        for batch in batches:
            for wanted, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = (text or "").encode()
                for s in wanted:
                    name = s["name"] % 2**64
                    entry = name.to_bytes(8, "big") + raw[s["first"] : s["last"] + LENGTH]
                    held.setdefault(name % n, {})[entry] = struct.pack("<q?", s["digest"], s["whole"])
                    size += len(entry)
            if size >= 64 << 20:
                yield sent()
                held, size = {}, 0
        if held:
            yield sent()

    return run


def _of_target(runs: list[bytes]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple[int, int, int, int]] = []

    def solved(group: list[tuple[bytes, bytes]]) -> None:
        if len(group) < 2:
            return
        name = struct.unpack(">q", group[0][0][:8])[0]
        payloads = [struct.unpack("<q?", p) for _, p in group]
        for (digest, whole), flags in zip(payloads, repeated_windows([t[8:] for t, _ in group], [w for _, w in payloads])):
            if not whole and flags.any():
                edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
                rows.extend((name, digest, int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2]))

    group: list[tuple[bytes, bytes]] = []
    for common, text, payload in merge([read_run(r) for r in runs]):
        if group and common < 8:
            solved(group)
            group = []
        if not group or common < len(text) or len(text) != len(group[-1][0]):  # equal segments of two runs are one
            group.append((text, payload))
    solved(group)
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["name", "digest", "low", "high"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs in order of their targets: (name, digest, low, high) ranges of repeated window starts."""
    runs: list[bytes] = []
    target = None
    for batch in batches:
        for to, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if to != target:
                yield from _of_target(runs)
                runs, target = [], to
            runs.append(raw)
    yield from _of_target(runs)


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _sent(rows: Iterator[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    for piece in batched(rows, 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*piece)], names)


def _hot_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (hot segments of a document, text): (name, digest, data) of every segment."""
    rows = (
        (s["name"], s["digest"], raw[s["first"] : s["last"] + LENGTH])
        for batch in batches for wanted, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        for raw in [(text or "").encode()] for s in wanted
    )
    yield from _sent(rows, ["name", "digest", "data"])


def parts(data: bytes) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(first window start, last one, bytes common to all windows of a full part, bytes of the part) of one segment."""
    grams = _grams(Prefixes(np.frombuffer(data, np.uint8)), len(data))
    anchor, last = len(grams) - 1 - int(np.argmin(grams[::-1])), len(data) - LENGTH
    for k in range((anchor - last) // PART, anchor // PART + 1):
        near, far = k * PART, k * PART + PART - 1  # distances of a window's start from the anchor
        low, high = max(0, anchor - far), min(last, anchor - near)
        yield low, high, data[anchor - near : anchor - far + LENGTH], data[low : high + LENGTH]


def _hot_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (name, digest, data) of segments: (name, digest, low, high, core, part) of their parts, both as digests."""
    rows = (
        (name, digest, low, high, _digest(core), _digest(part))
        for batch in batches for name, digest, data in zip(*(c.to_pylist() for c in batch.columns)) for low, high, core, part in parts(data)
    )
    yield from _sent(rows, ["name", "digest", "low", "high", "core", "part"])


def _hot_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (name, digest, data, ranges of window starts): (name, window, digest, at) of every window start in them."""
    rows = (
        (name, _digest(data[at : at + LENGTH]), digest, at)
        for batch in batches for name, digest, data, ranges in zip(*(c.to_pylist() for c in batch.columns))
        for r in ranges for at in range(r["low"], r["high"] + 1)
    )
    yield from _sent(rows, ["name", "window", "digest", "at"])


def _equal_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (name, window, digest, at) in order: (name, digest, at) of windows that occur more than once."""
    before, is_sent = None, False
    for batch in batches:
        out: list[tuple[int, int, int]] = []
        for name, window, digest, at in zip(*(c.to_pylist() for c in batch.columns)):
            same = before is not None and before[:2] == (name, window)
            if same:
                if not is_sent:
                    out.append((before[0], *before[2:]))
                out.append((name, digest, at))
            before, is_sent = (name, window, digest, at), same
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["name", "digest", "at"])


def _hot_ranges(texts: DataFrame, n: int) -> DataFrame:
    """(name, digest, low, high) ranges of repeated window starts of hot segments (wanted, text)."""
    found = staged(texts.mapInArrow(_hot_segments, "name long, digest long, data binary"), "hot-segments")
    cut = found.mapInArrow(_hot_parts, "name long, digest long, low long, high long, core binary, part binary")
    alike, equal = Window.partitionBy("name", "core"), Window.partitionBy("name", "core", "part")
    cut = staged(
        cut.repartition(n, "name", "core")
        .withColumns({"differ": F.min("part").over(alike) != F.max("part").over(alike), "n": F.count(F.lit(1)).over(equal), "k": F.row_number().over(equal.orderBy("digest"))})
        .filter("differ OR n > 1").drop("core", "part"), "hot-parts")
    opened = cut.filter("differ AND k = 1").groupBy("name", "digest").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))  # at most REACH starts
    windows = found.join(opened, ["name", "digest"]).mapInArrow(_hot_windows, "name long, window binary, digest long, at long")
    single = windows.repartition(n, "name", "window").sortWithinPartitions("name", "window").mapInArrow(_equal_neighbours, "name long, digest long, at long")
    ranges = cut.filter("n > 1").select("name", "digest", "low", "high").unionByName(single.select("name", "digest", F.col("at").alias("low"), F.col("at").alias("high")))
    of_segment = Window.partitionBy("name", "digest").orderBy("low", "high")  # at most REACH starts and their parts
    before = F.max("high").over(of_segment.rowsBetween(Window.unboundedPreceding, -1))
    return (
        ranges.distinct().withColumn("new", F.when(F.col("low") <= before + 1, 0).otherwise(1)).withColumn("run", F.sum("new").over(of_segment))
        .groupBy("name", "digest", "run").agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("run")
    )


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    for batch in batches:
        rows = []
        for doc_id, text, found in zip(*(batch.column(k).to_pylist() for k in range(3))):
            raw = (text or "").encode()
            spans: list[list[int]] = []
            for span in sorted((s["low"], s["high"]) for s in found or []):
                if spans and span[0] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], span[1])
                else:
                    spans.append(list(span))
            kept, at = hashlib.sha256(), 0
            for low, high in spans:
                kept.update(raw[at:low])
                at = high
            kept.update(raw[at:])
            rows.append((doc_id, len(raw), sum(b - a for a, b in spans), len(spans), kept.hexdigest(), [x for s in spans for x in s]))
        if rows:
            types = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) of every row.

    Texts are UTF-8 bytes, null is empty; strings never cross rows and are judged on the input. `spans`
    lists start and end of the maximal removed runs. Texts under 400 bytes lose nothing; repeated rows
    are other places; null ids stay null; other columns are ignored. A very long text is cut into its
    segments once and hashed once, so time and memory grow with its length.
    """
    n = tasks(docs.sparkSession)
    place, text_key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)), F.xxhash64("text")
    rows = docs.select(place.alias("place"), text_key.alias("text_key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = rows.select("text").mapInArrow(_counted, "name long, digest long, n long")
    # dealt by name at once: the sums per segment and per name need no further exchange
    counted = counted.repartition(n, "name").groupBy("name", "digest").agg(F.sum("n").alias("n"))
    of_name = Window.partitionBy("name")
    repeated = staged(
        counted.withColumns({"all": F.sum("n").over(of_name), "kinds": F.count(F.lit(1)).over(of_name)}).filter("all > 1")
        .select("name", "digest", (F.col("n") > 1).alias("whole"), (F.col("kinds") > 1).alias("several"), (F.col("kinds") > HOT).alias("hot")), "repeated-segments")
    located = staged(
        rows.select("place", "text_key", "text").mapInArrow(_located, "place long, text_key long, name long, digest long, first long, last long")
        .join(repeated, ["name", "digest"]), "located-segments")
    texts = rows.select("place", "text_key", "text")

    def one_each(found: DataFrame) -> DataFrame:
        """(place, text_key, wanted): one occurrence of each segment, by document."""
        return (
            found.groupBy("name", "digest", "whole")
            .agg(F.min(F.struct("place", "text_key", "first", "last")).alias("s"))
            .groupBy("s.place", "s.text_key").agg(F.collect_list(F.struct("name", "digest", "whole", "s.first", "s.last")).alias("wanted"))
        )

    def with_text(chosen: DataFrame) -> DataFrame:
        """(wanted, text) of the chosen segments' documents."""
        # rows of equal id and text are one text here; the join has already dealt them by these keys
        return texts.join(chosen, ["place", "text_key"]).dropDuplicates(["place", "text_key"]).select("wanted", "text")

    targets = n * -(-max(repeated.filter("several AND NOT hot").count(), 1) // (n * MERGED_AT_ONCE))
    runs = with_text(one_each(located.filter("several AND NOT hot"))).mapInArrow(_runs(targets), "target int, run binary")
    found = runs.repartitionById(n, F.col("target") % n).sortWithinPartitions("target").mapInArrow(_merged, "name long, digest long, low long, high long")
    if not repeated.filter("hot").isEmpty():
        hot = staged(one_each(located.filter("hot")), "hot-places")  # mostly few: then Spark broadcasts them by their size, and no text is sent
        found = found.unionByName(_hot_ranges(with_text(hot), n))
    found = staged(found, "repeated-windows")
    spans = located.filter("whole").select("place", "text_key", F.col("first").alias("low"), (F.col("last") + LENGTH).alias("high")).unionByName(
        located.filter("several AND NOT whole").join(found, ["name", "digest"])
        .select("place", "text_key", (F.col("first") + F.col("low")).alias("low"), (F.col("first") + F.col("high") + LENGTH).alias("high")))
    # a set: rows of equal id and text bring the same spans once each
    per_text = spans.groupBy("place", "text_key").agg(F.collect_set(F.struct("low", "high")).alias("found"))
    return rows.join(per_text, ["place", "text_key"], "left").select("doc_id", "text", "found").mapInArrow(
        _removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>")

"""Similarity join of documents by the Jaccard coefficient of their word shingles.

Documents with the same shingle set are one class. Links between classes are found in three steps.

1. Candidates: global token orders in bundles of six (five below similarity 0.85). Two classes come
   together if they have the same first token under all orders of some bundle (the shortest prefix,
   intersected over the orders). A pair at similarity 0.9 agrees in a bundle of six with probability
   0.53; there are so many bundles (28) that all miss it with a probability below 1e-9, while a pair
   at 0.3 meets in one of fifty cases. The transitive closure of the groups are clusters; no pairs
   are formed.
2. In a cluster, classes must share a token of the lossless prefix (n - ceil(t n) + 1 tokens) under
   each of three further orders and have fitting sizes; the three filters are intersected.
3. What is left is verified on the whole sets. Pairs already connected are skipped.

A cluster is dealt into parts of about 200 classes; a few classes (pivots) go to every part. After the
parts are done, classes outside the largest component of their cluster (open) are joined with all
classes of the cluster on the tokens of the lossless prefix, rarest first. Rarity is counted in a table
of fixed size; any order is lossless. A token of many classes is dealt in pairs of blocks, and only
pairs of different components whose places of the token allow the similarity are verified, so all
pairs that could still join components are compared and no task holds more than a block.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.llm.arrays import U, mixed, shingled, slices, words
from opsloom.llm.graph import components
from opsloom.llm.shared import LOWEST, staged, tasks

MISS = 1e-9
PART, PIVOTS = 200, 8
BLOCK = 1000  # classes of one token, or neighbours of one class, that meet in one group of the second turn
COUNTERS = 1 << 20
FILTER_ORDERS = (101, 102, 103)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of each row; fewer words than `size` are one shingle, no words none."""
    _, _, hashes, first = words(data, offsets, lower=True)
    runs = shingled(hashes, size) if len(hashes) >= size else np.zeros(0, U)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            yield np.unique(runs[a : b - size + 1])
        elif b > a:
            yield mixed(shingled(hashes[a:b], b - a), b - a)
        else:
            yield np.zeros(0, U)


def class_name(tokens: np.ndarray) -> int | None:
    """64-bit digest of a set; among a billion sets two differ and share it with a chance of 3 %."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True) if len(tokens) else None


def bundles(percent: int) -> tuple[int, int]:
    """(number of bundles, orders in each) for a similarity."""
    width = 6 if percent >= 85 else 5
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** width)), width


def order_factors(percent: int) -> np.ndarray:
    """One odd factor per order: an order is a multiplication modulo 2**64."""
    n, width = bundles(percent)
    return (mixed(np.arange(1, n * width + 1, dtype=U), 11) | U(1)).reshape(n, width)


def keys_of(tokens: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """One key per bundle, from the first tokens under its orders."""
    firsts = np.array([(tokens * f).min() for f in factors.reshape(-1)]).reshape(factors.shape)
    out = np.arange(len(factors), dtype=U)
    for k in range(factors.shape[1]):
        out = mixed(out + firsts[:, k])
    return out.view(np.int64)


def _classes(size: int, percent: int):
    factors = order_factors(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_key", "n_shingles", "class", "keys"]
        known: set[int] = set()
        for batch in batches:
            for first, data, offsets in slices(batch.column(2)):
                sets = list(shingle_sets(data, offsets, size))
                called, keys = [class_name(s) for s in sets], []
                for name, s in zip(called, sets):
                    # a class is keyed once in a task: later copies carry no keys
                    if name is None or name in known:
                        keys.append(None)
                    else:
                        keys.append(keys_of(s, factors))
                        known.add(name)
                if len(known) > 200_000:
                    known.clear()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, len(sets)), batch.column(1).slice(first, len(sets)),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array(called, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], names)

    return run


def least_overlap(a: int, b: int, percent: int) -> int:
    """Smallest intersection of sets of sizes a and b with 100 * intersection >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


def _links(sets: list[np.ndarray], percent: int, group: list[int]) -> list[tuple[int, int]]:
    """Links that connect the sets; `group` holds the component of each and is updated."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    fits = 100 * np.minimum.outer(sizes, sizes) >= percent * np.maximum.outer(sizes, sizes)
    for seed in FILTER_ORDERS:
        tokens, owner = [], []
        for k, s in enumerate(sets):
            kept = len(s) - math.ceil(percent * len(s) / 100) + 1
            ranks = mixed(s, seed)
            tokens.append(np.partition(ranks, kept - 1)[:kept] if kept < len(s) else ranks)
            owner.append(np.full(len(tokens[-1]), k))
        tokens, owner = np.concatenate(tokens), np.concatenate(owner)
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        cuts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1], [True]]))
        shared = np.zeros((n, n), bool)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if b - a > 1:
                shared[np.ix_(owner[a:b], owner[a:b])] = True
        fits &= shared

    def root(k: int) -> int:
        while group[k] != k:
            group[k] = group[group[k]]
            k = group[k]
        return k

    found = []
    for i, j in zip(*np.nonzero(np.triu(fits, 1))):
        i, j = int(i), int(j)
        if root(i) != root(j):
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                found.append((i, j))
                group[root(i)] = root(j)
    return found


def _set_of(name: int, text: str | None, size: int) -> np.ndarray | None:
    """Shingles of the text; none for another text of the same key, which is not this class."""
    raw = (text or "").encode()
    tokens = next(shingle_sets(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), size))
    return tokens if class_name(tokens) == name else None


def _within_parts(size: int, percent: int):
    """Rows (cluster, part, class, text) in order; links between the classes of a part."""

    def of_part(rows: list[tuple]) -> list[tuple[int, int]]:
        seen: dict[int, np.ndarray] = {}
        for _, _, name, text in rows:
            if name not in seen and (tokens := _set_of(name, text, size)) is not None:
                seen[name] = tokens
        names = list(seen)
        if len(names) < 2:
            return []
        return [(names[i], names[j]) for i, j in _links(list(seen.values()), percent, list(range(len(names))))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            found: list[tuple[int, int]] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[-1][:2] != row[:2]:
                    found += of_part(held)
                    held = []
                if not held or held[-1] != row:  # repeated documents are one class
                    held.append(row)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["a", "b"])
        if found := of_part(held):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["a", "b"])

    return run


def _dealt(rows: DataFrame, size: int, percent: int) -> DataFrame:
    n = tasks(rows.sparkSession)
    return (
        rows.select("cluster", "part", "class", "text")
        .repartition(n, "cluster", "part").sortWithinPartitions("cluster", "part", "class")
        .mapInArrow(_within_parts(size, percent), "a long, b long")
    )


def _counter(ranks: np.ndarray) -> np.ndarray:
    return (ranks % U(COUNTERS)).astype(np.int64)


def _counts(size: int):
    """Rows (text): how many shingles fall on each counter, (counter, n) for the used ones of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for _, data, offsets in slices(batch.column(0)):
                for tokens in shingle_sets(data, offsets, size):
                    np.add.at(total, _counter(mixed(tokens, FILTER_ORDERS[0])), 1)
        used = np.flatnonzero(total)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["counter", "n"])

    return run


def _prefixes(size: int, percent: int, counts: np.ndarray):
    """Rows (cluster, label, open, class, text): the lossless prefix of each class, rarest tokens first.

    (cluster, label, open, class, n, place, token); place counts the tokens before it in the order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["cluster", "label", "open", "class", "n", "place", "token"]
        for batch in batches:
            rows, prefixes, sizes = [], [], []

            def sent() -> pa.RecordBatch:
                long = [len(p) for p in prefixes]
                columns = [np.repeat(np.array(c), long) for c in zip(*rows)]
                return pa.RecordBatch.from_arrays([
                    *(pa.array(c) for c in columns), pa.array(np.repeat(sizes, long), pa.int32()),
                    pa.array(np.concatenate([np.arange(x) for x in long]), pa.int32()),
                    pa.array(np.concatenate(prefixes).view(np.int64))], names)

            held = 0
            for *row, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (tokens := _set_of(row[-1], text, size)) is None:
                    continue
                ranks = mixed(tokens, FILTER_ORDERS[0])
                kept = len(ranks) + percent * len(ranks) // -100 + 1
                rows.append(row)
                prefixes.append(ranks[np.lexsort((ranks, counts[_counter(ranks)]))[:kept]])
                sizes.append(len(ranks))
                held += kept
                if held >= 1 << 18:
                    yield sent()
                    rows, prefixes, sizes, held = [], [], [], 0
            if rows:
                yield sent()

    return run


def _candidates(tokens: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes of a cluster, a open, that share a prefix token and may be similar enough.

    A token of more than BLOCK classes is dealt in pairs of blocks. The first token that a pair shares
    bounds the intersection by what is left of both sets, so a link passes at that token at least.
    """
    groups = (
        tokens.groupBy("cluster", "token").agg(F.count(F.lit(1)).alias("m"), F.max("open").alias("any"), F.min("label").alias("low"), F.max("label").alias("high"))
        .filter("any AND low <> high").select("cluster", "token", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    )
    rows = tokens.join(groups.hint("merge"), ["cluster", "token"]).withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = rows.filter("open").select("cluster", "token", F.col("block").alias("i"), others.alias("j"), F.col("class").alias("a"),
                                      F.col("label").alias("label_a"), (F.col("n") - F.col("place")).alias("rest_a"), F.col("n").alias("n_a"))
    right = rows.select("cluster", "token", others.alias("i"), F.col("block").alias("j"), F.col("class").alias("b"), F.col("label").alias("label_b"),
                        F.col("open").alias("open_b"), (F.col("n") - F.col("place")).alias("rest_b"), F.col("n").alias("n_b"))
    pairs = left.join(right.hint("merge"), ["cluster", "token", "i", "j"])
    enough = F.least("rest_a", "rest_b").cast("long") * (100 + percent) >= (F.col("n_a") + F.col("n_b")).cast("long") * percent
    return pairs.filter((F.col("label_a") != F.col("label_b")) & (~F.col("open_b") | (F.col("a") < F.col("b"))) & enough).select("a", "b").distinct()


def _verified(size: int, percent: int):
    """Rows (a, block, b, text) in order, the text of a first (b null): the pairs that are links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, one = None, None
        for batch in batches:
            found = []
            for a, block, b, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (a, block) != head:
                    head, one = (a, block), None
                if b is None:
                    one = _set_of(a, text, size) if one is None else one
                elif one is not None and (two := _set_of(b, text, size)) is not None:
                    both = len(np.intersect1d(one, two, assume_unique=True))
                    if 100 * both >= percent * (len(one) + len(two) - both):
                        found.append((a, b))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["a", "b"])

    return run


def _open_links(held: DataFrame, state: DataFrame, percent: int, size: int) -> DataFrame:
    """Links of open classes with classes of other components; state: (class, label, open)."""
    n = tasks(held.sparkSession)
    rows = held.join(state.hint("merge"), "class").dropDuplicates(["class", "text"])
    counted = rows.select("text").mapInArrow(_counts(size), "counter int, n long").groupBy("counter").agg(F.sum("n").alias("n"))
    counts = np.zeros(COUNTERS, np.int64)
    used = counted.toArrow()  # at most COUNTERS rows
    counts[np.asarray(used["counter"])] = np.asarray(used["n"])
    tokens = staged(rows.select("cluster", "label", "open", "class", "text").mapInArrow(
        _prefixes(size, percent, counts), "cluster long, label long, open boolean, class long, n int, place int, token long"), "open-prefixes")
    pairs = staged(_candidates(tokens, percent), "open-pairs")
    wide = staged(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "open-degrees")
    texts = rows.select("class", "text")
    heads = texts.join(wide.withColumnRenamed("a", "class").hint("merge"), "class").select(
        F.col("class").alias("a"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(None).cast("long").alias("b"), "text")
    lists = pairs.join(wide.hint("merge"), "a").select("a", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("block"), F.col("b").alias("class"))
    members = texts.join(lists.hint("merge"), "class").select("a", "block", F.col("class").alias("b"), "text")
    dealt = heads.unionByName(members).repartition(n, "a", "block").sortWithinPartitions("a", "block", "b")
    return dealt.mapInArrow(_verified(size, percent), "a long, b long")


def shingle_components(docs: DataFrame, percent: int = 90, size: int = 3) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id) of every row.

    Two documents are linked if 100 * intersection >= percent * union of their shingle sets;
    component_id is the smallest doc_id that links lead to. Null and empty texts and texts without
    words have no shingles and are linked with nothing: component_id is their own id. Null ids are
    linked like others but never name a component that has an id. Repeated rows are equal documents.
    """
    text_key = F.xxhash64("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = staged(
        rows.select("doc_id", text_key.alias("text_key"), "text")
        .mapInArrow(_classes(size, percent), "doc_id long, text_key long, n_shingles long, class long, keys array<long>"), "classes")
    keyed = found.filter(F.col("keys").isNotNull()).select("class", F.explode("keys").alias("key"))
    shared = staged(keyed.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low <> high").select("key", "low"), "shared-keys")
    clusters = components(keyed.join(shared, "key").select(F.col("class").alias("a"), F.col("low").alias("b")))
    links = None
    if clusters is not None:
        links = _cluster_links(rows, found, clusters, percent, size)
    roots = components(links) if links is not None else None
    if roots is None:
        called = found.withColumn("root", F.col("class"))
    else:
        # the roots have one row per linked class; copies of one class may be many rows: adaptive split
        called = found.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    called = staged(called.select("doc_id", "text_key", "n_shingles", "root"), "called")
    # written first: with a plain scan on either side adaptive execution can split the join of a large component
    least = staged(called.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("least")), "least-ids")
    return called.join(least, "root", "left").select(
        "doc_id", "text_key", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def _cluster_links(rows: DataFrame, found: DataFrame, clusters: DataFrame, percent: int, size: int) -> DataFrame:
    """Verified links (a, b) between classes; enough of them to give the components of all links."""
    clusters = clusters.select(F.col("node").alias("class"), F.col("root").alias("cluster"))
    sizes = staged(clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("classes")), "cluster-sizes")
    parts = F.ceil(F.col("classes") / PART).cast("int")
    head = F.pmod(F.xxhash64(F.lit(1), "class"), F.lit(1 << 30)) / float(1 << 30)
    members = clusters.join(sizes, "cluster").select("class", "cluster", parts.alias("parts"), F.pmod(F.xxhash64("class"), parts).cast("int").alias("part"),
                                                     (head < PIVOTS / F.col("classes")).alias("pivot"))
    # one document stands for its class
    speaker = found.filter(F.col("class").isNotNull()).groupBy("class").agg(
        F.min(F.struct(F.coalesce("doc_id", F.lit(LOWEST)).alias("place"), "text_key")).alias("s"))
    chosen = staged(members.join(speaker, "class").select("class", "cluster", "parts", "part", "pivot", "s.place", "s.text_key"), "speakers")
    texts = rows.select(F.coalesce("doc_id", F.lit(LOWEST)).alias("place"), F.xxhash64("text").alias("text_key"), "text")
    # the list grows with the table, so the plan is a merge join at every size
    held = staged(texts.join(chosen.hint("merge"), ["place", "text_key"]).dropDuplicates(["place", "text_key"]).select(
        "class", "cluster", "parts", "part", "pivot", "text"), "cluster-texts")
    everywhere = F.when(F.col("pivot") & (F.col("parts") > 1), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("part"))
    first = staged(_dealt(held.withColumn("part", F.explode(everywhere)), size, percent), "part-links")
    several = chosen.filter("parts > 1").select("class", "cluster")
    if several.isEmpty():
        return first
    joined = components(first)
    if joined is None:
        joined = first.select(F.col("a").alias("node"), F.col("b").alias("root"))
    labels = staged(
        several.join(joined.withColumnRenamed("node", "class"), "class", "left")
        .select("class", "cluster", F.coalesce("root", "class").alias("label")), "labels")
    main = (
        labels.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("cluster").agg(F.max(F.struct("n", "label")).alias("m")).select("cluster", F.col("m.label").alias("main"))
    )
    state = labels.join(main, "cluster").select("class", "cluster", "label", (F.col("label") != F.col("main")).alias("open"))
    undone = state.filter("open").select("cluster").distinct()
    state = staged(state.join(undone, "cluster", "left_semi").drop("cluster"), "open")
    if state.isEmpty():
        return first
    return first.unionByName(staged(_open_links(held.filter("parts > 1"), state, percent, size), "open-links"))


def one_per_component(docs: DataFrame, percent: int = 90, size: int = 3) -> DataFrame:
    """The documents without near copies: of each component the row with the smallest id stays.

    Rows without words stay. Where ids repeat or are null inside a component, one row still stays: the
    one of smallest (id, text digest).
    """
    found = shingle_components(docs.select("doc_id", "text"), percent, size)
    group = F.when(F.col("n_shingles") > 0, F.col("component_id"))
    marked = staged(found.withColumns({"group": group, "place": F.coalesce("doc_id", F.lit(LOWEST))}), "component-rows")
    lone = marked.filter(F.col("group").isNull()).select("place", "text_key")
    grouped = marked.filter(F.col("group").isNotNull())
    firsts = grouped.groupBy("group").agg(F.min(F.struct("doc_id", "text_key")).alias("f"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_key"))).alias("named"))
    firsts = firsts.select(F.coalesce("named", "f").alias("f")).select(F.coalesce("f.doc_id", F.lit(LOWEST)).alias("place"), "f.text_key")
    kept = staged(firsts.union(lone).distinct(), "kept-rows")
    out = docs.withColumns({"_place": F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)), "_key": F.xxhash64("text")})
    here = kept.withColumnsRenamed({"place": "_place", "text_key": "_key"})
    out = out.join(here.hint("merge"), ["_place", "_key"], "left_semi")
    repeated = marked.groupBy("place", "text_key").agg(F.max("n_shingles").alias("n"), F.count(F.lit(1)).alias("c")).filter("c > 1 AND n > 0")
    if not repeated.isEmpty():  # whole rows repeat: one of them stays
        words_in = F.regexp_like(F.coalesce(F.col("text"), F.lit("")), F.lit(r"[^ \t-\r]"))
        out = out.filter(words_in).dropDuplicates(["_place", "_key"]).unionByName(out.filter(~words_in))
    return out.drop("_place", "_key")

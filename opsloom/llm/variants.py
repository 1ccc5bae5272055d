"""Spelling variants: words one edit apart, found by k-d trees over their letter counts.

One inserted or deleted letter moves a vector of letter counts by 1 in the L1 norm, one replaced letter by 2. For
words of one length (or of two neighbouring lengths) a range search of that radius therefore loses no pair; what it
finds is then compared letter by letter.

The vocabulary is dealt by the boxes of a coarse tree for each length: every word lives in one box and is
searched for in all boxes within the radius. Inside a task a fine tree over the words of one box answers the
searches, which arrive as a sorted stream. The coarse tree is fitted on a bounded sample of words; every word is
indexed and searched, and the result does not depend on the sample. A box that outgrows its size (many words with
equal counts, which no plane divides) is split by word hash and its searches go to every part.

Special rows: a null text has no words, a null doc_id counts as empty text in the hash; repeated rows count again; an
empty table gives an empty result; further columns are ignored. Texts are read in pieces cut between words, so
memory grows with the distinct words of a task, not with the text. Of equal frequencies the smaller word (by code
point) becomes the form.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.llm.shared import staged, tasks

LETTERS = re.compile("[a-zÀ-ÿ]+")
LEAST_LETTERS, LEAST_COUNT, SPARSE = 7, 2, 31
PIECE = 1 << 20
HELD_WORDS = 300_000
#: most and least words of a box of the coarse tree, between them one box per task; words (about) in the sample
#: that its planes are fitted on
BOX_WORDS, LEAST_BOX, SAMPLE_WORDS = 65_536, 4_096, 65_536
LEAF_WORDS = 12
BLOCK = 4096
MOST_COUNT = 63  # larger counts are held at this: the distance can only shrink, so no pair is lost


# words and their counts

def _pieces(text: str) -> Iterator[str]:
    if len(text) <= PIECE:
        yield text
        return
    between, start = re.compile("[^a-zÀ-ÿ]"), 0
    while start < len(text):
        cut = between.search(text, start + PIECE)
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


def words_of(doc_id: str, text: str) -> Counter:
    """Words of a text with their counts, a letter deleted where 31 divides the hash of document and run."""
    runs: Counter = Counter()
    for piece in _pieces(text.encode().lower().decode()):  # bytes.lower() touches A-Z only
        runs.update([w for w in LETTERS.findall(piece) if len(w) >= LEAST_LETTERS])
    head, out = zlib.crc32(f"{doc_id}:".encode()), Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), head)
        if h % SPARSE == 0:
            place = h % len(run)
            run = run[:place] + run[place + 1:]
            if len(run) < LEAST_LETTERS:
                continue
        out[run] += n
    return out


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): words of at least 7 letters that occur at least twice in all texts together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.update(words_of(doc_id, text))
                if len(held) >= HELD_WORDS:
                    yield _counted(held)
                    held.clear()
        yield _counted(held)

    texts = docs.filter("text IS NOT NULL").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text").cast("string"))
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _counted(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])


# vectors and trees

def letters(words: list[bytes], length: int) -> np.ndarray:
    """Latin-1 letters of words of one length, a row each."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), length)


def letter_counts(shapes: np.ndarray) -> np.ndarray:
    """Counts of a-z and U+00C0 to U+00FF, a row of 90 numbers per word."""
    codes = np.where(shapes < 0xC0, shapes - ord("a"), shapes - (0xC0 - 26))
    n, length = codes.shape
    if length > 64:
        rows = [np.bincount(c, minlength=90) for c in codes]
        return np.minimum(np.array(rows).reshape(n, 90), MOST_COUNT).astype(np.int8)
    out, rows = np.zeros((n, 90), np.int8), np.arange(n)
    for k in range(length):
        out[rows, codes[:, k]] += 1
    return np.minimum(out, MOST_COUNT)


def _best_plane(points: np.ndarray) -> tuple[int, int] | None:
    """The letter and count that divide the points most evenly: at most `count` to the left."""
    best = None
    for count in range(int(points.max(initial=0))):
        shares = (points <= count).mean(0)
        letter = int(np.abs(shares - 0.5).argmin())
        off = abs(float(shares[letter]) - 0.5)
        if off < 0.5 and (best is None or off < best[0]):
            best = (off, letter, count)
        if shares.min() >= 0.5:
            break
    return best and best[1:]


class KdTree:
    """A k-d tree over count vectors; every node has a box, every leaf a number (coarse) or points (fine).

    Only `most` letters have a column of their own, those that most words differ in; the other letters share one
    more column with their sum, which never makes a distance larger.
    """

    def __init__(self, counts: np.ndarray, leaf: int, tight: bool, most: int = 31):
        spread = counts.astype(np.float32).var(0) if len(counts) else np.zeros(counts.shape[1])
        self.own = np.sort(np.argsort(-spread, kind="stable")[:most])
        points = self.project(counts)
        self.order = np.arange(len(points))
        self.lo, self.hi, self.kids, self.spans, self.planes = [], [], [], [], []
        low, high = np.zeros(most + 1, np.int8), np.full(most + 1, 127, np.int8)
        todo = [(self._add(), 0, len(points), low, high)]
        while todo:
            node, start, end, low, high = todo.pop()
            own = points[self.order[start:end]]
            self.lo[node], self.hi[node] = (own.min(0), own.max(0)) if tight and len(own) else (low, high)
            self.spans[node] = (start, end)
            plane = _best_plane(own) if end - start > leaf else None
            if plane is None:
                continue
            letter, count = plane
            left = own[:, letter] <= count
            self.order[start:end] = np.concatenate([self.order[start:end][left], self.order[start:end][~left]])
            middle, top, bottom = start + int(left.sum()), high.copy(), low.copy()
            top[letter], bottom[letter] = count, count + 1
            self.kids[node], self.planes[node] = (self._add(), self._add()), plane
            todo += [(self.kids[node][0], start, middle, low, top), (self.kids[node][1], middle, end, bottom, high)]
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)
        self.kids, self.spans = np.array(self.kids), np.array(self.spans)
        self.leaf = self.kids[:, 0] < 0
        self.points = points[self.order]

    def _add(self) -> int:
        for part, value in ((self.lo, None), (self.hi, None), (self.kids, (-1, -1)), (self.spans, (0, 0)), (self.planes, None)):
            part.append(value)
        return len(self.kids) - 1

    def project(self, counts: np.ndarray) -> np.ndarray:
        rest = counts.sum(1, dtype=np.int64) - counts[:, self.own].sum(1, dtype=np.int64)
        return np.ascontiguousarray(np.column_stack([counts[:, self.own], np.minimum(rest, MOST_COUNT).astype(np.int8)]))

    def without_points(self) -> KdTree:
        self.points, self.order = self.points[:0], self.order[:0]
        return self

    def home(self, queries: np.ndarray) -> np.ndarray:
        """The leaf whose box holds each projected query (coarse trees)."""
        at = np.zeros(len(queries), np.int64)
        letter = np.array([p[0] if p else 0 for p in self.planes])
        count = np.array([p[1] if p else 0 for p in self.planes])
        while not self.leaf[at].all():
            inner = np.flatnonzero(~self.leaf[at])
            node = at[inner]
            right = queries[inner, letter[node]] > count[node]
            at[inner] = self.kids[node, right.astype(int)]
        return at

    def leaves_near(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) for every leaf whose box lies within the radius."""
        query, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        found = []
        while len(query):
            q = queries[query]
            near = _sums(np.abs(q - np.minimum(np.maximum(q, self.lo[node]), self.hi[node]))) <= radius
            query, node = query[near], node[near]
            ends = self.leaf[node]
            found.append((query[ends], node[ends]))
            query, node = np.repeat(query[~ends], 2), self.kids[node[~ends]].ravel()
        return tuple(np.concatenate(part) for part in zip(*found))

    def points_near(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) candidates within the radius; points are numbers of the given order."""
        query, leaf = self.leaves_near(queries, radius)
        start, end = self.spans[leaf, 0], self.spans[leaf, 1]
        sizes, out = end - start, []
        step = np.searchsorted(np.cumsum(sizes), np.arange(0, int(sizes.sum()) + 1, 1 << 20))
        for a, b in zip(step, [*step[1:], len(leaf)]):
            size = sizes[a:b]
            own = np.repeat(query[a:b], size)
            place = np.arange(len(own)) + np.repeat(start[a:b] - (np.cumsum(size) - size), size)
            near = _sums(np.abs(queries[own] - self.points[place])) <= radius
            out.append((own[near], self.order[place[near]]))
        return tuple(np.concatenate(part) for part in zip(*out)) if out else (query, leaf)


def _sums(gaps: np.ndarray) -> np.ndarray:
    """Sums of rows of 32 small bytes, eight at a time; exact wherever the sum is small, never small by
    overflow unless large, so no row within a radius is lost."""
    wide = gaps.view(np.uint64)
    with np.errstate(over="ignore"):
        return (wide[:, 0] + wide[:, 1] + wide[:, 2] + wide[:, 3]) * np.uint64(0x0101010101010101) >> np.uint64(56)


def one_edit(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Which rows of letters are exactly one edit apart; rows of `one` are as long as those of `two`, or one longer."""
    length = two.shape[1]
    if one.shape[1] == length:
        return (one != two).sum(1) == 1
    head, tail = one[:, :length] == two, (one[:, 1:] == two)[:, ::-1]
    ahead = np.where(head.all(1), length, head.argmin(1))
    behind = np.where(tail.all(1), length, tail.argmin(1))
    return ahead + behind >= length


# the distributed search

def _planes(vocab: DataFrame) -> tuple[dict[int, KdTree], int]:
    """A coarse tree per length, from the number of words of each length and a bounded sample; words of a box."""
    sizes = {r.length: r.n for r in vocab.groupBy(F.char_length("word").alias("length")).agg(F.count("*").alias("n")).collect()}
    every = max(1, sum(sizes.values()) // SAMPLE_WORDS)
    sample = defaultdict(list)
    for row in vocab.filter(F.pmod(F.xxhash64("word"), F.lit(every)) == 0).select("word").collect():  # under 2 * SAMPLE_WORDS by the hash
        sample[len(row.word)].append(row.word.encode("latin-1"))
    trees, most = {}, min(BOX_WORDS, max(LEAST_BOX, sum(sizes.values()) // tasks(vocab.sparkSession)))
    for length, n in sizes.items():
        words = sample[length] if n > most else []
        points = letter_counts(letters(words, length)) if words else np.zeros((0, 90), np.int8)
        trees[length] = KdTree(points, max(32, len(words) * most // n), tight=False).without_points()
    return trees, most


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, list[bytes]]]:
    words = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
    sizes = np.array([len(w) for w in words], np.int64)
    for length in np.unique(sizes):
        rows = np.flatnonzero(sizes == length)
        yield int(length), rows, [words[r] for r in rows]


def _homes(trees: dict[int, KdTree]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, _, words in _by_length(batch):
                tree = trees[length]
                leaf = tree.home(tree.project(letter_counts(letters(words, length))))
                boxes, n = np.unique(leaf, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(boxes), length)), pa.array(boxes), pa.array(n)], names=["length", "box", "n"])

    return run


def _dealt(trees: dict[int, KdTree], parts: dict[tuple[int, int], int]):
    """Rows (length, box, part, role, word, n): role 0 lives there, 1 and 2 search there (2: from one letter more)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = np.asarray(batch.column("n"))
            for length, rows, words in _by_length(batch):
                counts, own = letter_counts(letters(words, length)), trees[length]
                projected = own.project(counts)
                out = [(np.arange(len(words)), own.home(projected), 0, length), (*own.leaves_near(projected, 2), 1, length)]
                if length - 1 in trees:
                    shorter = trees[length - 1]
                    out.append((*shorter.leaves_near(shorter.project(counts), 1), 2, length - 1))
                for word, box, role, where in out:
                    part = np.zeros(len(word), np.int64)
                    for (split, at), several in parts.items():
                        if split == where:
                            hit = np.flatnonzero(box == at)
                            if role == 0:
                                part[hit] = [zlib.crc32(words[w]) % several for w in word[hit]]
                            else:
                                extra = np.repeat(hit, several - 1)
                                word, box = np.concatenate([word, word[extra]]), np.concatenate([box, box[extra]])
                                part = np.concatenate([part, np.tile(np.arange(1, several), len(hit))])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(word), where)), pa.array(box), pa.array(part), pa.array(np.full(len(word), role)),
                         batch.column("word").take(pa.array(rows[word])), pa.array(number[rows[word]])],
                        names=["length", "box", "part", "role", "word", "n"])

    return run


class _Box:
    """The words of one box (or part of it), their fine tree and what has been found for them."""

    def __init__(self, length: int):
        self.length, self.words, self.n, self.tree = length, [], [], None

    def close(self) -> None:
        if self.tree is None:
            self.shapes = letters(self.words, self.length) if self.words else np.zeros((0, self.length), np.uint8)
            self.n = np.array(self.n, np.int64)
            self.tree = KdTree(letter_counts(self.shapes), LEAF_WORDS, tight=True)
            self.near = np.zeros(len(self.words), np.int64)
            self.best_n = np.zeros(len(self.words), np.int64)
            self.best = [b""] * len(self.words)

    def search(self, role: int, words: list[bytes], n: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Search for words that stand in ascending order; those found are counted on both sides."""
        self.close()
        for a in range(0, len(words) if self.words else 0, BLOCK):
            block, number = words[a:a + BLOCK], n[a:a + BLOCK]
            shapes = letters(block, self.length + role - 1)
            query, point = self.tree.points_near(self.tree.project(letter_counts(shapes)), 3 - role)
            step = max(1, (1 << 23) // self.length)
            good = [one_edit(shapes[query[k:k + step]], self.shapes[point[k:k + step]]) for k in range(0, len(query), step)]
            good = np.concatenate(good) if good else np.zeros(0, bool)
            query, point = query[good], point[good]
            yield _best(query, point, self.n[point], block, self.words)
            if role == 2:
                back, first, sizes = _tops(point, query, number[query])
                self.near[back] += sizes
                better = number[first] > self.best_n[back]
                self.best_n[back[better]] = number[first[better]]
                for word, by in zip(back[better], first[better]):
                    self.best[word] = block[by]

    def found(self) -> pa.RecordBatch:
        self.close()
        some = np.flatnonzero(self.near)
        return _results([self.words[k] for k in some], self.near[some], self.best_n[some], [self.best[k] for k in some])


def _tops(key: np.ndarray, other: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each key: the other with the largest n (of equal ones the first), and the number of others."""
    order = np.lexsort((other, -n, key))
    keys, starts, sizes = np.unique(key[order], return_index=True, return_counts=True)
    return keys, other[order[starts]], sizes


def _best(query, point, n, words: list[bytes], others: list[bytes]) -> pa.RecordBatch:
    keys, tops, sizes = _tops(query, point, n)
    numbers = dict(zip(point.tolist(), n.tolist()))
    return _results([words[k] for k in keys], sizes, np.array([numbers[t] for t in tops.tolist()], np.int64), [others[t] for t in tops])


def _results(words, near, best_n, best) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([w.decode("latin-1") for w in words], pa.string()), pa.array(near, pa.int64()), pa.array(best_n, pa.int64()),
         pa.array([w.decode("latin-1") for w in best], pa.string())], names=["word", "n_near", "best_n", "best"])


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (length, box, part, role, word): words that live in a box come before the searches."""
    at, box = None, None
    for batch in batches:
        keys = np.column_stack([np.asarray(batch.column(c)) for c in ("length", "box", "part", "role")])
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
        words = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
        number = np.asarray(batch.column("n"))
        for start, end in zip(cuts, cuts[1:]):
            if start == end:
                continue
            *place, role = keys[start].tolist()
            if place != at:
                if box is not None:
                    yield box.found()
                at, box = place, _Box(place[0])
            if role == 0:
                box.words += words[start:end]
                box.n += number[start:end].tolist()
            else:
                yield from box.search(role, words[start:end], number[start:end])
    if box is not None:
        yield box.found()


def near_words(vocab: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) for the words of `vocab` (word, n; written or kept) that have a near word:
    how many there are, and the most frequent of them (of equal ones the smallest) with its count."""
    trees, most = _planes(vocab)
    homes = vocab.mapInArrow(_homes(trees), "length long, box long, n long").groupBy("length", "box").agg(F.sum("n").alias("n"))
    parts = {(r.length, r.box): -(-r.n // most) for r in homes.filter(F.col("n") > 4 * most).collect()}
    rows = vocab.mapInArrow(_dealt(trees, parts), "length long, box long, part long, role long, word string, n long")
    placed = rows.repartition(4 * tasks(vocab.sparkSession), "length", "box", "part").sortWithinPartitions("length", "box", "part", "role", "word")
    found = placed.mapInArrow(_searched, "word string, n_near long, best_n long, best string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("minus"), "best")).alias("top")).select(
        "word", "n_near", (-F.col("top.minus")).alias("best_n"), F.col("top.best").alias("best"))


def variant_groups(docs: DataFrame, times: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n: every word with its near words, standard form and last form.

    The form is the most frequent near word if that is at least `times` as frequent, else null; root
    follows the forms to the last one. Forms grow `times`-fold at each step, so the largest count bounds the rounds
    of pointer doubling.
    """
    vocab = staged(vocabulary(docs), "vocabulary")
    near = near_words(vocab)
    rows = vocab.join(near, "word", "left").withColumn("formed", F.coalesce(F.col("best_n") >= times * F.col("n"), F.lit(False)))
    rows = staged(rows.select(
        "word", F.when(F.col("formed"), F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("formed"), F.col("best_n")).alias("form_n")), "forms")
    most = vocab.agg(F.max("n")).first()[0] or LEAST_COUNT
    steps = int(math.log(most / LEAST_COUNT, times) + 1e-9)  # the longest possible chain
    paths = rows.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        beyond = paths.select(F.col("word").alias("root"), F.col("root").alias("next"))
        paths = staged(paths.join(beyond, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "paths")
    return rows.join(paths, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""Document fingerprints from prefix polynomials.

For a text c[0..n) the prefix array S[i] = sum of c[j]*b**j for j < i, modulo the prime 2**31 - 1,
is kept for two bases. The hash of any span is (S[end] - S[start]) * b**-start, so two spans are
compared in constant time, and the longest common extension of two positions is a binary search.

A fingerprint is `length.hash.sketch`: code points, hash of the whole text, and the 64 smallest
mixed hashes of all spans of 32 code points (a shorter text is one span). Likeness of two
fingerprints is the Dice coefficient of their span sets estimated from the joint 64 smallest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.llm.arrays import U, mixed
from opsloom.llm.shared import tasks

PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 214_013_269)
SPAN, KEPT = 32, 64
_tables: dict[int, np.ndarray] = {}


def reduced(x: np.ndarray) -> np.ndarray:
    """x modulo 2**31 - 1 for x below 2**62."""
    x = (x & U(PRIME)) + (x >> U(31))
    x = (x & U(PRIME)) + (x >> U(31))
    return np.where(x >= U(PRIME), x - U(PRIME), x)


def _powers(base: int, n: int) -> np.ndarray:
    out = _tables.get(base, np.ones(1, U))
    while len(out) < n:
        out = np.concatenate([out, reduced(out * U(pow(base, len(out), PRIME)))])
    _tables[base] = out
    return out[:n]


class PrefixArrays:
    """Prefix arrays of one text for both bases."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(U) + U(1)
        self.n = len(codes)
        self.sums = []
        for base in BASES:
            sums = np.zeros(self.n + 1, U)
            np.cumsum(reduced(codes * _powers(base, self.n)), out=sums[1:])
            self.sums.append(reduced(sums))

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of every span [start, end), both moduli in one number."""
        parts = []
        for base, sums in zip(BASES, self.sums):
            raw = reduced(sums[ends] + U(PRIME) - sums[starts])
            parts.append(reduced(raw * _powers(pow(base, -1, PRIME), self.n + 1)[starts]))
        return (parts[0] << U(31)) | parts[1]

    def windows(self, size: int) -> np.ndarray:
        """Hashes of all spans of one size, by slices instead of index lists."""
        last = self.n - size + 1
        parts = []
        for base, sums in zip(BASES, self.sums):
            raw = reduced(sums[size:] + U(PRIME) - sums[:last])
            parts.append(reduced(raw * _powers(pow(base, -1, PRIME), last)))
        return (parts[0] << U(31)) | parts[1]

    def span(self, start: int, end: int) -> int:
        """Hash of one span in plain integers: array calls cost more than the sums for a single span."""
        one, two = (
            (int(sums[end]) - int(sums[start])) * pow(base, -start, PRIME) % PRIME for base, sums in zip(BASES, self.sums)
        )
        return one << 31 | two


def longest_extension(a: PrefixArrays, i: int, b: PrefixArrays, j: int) -> int:
    """Length of the longest common run from a[i] and b[j], by binary search over span hashes."""
    low, high = 0, min(a.n - i, b.n - j)
    sides = [
        (x, int(x[i]), pow(base, j, PRIME), y, int(y[j]), pow(base, i, PRIME))
        for base, x, y in zip(BASES, a.sums, b.sums)
    ]
    while low < high:
        middle = (low + high + 1) // 2
        # both spans brought to the power i + j, so that no inverse is needed
        if all((int(x[i + middle]) - x0) * up % PRIME == (int(y[j + middle]) - y0) * other % PRIME
               for x, x0, up, y, y0, other in sides):
            low = middle
        else:
            high = middle - 1
    return low


def sketch(prefix: PrefixArrays) -> np.ndarray:
    """The smallest distinct mixed span hashes, 32 bits of each."""
    if not prefix.n:
        return np.zeros(0, np.uint32)
    values = (mixed(prefix.windows(min(SPAN, prefix.n))) >> U(32)).astype(np.uint32)
    if len(values) > 16 * KEPT:
        few = np.unique(np.partition(values, 8 * KEPT)[: 8 * KEPT])
        if len(few) >= KEPT:
            return few[:KEPT]
    return np.unique(values)[:KEPT]


def fingerprint(prefix: PrefixArrays, kept: np.ndarray) -> str:
    return f"{prefix.n:x}.{prefix.span(0, prefix.n):016x}.{kept.astype('>u4').tobytes().hex()}"


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Dice coefficient of two span sets, 0 to 1; two empty texts are equal."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:KEPT]
    shared = len(np.intersect1d(np.intersect1d(a, b, assume_unique=True), union, assume_unique=True))
    jaccard = shared / len(union)
    return 2 * jaccard / (1 + jaccard)


def read_likeness(one: str, two: str) -> float:
    """Likeness of two fingerprints as written."""
    if one == two:
        return 1.0
    return likeness(*(np.frombuffer(bytes.fromhex(x.split(".")[2]), ">u4") for x in (one, two)))


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, shared_prefix long"
)
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ("shared_prefix", pa.int64()),
])


def _row(doc_id, text: str, own: tuple, following: str, other: tuple) -> tuple:
    prefix, kept, mark = own
    half = prefix.n // 2
    edited = text[: prefix.n - half] + following[:half]
    changed = PrefixArrays(edited)
    kept_changed = sketch(changed)
    return (
        doc_id, prefix.n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), mark,
        fingerprint(changed, kept_changed), likeness(kept, kept_changed), likeness(kept, other[1]),
        longest_extension(prefix, 0, changed, 0),
    )


def _marked(text: str) -> tuple:
    prefix = PrefixArrays(text)
    kept = sketch(prefix)
    return prefix, kept, fingerprint(prefix, kept)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket in document order; after a bucket's rows comes the first row of the next."""
    before, rows = None, []
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(4)]
        for bucket, ahead, doc_id, text in zip(*columns):
            text = text or ""
            if before is not None and before[0] == bucket:
                marked = _marked(text)
                rows.append(_row(*before[1:], text, marked))
                before = None if ahead else (bucket, doc_id, text, marked)
            elif not ahead:
                before = (bucket, doc_id, text, _marked(text))
            if len(rows) >= 512:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)
                rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)


def fingerprint_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every text, its edited text, and compare them and the next document.

    Order: descending id, null ids last, equal ids by text; after the last row comes the first. The
    edited text has its last floor(n/2) code points replaced by as many of the next text (or all of
    it). Null texts are empty; repeated rows give repeated rows; an empty table gives no rows; other
    columns are ignored. Texts are shuffled once, into buckets cut at ids of the table; the row that
    opens a bucket also goes to the end of the bucket before, so no task needs another's rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("place"),
                       F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    n = tasks(spark)
    shares = [k / n for k in range(1, n)] or [0.5]
    ends = rows.agg(F.percentile_approx("place", shares, 20 * n).alias("cuts"), F.max("place").alias("top")).first()
    # descending; bucket = number of cuts at or above the id, so a cut is the first id of its bucket
    cuts = sorted({c for c in ends["cuts"] or [] if c < ends["top"]}, reverse=True)
    top = F.lit(ends["top"])
    listed = F.array(*[F.lit(c) for c in cuts]) if cuts else F.lit(None).cast("array<bigint>")
    bucket = F.size(F.filter(listed, lambda c: c >= F.col("place"))) if cuts else F.lit(0)
    copies = F.array(
        F.struct(F.col("own").alias("bucket"), F.lit(0).alias("ahead")),
        F.when(F.array_contains(listed, F.col("place")), F.struct((F.col("own") - 1).alias("bucket"), F.lit(1).alias("ahead"))),
        F.when(F.col("place") == top, F.struct(F.lit(len(cuts)).alias("bucket"), F.lit(1).alias("ahead"))),
    )
    dealt = (
        rows.withColumn("own", bucket)
        .select("place", "doc_id", "text", F.explode(F.filter(copies, lambda x: x.isNotNull())).alias("to"))
        .select("to.bucket", "to.ahead", "place", "doc_id", "text")
        .repartitionById(len(cuts) + 1, F.col("bucket"))
        .sortWithinPartitions("bucket", "ahead", F.desc("place"), "text")
    )
    return dealt.select("bucket", "ahead", "doc_id", "text").mapInArrow(_neighbours, SCHEMA)

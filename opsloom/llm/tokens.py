"""Token ids of a corpus in files of canonical length-limited Huffman codes.

File: magic, size and zlib-packed code lengths (one byte per id), then independent blocks. A block
holds parts of documents (id, ids of the document in this block, whether it goes on), the bits of
all its ids, and the bit offset of every 256th id. A reader needs only the header and one block; it
decodes all runs of 256 ids of a block side by side with one table look-up per id.

Code lengths come from the counts of all ids of the corpus (package-merge, at most 18 bits, or two
more than an id of the vocabulary needs); codes are assigned in order of (length, id).
"""

from __future__ import annotations

import itertools
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from opsloom.llm.arrays import flat as utf8, slices
from opsloom.llm.shared import LOWEST, in_order, make_folder, open_input, open_output, shared_folder, staged

MAGIC = b"OLTOK\x01\x00\x00"
RUN = 256  # ids between two checkpoints
BLOCK = 1 << 20  # ids in a block
END_ID = 0
MOST_PIECES = 400_000
TOGETHER = 256  # pieces in one call of the tokenizer
WINDOW = 4 << 20  # bytes of a text that are cut at a time
_MARK, _ALNUM, _BLANK = (np.zeros(256, bool) for _ in range(3))
_MARK[np.frombuffer(b".,;:!?*$%&#-()\"", np.uint8)] = True
_ALNUM[np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", np.uint8)] = True
_BLANK[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True


def _blanks(data: np.ndarray) -> np.ndarray:
    """Bytes of white space characters, those beyond ASCII included."""
    out = _BLANK[data]
    wide = np.flatnonzero(data == 0xC2)
    wide = wide[wide + 1 < len(data)]
    wide = wide[np.isin(data[wide + 1], (0x85, 0xA0))]
    out[wide] = out[wide + 1] = True
    wide = np.flatnonzero((data >= 0xE1) & (data <= 0xE3))
    wide = wide[wide + 2 < len(data)]
    point = (data[wide].astype(np.int32) & 15) << 12 | (data[wide + 1].astype(np.int32) & 63) << 6 | data[wide + 2] & 63
    wide = wide[(point == 0x1680) | (point >= 0x2000) & (point <= 0x200A) | np.isin(point, (0x2028, 0x2029, 0x202F, 0x205F, 0x3000))]
    for k in range(3):
        out[wide + k] = True
    return out


def _cuts(data: np.ndarray) -> np.ndarray:
    """Places inside the bytes of a text, or of several, where the pre-tokenizer starts a new piece in any case.

    These are: before a single blank and before and after a single line feed between two characters
    that are no white space, and before an ASCII mark (the apostrophe apart) after a letter or digit.
    """
    if len(data) < 3:
        return np.zeros(0, np.int64)
    solid = ~_blanks(data)
    single = np.zeros(len(data), bool)
    single[1:-1] = solid[:-2] & solid[2:]
    line = single & (data == 10)
    cut = single & (data == 32) | line
    cut[1:] |= line[:-1]
    latin = np.zeros(len(data), bool)  # last byte of a letter from U+00C0 to U+00FF
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    cut[1:] |= _MARK[data[1:]] & (_ALNUM[data[:-1]] | latin[:-1])
    return np.flatnonzero(cut)


class Encoder:
    """Token ids of whole texts; repeated pieces are tokenized once.

    Texts are cut on their bytes where the pre-tokenizer of the vocabulary always starts a new piece, so the ids of a
    text are those of its pieces. The pieces of many texts are numbered together by an Arrow dictionary,
    which compares whole pieces; only new distinct ones go to the tokenizer.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.reset()

    def reset(self) -> None:
        self.ids = np.array([END_ID], np.uint32)
        self.starts, self.sizes = np.array([0], np.int64), np.array([1], np.int64)
        self.known: dict[bytes, int] = {}

    def _take(self, numbers: np.ndarray) -> np.ndarray:
        """Ids of the pieces, one after the other."""
        sizes = self.sizes[numbers]
        upto = np.cumsum(sizes)
        return self.ids[np.repeat(self.starts[numbers] - upto + sizes, sizes) + np.arange(upto[-1] if len(upto) else 0)]

    def _each(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each piece, and all ids."""
        new = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        return sizes, np.fromiter(itertools.chain.from_iterable(new), np.uint32, int(sizes.sum()))

    def _words(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces without white space but a leading blank, many to a call.

        A line feed between two pieces is a piece of its own and no other piece holds its id; where
        the ids show anything else, the pieces are encoded one by one.
        """
        groups = [pieces[k : k + TOGETHER] for k in range(0, len(pieces), TOGETHER)]
        sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        for group, found in zip(groups, self.tokenizer.encode_batch_fast(list(map("\n".join, groups)), add_special_tokens=False)):
            some = np.array(found.ids, np.uint32)
            ends = np.flatnonzero(some == self.line[0])
            if len(self.line) == 1 and len(ends) == len(group) - 1:
                sizes.append(np.diff(ends, prepend=-1, append=len(some)) - 1)
                ids.append(np.delete(some, ends))
            else:
                one, own = self._each(group)
                sizes.append(one)
                ids.append(own)
        return np.concatenate(sizes), np.concatenate(ids)

    def _learn(self, pieces: list[bytes]) -> None:
        """Tokenize new pieces and number them."""
        texts = [p.decode() for p in pieces]
        words = [k for k, p in enumerate(texts) if not p.isspace() and len(p.split()) == 1 and p.strip() == p.removeprefix(" ")]
        others = sorted(set(range(len(texts))) - set(words))
        both = (self._words([texts[k] for k in words]), self._each([texts[k] for k in others]))
        sizes, ids = (np.concatenate(x) for x in zip(*both))
        for number, k in enumerate(words + others, len(self.starts)):
            self.known[pieces[k]] = number
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes, self.ids = np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, ids])

    def _numbers(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Number of each piece; a piece ends where the next one starts."""
        ends = pa.py_buffer(np.append(starts, len(data)))
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, ends, pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        new = [p for p in pieces if p not in self.known]
        if new:
            self._learn(new)
        return np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))[np.asarray(coded.indices)]

    def _row(self, data: np.ndarray) -> Iterator[np.ndarray]:
        """Numbers of the pieces of one long text, window by window; a window ends at a cut."""
        first, width = 0, WINDOW
        while first < len(data):
            part = data[first : first + width]
            cuts = _cuts(part)
            if first + width < len(data):
                cuts = cuts[cuts < len(part) - 8]  # nearer to the edge a cut might depend on what follows
                if not len(cuts):
                    width *= 2
                    continue
                part = part[: cuts[-1]]
                cuts = cuts[:-1]
            yield self._numbers(part, np.concatenate([[0], cuts]))
            first, width = first + len(part), WINDOW

    def encode(self, texts: pa.Array | list) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, the end id after each text, and the number of ids per text (null: empty)."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for _, data, offsets in slices(column, WINDOW):
            if len(self.starts) > MOST_PIECES:
                self.reset()
            if len(data) > WINDOW:
                parts = [self._take(part) for part in self._row(data)]
                ids += [*parts, np.array([END_ID], np.uint32)]
                sizes.append(np.array([sum(map(len, parts)) + 1]))
                continue
            inside = np.zeros(len(data) + 1, bool)
            inside[_cuts(data)] = True
            inside[offsets] = True
            starts = np.flatnonzero(inside[:-1])
            numbers = self._numbers(data, starts) if len(starts) else np.zeros(0, np.int64)
            chosen = np.insert(numbers, np.searchsorted(starts, offsets[1:]), 0)
            upto = np.cumsum(self.sizes[chosen])
            ids.append(self._take(chosen))
            sizes.append(np.diff(upto[np.searchsorted(starts, offsets[1:]) + np.arange(len(offsets) - 1)], prepend=0))
        return np.concatenate(ids), np.concatenate(sizes)


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One encoder per Python worker: its pieces serve the worker's next tasks too."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code lengths of at most `limit` bits by package-merge; 0 for ids that do not occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    packages, leaf_first = np.zeros(0), []
    for _ in range(limit):
        both = np.concatenate([weights, packages])
        rank = np.argsort(both, kind="stable")
        leaf_first.append(np.cumsum(rank < len(weights)))
        both = both[rank]
        packages = both[: len(both) // 2 * 2].reshape(-1, 2).sum(axis=1)
    need = 2 * len(weights) - 2
    for leaves in reversed(leaf_first):
        if not need:
            break
        taken = int(leaves[need - 1])
        lengths[order[:taken]] += 1
        need = 2 * (need - taken)
    return lengths


def limit_for(size: int) -> int:
    return max(18, (max(size, 2) - 1).bit_length() + 2)


class Code:
    """Canonical codes of given lengths, and the table that decodes them."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.most = max(1, int(lengths.max(initial=1)))
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        spans = np.int64(1) << (self.most - self.lengths[order])
        firsts = np.cumsum(spans) - spans
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[order] = (firsts >> (self.most - self.lengths[order])).astype(np.uint64)
        self.symbols = np.zeros(1 << self.most, np.uint32)
        self.symbols[: int(spans.sum())] = np.repeat(order, spans)
        self.steps = self.lengths[self.symbols]

    def pack(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bits of the ids and the bit offset of every RUN-th id."""
        sizes = self.lengths[ids]
        begin = np.cumsum(sizes) - sizes
        bits = int(begin[-1] + sizes[-1]) if len(ids) else 0
        out = np.zeros(bits // 32 + 2, np.uint64)
        if len(ids):
            word = begin >> 5
            value = self.codes[ids] << (64 - (begin & 31) - sizes).astype(np.uint64)
            heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            at = word[heads]
            out[at] += np.add.reduceat(value >> np.uint64(32), heads)
            out[at + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), heads)
        return out.astype(">u4").tobytes(), begin[::RUN].astype(np.uint32)

    def unpack(self, bits: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        raw = np.frombuffer(bits, np.uint8).astype(np.uint32)
        raw = np.concatenate([raw, np.zeros(4, np.uint32)])
        window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        place = checkpoints.astype(np.int64)
        out = np.zeros((RUN, len(place)), np.uint32)
        last = len(window) - 1
        for k in range(min(RUN, n)):
            # bits past the end of the last run are read but not kept
            index = (window[np.minimum(place >> 3, last)] >> (32 - self.most - (place & 7)).astype(np.uint32)) & np.uint32((1 << self.most) - 1)
            out[k] = self.symbols[index]
            place = place + self.steps[index]
        return out.T.reshape(-1)[:n]


class Writer:
    """Appends documents to one file."""

    def __init__(self, sink, code: Code):
        self.sink, self.code, self.tokens, self.documents = sink, code, 0, 0
        packed = zlib.compress(code.lengths.astype(np.uint8).tobytes())
        sink.write(MAGIC + struct.pack("<II", len(code.lengths), len(packed)) + packed)

    def add(self, doc_ids: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Documents with their numbers of ids; long ones are cut over blocks."""
        ends = np.cumsum(sizes)
        for first in range(0, len(ids), BLOCK):
            last = min(first + BLOCK, len(ids))
            a, b = int(np.searchsorted(ends, first, side="right")), int(np.searchsorted(ends, last, side="left"))
            own = slice(a, b + 1)
            begins = ends[own] - sizes[own]
            here = np.minimum(ends[own], last) - np.maximum(begins, first)
            bits, marks = self.code.pack(ids[first:last])
            meta = zlib.compress(doc_ids[own].astype("<i8").tobytes() + here.astype("<i8").tobytes())
            self.sink.write(struct.pack("<IIIIIB", b + 1 - a, last - first, len(meta), len(marks), len(bits), int(ends[b] > last)))
            self.sink.write(meta + marks.astype("<u4").tobytes() + bits)
        self.tokens += len(ids)
        self.documents += len(sizes)


def read_blocks(source) -> Iterator[tuple[np.ndarray, np.ndarray, bool, np.ndarray]]:
    """(doc ids, ids of each in the block, last one goes on, ids) block by block."""
    if source.read(8) != MAGIC:
        raise ValueError("not a token file")
    size, packed = struct.unpack("<II", source.read(8))
    lengths = np.frombuffer(zlib.decompress(source.read(packed)), np.uint8)
    if len(lengths) != size:
        raise ValueError("code table is cut off")
    code = Code(lengths)
    head = struct.calcsize("<IIIIIB")
    while raw := source.read(head):
        documents, n, meta, marks, bits, more = struct.unpack("<IIIIIB", raw)
        body = source.read(meta + 4 * marks + bits)
        if len(body) != meta + 4 * marks + bits:
            raise ValueError("block is cut off")
        index = np.frombuffer(zlib.decompress(body[:meta]), "<i8")
        yield (index[:documents], index[documents:], bool(more),
               code.unpack(body[meta + 4 * marks :], np.frombuffer(body[meta : meta + 4 * marks], "<u4"), n))


def read_documents(source, whole: bool) -> Iterator[tuple[int, int, int, np.ndarray | None]]:
    """(place, ids, crc32, ids or None) per document; parts of a long document are joined."""
    open_part, n, crc, kept = False, 0, 0, []
    for places, sizes, more, ids in read_blocks(source):
        raw, ends = ids.astype("<u4"), np.cumsum(sizes)
        for k, (place, end, size) in enumerate(zip(places.tolist(), ends.tolist(), sizes.tolist())):
            if not (open_part and k == 0):
                n, crc, kept = 0, 0, []
            part = raw[end - size : end]
            n, crc = n + size, zlib.crc32(part, crc)
            if whole:
                kept.append(part)
            if k + 1 == len(sizes) and more:
                continue
            yield place, n, crc, np.concatenate(kept) if whole else None
        open_part = more


FILES = "bucket int, path string, documents long, tokens long"


def _listed(bucket: int, path: str, documents: int, tokens: int, *counts: bytes) -> pa.RecordBatch:
    values = [pa.array([bucket], pa.int32()), pa.array([path]), pa.array([documents]), pa.array([tokens]),
              *(pa.array([c]) for c in counts)]
    return pa.RecordBatch.from_arrays(values, ["bucket", "path", "documents", "tokens", "counts"][: len(values)])


def _tokenize(folder: str, tokenizer: str):
    """Write the ids of each partition to an Arrow file; returns its row of the manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        kind = pa.uint16() if encoder.size <= 1 << 16 else pa.uint32()
        schema = pa.schema([("place", pa.int64()), ("ids", pa.large_list(kind))])
        # a name of its own for each attempt: a repeated task never touches a finished file
        path, bucket, counts, documents = f"{folder}/ids-{uuid.uuid4().hex}.arrow", None, np.zeros(encoder.size, np.int64), 0
        writer = sink = None
        for batch in batches:
            if not batch.num_rows:
                continue
            bucket = batch.column(0)[0].as_py()
            if writer is None:
                sink = open_output(path)
                writer = pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd"))
            _, offsets = utf8(batch.column(2))
            first = 0
            while first < batch.num_rows:
                last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + WINDOW, side="right")) - 1)
                ids, sizes = encoder.encode(batch.column(2).slice(first, last - first))
                lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int64()),
                                                      pa.array(ids, kind))
                writer.write_batch(pa.RecordBatch.from_arrays([batch.column(1).slice(first, last - first), lists], schema=schema))
                counts += np.bincount(ids, minlength=encoder.size)
                documents += len(sizes)
                first = last
        if writer is not None:
            writer.close()
            sink.close()
            yield _listed(bucket, path, documents, int(counts.sum()), zlib.compress(counts.tobytes()))

    return run


def _id_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = 0
    for batch in batches:
        for packed in batch.column(0).to_pylist():
            total = total + np.frombuffer(zlib.decompress(packed), np.int64)
    if isinstance(total, np.ndarray):
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": used, "n": total[used], "size": np.full(len(used), len(total))})


def _compress(folder: str, lengths: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(lengths)
        for batch in batches:
            for row in batch.to_pylist():
                path = f"{folder}/part-{row['bucket']:06d}-{uuid.uuid4().hex[:8]}.tok"
                with open_output(path) as sink, open_input(row["path"]) as source:
                    writer = Writer(sink, code)
                    places, sizes, ids, n = [], [], [], 0
                    for part in itertools.chain(pa.ipc.open_stream(source), [None]):
                        if part is not None:
                            lists = part.column(1)
                            offsets = np.asarray(lists.offsets)
                            places.append(np.asarray(part.column(0)))
                            sizes.append(np.diff(offsets))
                            ids.append(np.asarray(lists.values)[offsets[0] : offsets[-1]])
                            n += len(ids[-1])
                        if places and (part is None or n >= BLOCK):
                            writer.add(np.concatenate(places), np.concatenate(sizes), np.concatenate(ids))
                            places, sizes, ids, n = [], [], [], 0
                yield _listed(row["bucket"], path, writer.documents, writer.tokens)

    return run




def write_token_files(docs: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenize whole texts and write them in ascending id order; returns the list of files.

    A null text has only the end id; a null id counts as the lowest; rows of equal id follow each
    other by text, repeated rows are all written; other columns are ignored; an empty table gives no
    file. Files are listed only once their task has ended, so a repeated task leaves no second copy.
    """
    spark = docs.sparkSession
    work = shared_folder(spark, "token-ids")
    for path in (work, folder):
        make_folder(path)
    rows, n = in_order(docs, id_col, [F.col(text_col).cast("string").alias("text")])
    parts = staged(
        rows.select("bucket", "place", "text")
        .mapInArrow(_tokenize(work, tokenizer), FILES + ", counts binary"), "token-parts")
    counted = (
        parts.select("counts").mapInArrow(_id_counts, "id long, n long, size long")
        .groupBy("id").agg(F.sum("n").alias("n"), F.max("size").alias("size")).collect()  # at most the vocabulary
    )
    counts = np.zeros(max((r["size"] for r in counted), default=1), np.int64)
    for r in counted:
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts, limit_for(len(counts)))
    return staged(
        parts.select("bucket", "path").repartitionById(n, F.col("bucket")).mapInArrow(_compress(folder, lengths), FILES),
        "token-files")


def read_token_files(files: DataFrame, whole: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) from the files alone; start counts all ids before."""
    before = F.coalesce(F.sum("tokens").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * whole
        names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * whole
        for batch in batches:
            for row in batch.to_pylist():
                rows, start, size = [], row["before"], 0
                with open_input(row["path"]) as source:
                    for place, n, crc, ids in read_documents(source, whole):
                        rows.append((None if place == LOWEST else place, start, n, crc) + ((ids.astype(np.int64),) if whole else ()))
                        start, size = start + n, size + n
                        if len(rows) >= 10_000 or whole and size >= BLOCK:
                            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")])
    if whole:
        schema.add("ids", T.ArrayType(T.LongType()))
    # one row per file passes the single task of the running sum; then a task per file
    numbered = files.select("bucket", "path", before.alias("before"))
    n = max(1, files.agg(F.max("bucket")).first()[0] or 0) + 1
    return numbered.repartitionById(n, F.col("bucket")).select("path", "before").mapInArrow(run, schema)

"""Token files against the tokenizers library, and the code against its definition."""

import heapq
import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from opsloom.llm import tokens as tk
from opsloom.llm.shared import shared_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", None, " ", "\n", " lead and trail ", "two  blanks and\n\nlines", "tab\there \x1c\x1dx", "it's we'll 12 3456 !?",
    "é ü ß 漢字 𝄞    x\u0085y", "a<|endoftext|>b <|endoftext|> c", "x\r\ny", " \n ", "word " * 3000, "one two 　three",
    "a 's b 't  c", "\n\n\nthe", "end \n", "….\n—x", "w\x1f\n v",
]


def expected(rows):
    library, start = Tokenizer.from_file(PATH), 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        yield doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids
        start += len(ids)


def test_pieces_give_the_library_ids():
    library, encoder, rng = Tokenizer.from_file(PATH), tk.Encoder(PATH), random.Random(4)
    alphabet = ["a", "B", "7", ".", "'s", " ", "  ", "\n", "\t", "é", " ", "\x1c", "​", "-", "the", "ing"]
    texts = [t or "" for t in ODD] + ["".join(rng.choices(alphabet, k=rng.randrange(30))) for _ in range(4000)]
    ids, sizes = encoder.encode(texts)
    for text, part in zip(texts, np.split(ids, np.cumsum(sizes)[:-1])):
        assert part.tolist() == library.encode(text, add_special_tokens=False).ids + [0], repr(text)


@pytest.mark.parametrize("rows", [
    [(k * 7 % 23 - 3, t) for k, t in enumerate(ODD)], [], [(None, "a b"), (None, None), (5, "x"), (5, "x"), (5, "w")],
    [(k, f"document {k} " * (k % 11)) for k in range(200)],
])
def test_files_give_back_all_ids(spark, rows):
    docs = spark.createDataFrame([(d, t, 1, "p") for d, t in rows], "doc_id long, text string, bucket int, path string")
    files = tk.write_token_files(docs, PATH, shared_folder(spark, "tok"))
    got = [(*r[:4], list(r[4])) for r in tk.read_token_files(files).collect()]
    assert sorted(got, key=lambda r: r[1]) == list(expected(rows))


def huffman_cost(counts):
    heap = [c for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


def test_lengths_are_optimal_and_limited():
    rng = np.random.default_rng(1)
    counts = rng.zipf(1.5, 300) * (rng.random(300) > 0.2)
    free, tight = tk.code_lengths(counts, 40), tk.code_lengths(counts, 9)
    assert (free * counts).sum() == huffman_cost(counts)
    for lengths in (free, tight):
        assert abs(sum(2.0 ** -int(x) for x in lengths if x) - 1) < 1e-9
    assert tight.max() <= 9 and (tk.code_lengths(np.array([0, 0]), 9) == 0).all() and tk.code_lengths(np.array([0, 5]), 9).tolist() == [0, 1]
    fib = [1, 1]
    while len(fib) < 30:
        fib.append(fib[-1] + fib[-2])
    assert tk.code_lengths(np.array(fib), 8).max() <= 8


def test_blocks_and_long_documents(monkeypatch):
    monkeypatch.setattr(tk, "BLOCK", 1000)
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 50, 12_345) ** 2
    sizes = np.array([1, 999, 1, 5000, 1000, 344, 5000])
    sink = io.BytesIO()
    writer = tk.Writer(sink, tk.Code(tk.code_lengths(np.bincount(ids), 18)))
    writer.add(np.arange(7), sizes, ids)
    sink.seek(0)
    got = list(tk.read_documents(sink, True))
    assert [g[1] for g in got] == sizes.tolist() and np.array_equal(np.concatenate([g[3] for g in got]), ids)
    with pytest.raises(ValueError):
        list(tk.read_documents(io.BytesIO(sink.getvalue()[:-5]), True))


def test_long_texts_are_cut_window_by_window(monkeypatch):
    monkeypatch.setattr(tk, "WINDOW", 64)
    library, encoder, rng = Tokenizer.from_file(PATH), tk.Encoder(PATH), random.Random(8)
    alphabet = ["a", "B", "7", ".", "'s", " ", " the", "\n", "\t", "é,", " ", "漢", "“q”", "-", "the", "ing", " 12"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(900))) for _ in range(60)] + ["x" * 500, " " * 300 + "y", "a b" * 400]
    ids, sizes = encoder.encode(texts)
    for text, part in zip(texts, np.split(ids, np.cumsum(sizes)[:-1])):
        assert part.tolist() == library.encode(text, add_special_tokens=False).ids + [0], repr(text)


def test_a_document_over_several_blocks(monkeypatch):
    monkeypatch.setattr(tk, "BLOCK", 700)
    rng, sink = np.random.default_rng(3), io.BytesIO()
    sizes = np.array([5, 2900, 1, 699, 0, 1400])
    ids = rng.integers(0, 50, sizes.sum()).astype(np.uint32)
    writer = tk.Writer(sink, tk.Code(tk.code_lengths(np.bincount(ids, minlength=50), 18)))
    writer.add(np.arange(6), sizes, ids)
    sink.seek(0)
    found = list(tk.read_documents(sink, whole=True))
    parts = np.split(ids, np.cumsum(sizes)[:-1])
    assert [f[0] for f in found if f[1]] == [0, 1, 2, 3, 5]
    for place, n, crc, own in found:
        if n:
            assert (n, crc) == (sizes[place], zlib.crc32(parts[place].astype("<u4").tobytes())) and own.tolist() == parts[place].tolist()

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sievework.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.tokenizer_paths()[0])


def check(pieces, rows, tokenizer, length=packing.LENGTH):
    """Pieces make up each document's ids, once; sequences are full but for the last one."""
    wanted = {}
    for key, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]
        wanted.setdefault(str(key), []).append(np.array(ids, "<u4"))
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
        ids = [d for d in wanted[str(p.doc_id)] if len(d) == p.doc_tokens]
        assert any(zlib.crc32(d[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for d in ids)
    for number, parts in sequences.items():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at and size > 0
            at += size
        assert at == length or number == max(sequences)
    assert sum(p.length for p in pieces) == sum(len(d) for docs in wanted.values() for d in docs)
    for key, docs in wanted.items():
        starts = sorted((p.start, p.length) for p in pieces if str(p.doc_id) == key)
        assert sum(1 for s, _ in starts if s == 0) == len(docs)


@pytest.mark.parametrize("per_range", [2, 1000])
def test_edge_rows(edge_docs, edge_rows, tokenizer, per_range):
    pieces = packing.pack(edge_docs, rows_per_range=per_range).collect()
    check(pieces, [(r[0], r[1]) for r in edge_rows], tokenizer)


def test_no_documents(empty_docs):
    assert packing.pack(empty_docs).count() == 0


def test_equal_documents_are_spread_over_ranges(spark, tokenizer):
    rows = [(i, "the same words again and again") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    pieces = packing.pack(docs, length=64, rows_per_range=40).collect()
    check(pieces, rows, tokenizer, 64)


def test_ids_are_those_of_the_library(tokenizer):
    rng = random.Random(2)
    stock = [" ", "\n", "\t", "  ", "a", "Z", "9", "'s", "é", "日", "<|endoftext|>", "<", "!", "\r", "\x1c", "\x85", " ", " the", "̀"]
    texts = ["".join(rng.choice(stock) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["x" * 5000, "é" * 3000 + " y", "", " ", "\n\n"]
    stream, offsets = packing.Encoder(packing.tokenizer_paths()).encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert stream[offsets[i] : offsets[i + 1]].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, packing.END_ID]


def test_long_stretches_of_one_kind(spark, tokenizer):
    rows = [(i, f"a{mark * 2_000_000}b c") for i, mark in enumerate([" ", "\n", "\t", "x", "é", "7", "-"])]
    rows += [(9, " " * 5_000_000), (10, "word  \n" * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    check(packing.pack(docs).collect(), rows, tokenizer)


@pytest.mark.parametrize("dimensions, bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_each_cell_once_by_neighbours(dimensions, bits):
    side = 1 << bits
    grid = np.stack(np.meshgrid(*[np.arange(side)] * dimensions), -1).reshape(-1, dimensions)
    keys = packing.hilbert(grid, bits)
    assert sorted(keys.tolist()) == list(range(side**dimensions))
    steps = np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_neighbours_on_the_curve_are_alike(spark, tokenizer):
    rng = random.Random(3)
    kinds = [[f"{chr(97 + k)}{i}" for i in range(30)] for k in range(4)]
    rows = [(i, " ".join(rng.choice(kinds[i % 4]) for _ in range(200))) for i in range(80)]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    order = [p.doc_id % 4 for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)) if p.start == 0]
    assert sum(a == b for a, b in zip(order, order[1:])) > 40

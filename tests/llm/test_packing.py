"""Packing: every id in exactly one piece, and little padding."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from aerolag.llm import catalog, packing
from aerolag.llm.common import table, tokenizer_path
from tests.llm.helpers import frame

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    return lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]


def verify(rows, docs, plain):
    """docs: (id, text). Rows of documents with the same id must be alike."""
    ids = {i: np.array(plain(t), "<u4") for i, t in docs}
    starts, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        piece = ids[r.doc_id][r.start:r.start + r.length]
        assert len(piece) == r.length > 0 and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(piece.tobytes())
        starts[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i in ids:
        times = sum(d == i for d, _ in docs)
        whole = sorted(starts[i])[::times]
        assert [s for s, _ in whole] == [sum(n for _, n in whole[:k]) for k in range(len(whole))]
        assert sum(n for _, n in whole) == len(ids[i]) and len(starts[i]) == times * len(whole)
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024
    return sequences


def test_query(spark, plain):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    sequences = verify(catalog.QUERIES["op2_cutting_stock_packing"](spark, SF).collect(), docs, plain)
    total = sum(n for p in sequences.values() for _, n in p)
    assert len(sequences) * 1024 <= total * 1.02


def test_awkward_rows(spark, plain):
    docs = [(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "null id"), (4, "<|endoftext|> é😀\u0000"),
            (5, "lorem ipsum " * 30_000), (6, " " * 5000), (7, "a" * 5000)]
    verify(packing.pack(frame(spark, docs)).collect(), docs, plain)
    assert packing.pack(frame(spark, [])).count() == 0
    rows = packing.sequences(frame(spark, docs)).collect()
    assert all(len(r.ids) == 1024 for r in rows)


def test_both_libraries_agree(spark, plain):
    path = tokenizer_path("byte_bpe_50k.json")
    tokenizer = packing.Tokenizer(path, tokenizer_path("byte_bpe_50k.tiktoken"), packing.marks(path))
    for r in table(spark, SF, "documents").collect():
        assert tokenizer.ids(r.text).tolist() == plain(r.text)[:-1] == tokenizer.plain(r.text).tolist()


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 5000), max_size=64))
def test_plan_holds_the_histogram(histogram):
    held = defaultdict(int)
    patterns = packing.plan(histogram, 64)
    for pattern, times in patterns:
        assert times > 0 and sum(c * n for c, n in pattern.items()) <= 64
        for c, n in pattern.items():
            held[c] += n * times
    assert dict(held) == histogram


@pytest.mark.parametrize("seed", range(3))
def test_plan_is_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    shares = rng.dirichlet(np.ones(256) * 0.3)
    shares[192:] /= 20
    histogram = {i + 1: int(n) for i, n in enumerate(shares / shares.sum() * 500_000) if int(n)}
    used = sum(n for _, n in packing.plan(histogram, 256))
    assert used <= 1.003 * sum(c * n for c, n in histogram.items()) / 256 + 3


def test_linear_program_improves_on_greedy():
    # thirds and halves: greedy fills with the longest first and wastes, the program does not
    sizes, demand = np.array([20, 34, 51, 60]), np.array([4000.0, 900.0, 700.0, 1100.0])
    greedy = packing.first_basis(sizes, demand, 100)[1].sum()
    used = sum(n for _, n in packing.fractional_patterns(sizes, demand, 100, gap=0.0))
    assert used <= greedy
    best, pattern = packing.price(sizes, np.array([0.2, 0.34, 0.51, 0.6]), 100)
    assert best == pytest.approx(1.0) and pattern @ sizes <= 100


def test_short_and_empty_texts_leave_little_padding(spark):
    docs = [(i, "" if i % 2 else "a b c d") for i in range(6000)]
    rows = packing.pack(frame(spark, docs)).collect()
    assert len(rows) == len(docs)
    sequences = defaultdict(int)
    for r in rows:
        sequences[r.sequence_id] += r.length
    assert max(sequences.values()) <= 1024
    assert len(sequences) * 1024 <= 1.02 * sum(sequences.values()) + 1024

"""Best-fit packing: every id in one piece, gapless windows, bounds against exhaustive search."""

import itertools
import zlib
from collections import defaultdict

import numpy as np
import pytest
from gridloom.llm import bestfit
from gridloom.llm.queries import tokenizer_path
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

WORDS = "the quick brown fox jumps over a lazy dog".split()
SCHEMA = "doc_id long, text string, row int, piece string"
ROWS = [
    (1, None, 1, "x"),
    (2, "", 1, "x"),
    (None, "no number", 1, "x"),
    (5, "same text", 1, "x"),
    (5, "same text", 1, "x"),
    (6, "the quick brown fox " * 4000, 1, None),
    (7, " ".join(["word"] * 127), None, "x"),
    *((100 + i, " ".join(WORDS[(i + k) % 9] for k in range(1 + i * 37 % 90)), i, "x") for i in range(80)),
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def ids(library, text, end=0):
    return np.array(library.encode(text or "", add_special_tokens=False).ids + [end], dtype="<u4")


def hold(got, rows, library, window):
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
    for doc_id in {r[0] for r in rows}:
        texts = [r[1] for r in rows if r[0] == doc_id]
        want = ids(library, texts[0])
        head = want.size - (-(-want.size // window) - 1) * window
        shape = [(0, 0, head)] + [(k + 1, s, window) for k, s in enumerate(range(head, want.size, window))]
        own = sorted((r.piece, r.start, r.length) for r in pieces[doc_id])
        assert own == sorted(shape * len(texts))
        assert all(r.ids_crc32 == zlib.crc32(want[r.start : r.start + r.length].tobytes()) for r in pieces[doc_id])
    return len(sequences)


@pytest.mark.parametrize("partition_rows", [20_000, 7])
def test_every_id_lies_in_one_piece(spark, library, partition_rows):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    got = bestfit.best_fit_documents(docs, tokenizer_path(), window=64, partition_rows=partition_rows).collect()
    used = hold(got, ROWS, library, 64)
    total = sum(ids(library, r[1]).size for r in ROWS)
    assert used <= -(-total // 64) * 1.05 + 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    found = bestfit.best_fit_documents(docs, tokenizer_path())
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and found.count() == 0


def test_whole_query_is_within_one_of_its_bound(spark, library):
    from gridloom.llm.queries import op13_best_fit

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = op13_best_fit(spark, sf).collect()
    used = hold(got, rows, library, 2048)
    lengths = np.array([r.length for r in got])
    bound = bestfit.least_bins(np.bincount(lengths, minlength=2049), 2048)
    assert bound <= used <= bound + 1


def least_by_search(lengths, window):
    best = len(lengths)
    for perm in set(itertools.permutations(lengths)):
        used, room = 0, 0
        for x in perm:
            if x > room:
                used, room = used + 1, window
            room -= x
        best = min(best, used)
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=6))
def test_bounds_never_pass_the_optimum(lengths):
    bound = bestfit.least_bins(np.bincount(lengths, minlength=21), 20)
    bins, used = bestfit.best_fit(np.array(lengths), 20)
    assert bound <= least_by_search(lengths, 20) <= used
    assert np.bincount(bins, weights=lengths).max() <= 20 and set(bins) == set(range(used))


def test_bounds_beyond_the_sum():
    # three of 11 in windows of 20: the sum asks for two windows, the halves for three
    assert bestfit.least_bins(np.bincount([11, 11, 11], minlength=21), 20) == 3
    # seven lengths just above a third: two a window
    assert bestfit.least_bins(np.bincount([7] * 7, minlength=21), 20) == 4
    assert bestfit.least_bins(np.zeros(21, dtype=np.int64), 20) == 0


def test_a_round_never_adds_sequences(spark, library):
    docs = spark.createDataFrame([(i, " ".join(["word"] * (21 + i % 3))) for i in range(60)], "doc_id long, text string")
    one = bestfit.best_fit_documents(docs, tokenizer_path(), window=64, partition_rows=8, rounds=1)
    more = bestfit.best_fit_documents(docs, tokenizer_path(), window=64, partition_rows=8, rounds=5)
    count = lambda df: df.select("sequence_id").distinct().count()
    assert count(more) <= count(one)

"""Token counts, packing and token files against the tokenizers library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from gridloom.llm import packing, token_files
from gridloom.llm.queries import tokenizer_path
from gridloom.llm.storage import new_folder
from gridloom.llm.token_counts import count_tokens
from tokenizers import Tokenizer

SCHEMA = "doc_id long, text string, n_tokens string, row int"
ROWS = [
    (3, "Hello  world\n\n it's 12 o'clock  ", "x", 1),
    (1, None, None, None),
    (2, "", "x", 2),
    (None, "no number", "x", 3),
    (5, "same text", "x", 4),
    (5, "same text", "x", 4),
    (6, "a<|endoftext|> b <|endoftext|>", "x", 5),
    (7, "the quick brown fox " * 4000, "x", 6),
    (8, "aaaaaaaaaaaaaaa\x1c\x1d  é🙂　中文", "x", 7),
    (9, "\n", "x", 7),
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def ids(library, text, end=None):
    found = library.encode(text or "", add_special_tokens=False).ids
    return np.array(found + ([end] if end is not None else []), dtype="<u4")


def test_counts_match_the_library(docs, library):
    got = count_tokens(docs, tokenizer_path()).collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert r.n_tokens == len(ids(library, r.text))
        assert r.n_bytes == len((r.text or "").encode())
        assert r.over_limit == (r.n_tokens > 1024)


def test_counts_of_an_empty_table(docs):
    assert count_tokens(docs.limit(0), tokenizer_path()).count() == 0


def test_every_id_lies_in_one_piece(docs, library):
    got = packing.pack_documents(docs, tokenizer_path(), window=64, end_id=1, bucket_rows=3).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length, r.sequence_length))
        pieces[r.doc_id].append(r)
    for parts in sequences.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64 and {p[2] for p in parts} == {at}
    for doc_id, text, *_ in ROWS:
        want = ids(library, text, 1)
        copies = sum(1 for r in ROWS if r[0] == doc_id)
        own = sorted(pieces[doc_id], key=lambda r: r.start)
        assert sum(r.length for r in own) == copies * want.size
        for r in own:
            assert r.doc_tokens == want.size
            assert r.ids_crc32 == zlib.crc32(want[r.start : r.start + r.length].tobytes())


def test_packing_an_empty_table(docs):
    assert packing.pack_documents(docs.limit(0), tokenizer_path()).count() == 0


def test_fill_is_the_best_subset():
    rng = np.random.default_rng(5)
    for _ in range(300):
        room = int(rng.integers(1, 40))
        counts = np.zeros(room + 2, dtype=np.int64)
        for length in rng.integers(1, room + 2, rng.integers(0, 7)):
            counts[length] += 1
        sums = {0}
        for length in np.repeat(np.arange(room + 2), counts):
            sums |= {s + int(length) for s in sums if s + length <= room}
        chosen = packing.fill(counts, room)
        assert sum(chosen) == max(sums)
        assert all(chosen.count(x) <= counts[x] for x in chosen)


def test_packing_leaves_little_padding():
    lengths = np.random.default_rng(1).integers(1, 2048, 20_000)
    windows = packing.pack_lengths(lengths, 2048)
    assert sorted(i for w in windows for i in w) == list(range(20_000))
    # no two lengths above half a window fit together
    least = max(lengths.sum() / 2048, (lengths > 1024).sum())
    assert len(windows) <= least * 1.01


def test_token_files_round_trip(docs, library):
    got = token_files.token_file_digest(docs, tokenizer_path(), length=16, end_id=2).collect()
    want, start = [], 0
    for doc_id, text, *_ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)):
        x = ids(library, text, 2)
        want.append((doc_id, start, x.size, zlib.crc32(x.tobytes())))
        start += x.size
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_token_files_have_fixed_sequences(spark, docs):
    manifest = token_files.write_token_files(docs, tokenizer_path(), new_folder(spark, "t"), length=16)
    for row in manifest.collect():
        batches = list(token_files._opened(f"{row.path}.ids"))
        real = sum(int(np.asarray(b.column(1).flatten()).sum()) for b in batches)
        assert real == row.tokens
        assert all(b.column(0).type.list_size == 16 for b in batches)


def test_token_files_of_an_empty_table(docs):
    assert token_files.token_file_digest(docs.limit(0), tokenizer_path()).count() == 0


def test_sequences_are_found_by_their_number(spark, docs):
    manifest = token_files.write_token_files(docs, tokenizer_path(), new_folder(spark, "t"), length=16, shards=2)
    wanted, want = [], {}
    for row in manifest.collect():
        whole = [x for b in token_files._opened(f"{row.path}.ids") for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        shard = token_files.ShardSequences(row.path)
        for k in random.Random(1).sample(range(len(whole)), min(40, len(whole))) + [len(whole) - 1]:
            ids, n = shard[k]
            assert (ids.tolist(), n) == (whole[k][0], sum(whole[k][1]))
            want[row.path, k] = (whole[k][0], sum(whole[k][1]))
            wanted.append((row.path, k))
        for k in (-1, len(whole), len(whole) + 5000):
            with pytest.raises(IndexError):
                shard[k]
        wanted += [(row.path, len(whole)), (row.path, None), (None, 0)]
    got = token_files.read_sequences(spark.createDataFrame(wanted, "path string, sequence long")).collect()
    assert {(r.path, r.sequence): (r.ids, r.n_ids) for r in got} == want and len(got) == sum(w in want for w in wanted)


def test_sequences_of_many_batches(tmp_path):
    writer = token_files.ShardWriter(f"file://{tmp_path}", 8, True, rows_per_batch=4)
    flat = np.arange(1001, dtype=np.uint16)
    for k in range(0, 1001, 77):
        part = flat[k : k + 77]
        writer.add(pa.array([k]), part, np.array([part.size]))
    writer.close()
    shard = token_files.ShardSequences(writer.path)
    for k in (125, 0, 77, 124, 3, 4):
        ids, n = shard[k]
        assert ids[:n].tolist() == flat[k * 8 : k * 8 + 8].tolist() and n == min(8, 1001 - k * 8)
    with pytest.raises(IndexError):
        shard[126]


def test_shards_grow_in_number_with_the_text(docs, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_BYTES", 1000)
    ids = sorted((r.doc_id or 0, r.start, r.n_tokens, r.ids_crc32) for r in token_files.token_file_digest(docs, tokenizer_path(), length=16).collect())
    monkeypatch.setattr(token_files, "SHARD_BYTES", 1 << 30)
    assert ids == sorted((r.doc_id or 0, r.start, r.n_tokens, r.ids_crc32) for r in token_files.token_file_digest(docs, tokenizer_path(), length=16).collect())


def test_encoder_gives_memory_back():
    """What Arrow took for the words of a batch does not stay with the worker."""

    def held() -> int:
        lines = open("/proc/self/smaps_rollup").read().splitlines()
        return sum(int(line.split()[1]) for line in lines if line.startswith("Pss_Anon")) // 1024

    texts = pa.array([" ".join(f"w{k % 5000}" for k in range(i, i + 2000)) for i in range(2000)])
    tool = packing.encoder(tokenizer_path())
    tool.encode_flat(texts)
    before = held()
    pa.default_memory_pool().release_unused()
    assert before - held() < 16

"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a seed (a run of ``least`` words) are
tiled: the longest match of words that neither side has used yet is marked again
and again, until none of ``least`` words is left.  The share of the item's words under
tiles is its coverage, which does not depend on the order of the passages.

Windows of words are compared by Karp-Rabin fingerprints, so matches are runs of
equal fingerprints along one diagonal.  The benchmark is a stated query set: it goes
to the tasks in blocks of bounded size, each of which is held against all documents.

Words are parted at white space and marks of any script; where a script writes no
spaces, every character is a word.  An item of fewer than ``least`` words has no seed:
it is found where its whole sequence of words stands in a document.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.words import mix, word_hashes

_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Scripts without spaces between words: Thai, Lao, Myanmar, Khmer, Tai, kana, ideographs, Yi.
_ALONE = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u1950-\u19df\u1a20-\u1aaf\u3005-\u3007\u3031-\u3035\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\ua000-\ua4cf\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")


def _marks(low: int, high: int) -> re.Pattern:
    """White space and punctuation in a range of characters, and the space of no width."""
    return re.compile("[" + "".join(re.escape(chr(c)) for c in range(low, high) if c == 0x200B or unicodedata.category(chr(c))[0] in "PZ") + "]")


#: Marks beyond ASCII; a set that reaches past U+FFFF is searched far slower, so those are apart.
_PARTING, _PARTING_FAR, _FAR = _marks(0x80, 0x10000), _marks(0x10000, 0x20000), re.compile("[\U00010000-\U0001ffff]")
HITS = "doc_id long, item_id long, coverage double, n_tiles long, longest_tile long"


def plain_words(text: str | None) -> np.ndarray:
    """One hash per word, or per character of a script without spaces."""
    if text and not text.isascii():
        text = _PARTING.sub(" ", text)
        if _FAR.search(text):
            text = _PARTING_FAR.sub(" ", text)
        text = _ALONE.sub(r" \g<0> ", text)
    return word_hashes(text, plain=True)


def fingerprints(words: np.ndarray, least: int) -> np.ndarray:
    """Karp-Rabin fingerprints of all windows of ``least`` words."""
    n = words.size - least + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(least):
        out = out * _BASE + words[k : k + n]
    return mix(out)


def tile(item: np.ndarray, doc_at: np.ndarray, item_at: np.ndarray, least: int) -> list[int]:
    """Lengths of the tiles of an item, from the seeds (place in the document, place in the item)."""
    tiles: list[int] = []
    while doc_at.size:
        order = np.lexsort((doc_at, doc_at - item_at))
        doc_at, item_at = doc_at[order], item_at[order]
        run = np.append(True, (np.diff(doc_at) != 1) | (np.diff(item_at) != 1))
        first = np.flatnonzero(run)
        lengths = np.diff(np.append(first, doc_at.size)) + least - 1
        # the longest match; of several, the one that comes first in item and document
        best = np.lexsort((doc_at[first], item_at[first], -lengths))[0]
        d, i, n = doc_at[first[best]], item_at[first[best]], lengths[best]
        tiles.append(int(n))
        free = ((doc_at + least <= d) | (doc_at >= d + n)) & ((item_at + least <= i) | (item_at >= i + n))
        doc_at, item_at = doc_at[free], item_at[free]
    return tiles


class _Prints:
    """Sorted fingerprints of windows of ``size`` words, each with its item and its place there."""

    def __init__(self, found: list[tuple[int, np.ndarray]], size: int):
        self.size = size
        prints = np.concatenate([p for _, p in found]) if found else np.empty(0, dtype=np.uint64)
        order = np.argsort(prints, kind="stable")
        self.prints = prints[order]
        self.owner = np.concatenate([np.full(p.size, k) for k, p in found])[order] if found else np.empty(0, dtype=np.int64)
        self.place = np.concatenate([np.arange(p.size) for _, p in found])[order] if found else np.empty(0, dtype=np.int64)

    def seeds(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the document, item, place in the item) of all windows that are shared."""
        seeds = fingerprints(words, self.size)
        low = np.searchsorted(self.prints, seeds, side="left")
        at = np.flatnonzero(low < self.prints.size)
        at = at[self.prints[low[at]] == seeds[at]]
        low = low[at]
        n = np.searchsorted(self.prints, seeds[at], side="right") - low
        rows = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.repeat(at, n), self.owner[rows], self.place[rows]


class Benchmark:
    """A block of benchmark items, ready to be held against documents."""

    def __init__(self, items: list[tuple[int, str]], least: int):
        self.least = least
        self.ids, self.sizes = [], []
        found: dict[int, list[tuple[int, np.ndarray]]] = {}
        for item_id, text in items:
            words = plain_words(text)
            if not words.size:
                continue
            size = min(least, int(words.size))
            found.setdefault(size, []).append((len(self.ids), fingerprints(words, size)))
            self.ids.append(item_id)
            self.sizes.append(int(words.size))
        self.long = _Prints(found.pop(least, []), least)
        self.short = [_Prints(f, n) for n, f in sorted(found.items())]

    def hits(self, text: str | None) -> Iterator[tuple[int, float, int, int]]:
        """(item_id, coverage, tiles, longest tile) of every item that shares a seed with a text, or is short and whole in it."""
        words = plain_words(text)
        doc_at, owner, item_at = self.long.seeds(words)
        for k in np.unique(owner):
            own = owner == k
            tiles = tile(np.empty(0), doc_at[own], item_at[own], self.least)
            yield self.ids[k], sum(tiles) / self.sizes[k], len(tiles), max(tiles)
        for prints in self.short:
            for k in np.unique(prints.seeds(words)[1]):
                yield self.ids[k], 1.0, 1, prints.size


def benchmark_blocks(benchmark: DataFrame, least: int, block_mb: int, id_col: str, text_col: str) -> Iterator[Benchmark]:
    """The items, dealt to blocks of at most about ``block_mb`` of text by a hash of the item."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // (block_mb << 20)) or 1
    for k in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        yield Benchmark(sorted((r.item_id, r.text) for r in part), least)


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, least: int = 5, threshold: float = 0.5, block_mb: int = 16,
    id_col: str = "item_id", text_col: str = "text", passage: int = 30,
) -> DataFrame:
    """doc_id, item_id, coverage, n_tiles and longest_tile where coverage reaches the threshold, or a tile has ``passage`` words.

    Items of fewer than ``least`` words are found whole, with coverage 1.  Null texts
    and texts without a word match nothing; repeated documents are reported again; a null doc_id stays null.  No documents or
    no items: no rows.  No shuffle of documents.
    """
    found = None
    for block in benchmark_blocks(benchmark, least, block_mb, id_col, text_col):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(d, *h) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()) for h in held.value.hits(t) if h[1] >= threshold or h[3] >= passage]
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                names = ["doc_id", "item_id", "coverage", "n_tiles", "longest_tile"]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

        some = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(search, HITS)
        found = some if found is None else found.unionByName(some)
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least: int = 5, threshold: float = 0.5, block_mb: int = 16, passage: int = 30) -> DataFrame:
    """``docs`` without the documents that cover an item of the benchmark or quote ``passage`` words of it; columns as they are."""
    for block in benchmark_blocks(benchmark, least, block_mb, "item_id", "text"):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def keep(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [all(h[1] < threshold and h[3] < passage for h in held.value.hits(t)) for t in batch.column("text").to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs

"""Phrases whose words stand together more often than apart.

The first pass counts n-grams by hash in every run of text and deals the counts to
hash partitions, whose number grows with the text.  A partition merges what it gets
into a Misra-Gries summary with more counters than the partition's mass over the least
frequency, so an n-gram of that frequency always keeps a counter.  The second pass
counts the n-grams that are left exactly, by their words, and scores them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.storage import materialize, scratch
from gridloom.llm.words import mix

#: What parts pieces (2) and words (1).
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(20240611).integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Bytes of text that are hashed at once, and that are counted together.
_CHUNK, _RUN = 512 << 10, 3 << 20
#: n-grams in a hash partition, and counters over the least number of a summary.
_MASS, _SLACK = 2_000_000, 4
#: Bytes of an n-gram's mark in its partition.
_MARK = 5
#: Bits of the filter for each key, at most (128 MB; beyond that it lets more through, which are counted in vain), and in a row of ``bitmap_construct_agg``.
_FILTER_BITS, _MOST_SLOTS, _ROW_BITS = 16, 1 << 30, 1 << 15

_SUMMARIES = T.StructType(
    [
        T.StructField("part", T.LongType()),
        T.StructField("mass", T.LongType()),
        T.StructField("ones", T.BinaryType()),
        T.StructField("more", T.BinaryType()),
        T.StructField("times", T.BinaryType()),
    ]
)
_KEYS = T.StructType([T.StructField("key", T.LongType())])
_COUNTS = T.StructType(
    [
        T.StructField("key", T.LongType()),
        T.StructField("lang", T.StringType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("phrase", T.StringType()),
        T.StructField("times", T.LongType()),
    ]
)


def _slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """First and last row of runs of about ``most`` bytes; a longer text is a run of its own."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + most, side="right")))
        yield first, last
        first = last


def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1 ... of every run, one run after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if ends.size else 0)


class Run:
    """The words of some texts: where they stand, their piece and text, and two hashes of each."""

    def __init__(self, texts: pa.Array, seeds: np.ndarray, second: bool):
        parts = [self._chunk(texts.slice(x, y - x), second) for x, y in _slices(texts, _CHUNK)]
        raw, starts, sizes, piece, doc, *hashes = zip(*parts)
        before = np.cumsum([0, *(r.size for r in raw)])
        #: all bytes in lower case, with a space behind
        self.raw = np.concatenate([*raw, np.array([0x20], dtype=np.uint8)])
        self.starts = np.concatenate([s + b for s, b in zip(starts, before)])
        self.sizes = np.concatenate(sizes)
        # a text ends its last piece, so numbers of pieces may go on from chunk to chunk
        pieces = np.cumsum([0, *(int(p[-1]) + 1 if p.size else 0 for p in piece)])
        self.piece = np.concatenate([p + b for p, b in zip(piece, pieces)])
        rows = np.cumsum([0, *(y - x for x, y in _slices(texts, _CHUNK))])
        self.doc = np.concatenate([d + b for d, b in zip(doc, rows)])
        self.hashes = [np.concatenate(h) for h in hashes]
        self.seed = seeds[self.doc]

    @staticmethod
    def _chunk(texts: pa.Array, second: bool) -> tuple[np.ndarray, ...]:
        marked = pc.binary_join_element_wise(texts, pa.scalar("", texts.type), pa.scalar("\n", texts.type)).cast(pa.large_string())
        _, ends, data = marked.buffers()
        ends = np.frombuffer(ends, dtype=np.int64)[marked.offset : marked.offset + len(marked) + 1]
        raw = _LOWER[np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]]]
        kind = _KIND[raw]
        inside = np.concatenate(([False], kind == 0))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        # every text ends in a break, so the last word has ended
        starts, sizes = edges[0::2], edges[1::2] - edges[0::2]
        piece = np.searchsorted(np.flatnonzero(kind == 2), starts)
        doc = np.searchsorted(ends[1:] - ends[0], starts, side="right")
        hashes = []
        if starts.size:
            kept = _places(starts, sizes)
            first = np.cumsum(sizes) - sizes
            power = np.cumprod(np.full(int(sizes.max()), _ODD, dtype=np.uint64))[np.arange(kept.size) - np.repeat(first, sizes)]
            letters = raw[kept]
            for table in _BYTES[: 1 + second]:
                hashes.append(mix(np.add.reduceat(table[letters] * power, first) + sizes.astype(np.uint64)))
        else:
            hashes = [np.empty(0, dtype=np.uint64)] * (1 + second)
        return raw, starts, sizes, piece, doc, *hashes

    def grams(self, longest: int, which: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each size up to ``longest``: the places of n-grams in a piece, and the hashes of language and words."""
        word = self.hashes[which]
        value = mix(word ^ self.seed)
        for size in range(1, longest + 1):
            if size > 1:
                value = mix(value[:-1] * _ODD + word[size - 1 :])
            at = np.flatnonzero(self.piece[: value.size] == self.piece[size - 1 :]) if size > 1 else np.arange(value.size)
            yield size, at, value[at]

    def phrases(self, at: np.ndarray, size: int) -> pa.Array:
        """The words at these places, joined by spaces."""
        words = at[:, None] + np.arange(size)
        starts = np.full((at.size, 2 * size - 1), self.raw.size - 1)
        sizes = np.ones_like(starts)
        starts[:, ::2], sizes[:, ::2] = self.starts[words], self.sizes[words]
        data = self.raw[_places(starts.ravel(), sizes.ravel())]
        ends = np.append(0, np.cumsum(sizes.sum(axis=1)))
        return pa.LargeStringArray.from_buffers(at.size, pa.py_buffer(ends), pa.py_buffer(data.tobytes())).cast(pa.string())


def _runs(batches: Iterator[pa.RecordBatch], second: bool) -> Iterator[tuple[Run, pa.Array]]:
    for batch in batches:
        texts, langs = batch.column("text"), batch.column("lang").dictionary_encode()
        names = langs.dictionary.to_pylist()
        seed = np.array([int.from_bytes(hashlib.blake2b(n.encode(), digest_size=8).digest(), "little") for n in names], dtype=np.uint64)
        seeds = seed[langs.indices.to_numpy()]
        for first, last in _slices(texts, _RUN):
            part = slice(first, last)
            yield Run(texts.slice(first, last - first), seeds[part], second), batch.column("lang").slice(first, last - first)


def _marks(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_MARK]).tobytes()


def _numbers(marks: bytes) -> np.ndarray:
    wide = np.zeros((len(marks) // _MARK, 8), dtype=np.uint8)
    wide[:, :_MARK] = np.frombuffer(marks, dtype=np.uint8).reshape(-1, _MARK)
    return wide.view("<u8").ravel()


def _added(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of each."""
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if keys.size else np.empty(0, dtype=np.int64)
    return keys[first], np.add.reduceat(times, first) if keys.size else times


class Summary:
    """A Misra-Gries summary: at most ``capacity`` counters, each too low by at most ``lost``.

    Merging adds counters; when too many are left, all are lowered by the first one
    beyond the capacity.  ``lost`` stays below the whole mass over ``capacity``.
    """

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.times = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)

    def merge(self, keys: np.ndarray, times: np.ndarray) -> None:
        self.keys, self.times = _added(np.concatenate((self.keys, keys)), np.concatenate((self.times, times)))
        if self.keys.size > self.capacity:
            beyond = self.keys.size - self.capacity - 1
            least = int(np.partition(self.times, beyond)[beyond])
            self.lost += least
            left = self.times > least
            self.keys, self.times = self.keys[left], self.times[left] - least

    def reaching(self, least: int) -> np.ndarray:
        """Every key whose true frequency may be ``least`` or more."""
        return self.keys[self.times >= least - self.lost]


def _summaries(docs: DataFrame, longest: int, bits: int, mark_bits: int) -> DataFrame:
    """Counts of the n-grams of each run of texts, in the hash partitions of their first ``bits`` bits."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run, _ in _runs(batches, second=False):
            found = np.sort(np.concatenate([g for _, _, g in run.grams(longest)])) >> np.uint64(64 - bits - mark_bits)
            if not found.size:
                continue
            first = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
            times = np.diff(np.append(first, found.size))
            part, mark = found[first] >> np.uint64(mark_bits), found[first] & np.uint64((1 << mark_bits) - 1)
            begin = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            rows = []
            for x, y in zip(begin.tolist(), [*begin[1:].tolist(), part.size]):
                once = times[x:y] == 1
                more = times[x:y][~once]
                rows.append((int(part[x]), int(times[x:y].sum()), _marks(mark[x:y][once]), _marks(mark[x:y][~once]), more.astype("<i8").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), *[pa.binary()] * 3))], _SUMMARIES.names)

    return docs.mapInArrow(count, _SUMMARIES)


def _survivors(summaries: DataFrame, least: int, mark_bits: int) -> DataFrame:
    """Keys of all n-grams that may reach ``least`` occurrences."""

    def merge(table: pa.Table) -> pa.Table:
        part, mass = table.column("part")[0].as_py(), pc.sum(table.column("mass")).as_py()
        summary = Summary(_SLACK * mass // least + 1)
        keys, times, held = [], [], 0
        for ones, more, many in zip(*(table.column(c).to_pylist() for c in ("ones", "more", "times"))):
            once, often = _numbers(ones), _numbers(more)
            keys += [once, often]
            times += [np.ones(once.size, dtype=np.int64), np.frombuffer(many, dtype="<i8")]
            held += once.size + often.size
            if held > summary.capacity:
                summary.merge(np.concatenate(keys), np.concatenate(times))
                keys, times, held = [], [], 0
        if held:
            summary.merge(np.concatenate(keys), np.concatenate(times))
        return pa.table([pa.array((part << mark_bits) + summary.reaching(least).astype(np.int64), pa.int64())], names=["key"])

    return summaries.groupBy("part").applyInArrow(merge, _KEYS)


def _told_apart(key: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place and the number of every pair of hashes."""
    order = np.argsort(key, kind="stable")
    if not order.size:
        return order, order
    new = np.append(True, key[order][1:] != key[order][:-1])
    begin = np.flatnonzero(new)
    times = np.diff(np.append(begin, order.size))
    if (other[order] != np.repeat(other[order[begin]], times)).any():
        # one key stands for several n-grams
        order = np.lexsort((other, key))
        new = np.append(True, (key[order][1:] != key[order][:-1]) | (other[order][1:] != other[order][:-1]))
        begin = np.flatnonzero(new)
        times = np.diff(np.append(begin, order.size))
    return order[begin], times


class Known:
    """The sorted keys to count."""

    def __init__(self, keys: DataFrame):
        found = np.sort(keys.toArrow().column("key").to_numpy()).astype(np.int64)
        self.held = keys.sparkSession.sparkContext.broadcast(found.tobytes())

    def places(self, key: np.ndarray) -> np.ndarray:
        keys = np.frombuffer(self.held.value, dtype=np.int64)
        if not keys.size:
            return np.empty(0, dtype=np.int64)
        return np.flatnonzero(keys[np.minimum(np.searchsorted(keys, key), keys.size - 1)] == key)


class Filter:
    """A bitmap over the last bits of the keys, which are those of a hash: it drops no key, but lets some others through."""

    def __init__(self, keys: DataFrame, count: int):
        self.slots = min(_MOST_SLOTS, max(_ROW_BITS, 1 << (count * _FILTER_BITS - 1).bit_length()))
        # numbers from 1 on have buckets from 1 on
        place = F.col("key").bitwiseAND(F.lit(self.slots - 1)) + 1
        parts = keys.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        filled = np.zeros((self.slots // _ROW_BITS, _ROW_BITS // 8), dtype=np.uint8)
        for row in parts.toLocalIterator():
            filled[row.part - 1] = np.frombuffer(bytes(row.bits), dtype=np.uint8)
        self.held = keys.sparkSession.sparkContext.broadcast(filled.tobytes())

    def places(self, key: np.ndarray) -> np.ndarray:
        place = key & (self.slots - 1)
        return np.flatnonzero(np.frombuffer(self.held.value, dtype=np.uint8)[place >> 3] >> (place & 7).astype(np.uint8) & 1)


def _counted(docs: DataFrame, longest: int, key_bits: int, known: Known | Filter) -> DataFrame:
    """Exact counts of the n-grams of each run of texts that are ``known``, with their words; size 0 has the number of words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run, langs in _runs(batches, second=True):
            words = np.bincount(run.doc, minlength=len(langs))
            totals = pa.table([langs, pa.array(words, pa.int64())], names=["lang", "times"]).group_by("lang").aggregate([("times", "sum")])
            n = len(totals)
            names = totals.column("lang").combine_chunks().cast(pa.string())
            yield _batch(pa.nulls(n, pa.int64()), names, 0, pa.array([""] * n), totals.column("times_sum").combine_chunks())
            for (size, at, found), (_, _, other) in zip(run.grams(longest), run.grams(longest, 1)):
                key = (found >> np.uint64(64 - key_bits)).astype(np.int64)
                hit = known.places(key)
                at, key, other = at[hit], key[hit], other[hit]
                first, times = _told_apart(key, other)
                if first.size:
                    places = at[first]
                    yield _batch(
                        pa.array(key[first]),
                        langs.take(pa.array(run.doc[places])).cast(pa.string()),
                        size,
                        run.phrases(places, size),
                        pa.array(times, pa.int64()),
                    )

    return docs.mapInArrow(count, _COUNTS)


def _batch(key: pa.Array, lang: pa.Array, size: int, phrase: pa.Array, times: pa.Array) -> pa.RecordBatch:
    sizes = pa.array(np.full(len(key), size, dtype=np.int32))
    return pa.RecordBatch.from_arrays([key, lang, sizes, phrase, times], _COUNTS.names)


def frequent_ngrams(docs: DataFrame, longest: int = 3, least: int = 10, most_keys: int = 4_000_000) -> DataFrame:
    """lang, size, phrase and times of every n-gram of up to ``longest`` words with ``least`` occurrences or more in its language.

    Size 0 has the number of words of each language.  Up to ``most_keys`` keys of
    eight bytes are sent to the tasks; of more, a bitmap of some bits a key: what it lets
    through besides is counted as exactly, and dropped by its count.
    """
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # a word and what parts it from the next take six bytes or so
    bits = max(1, int(size / 6 * longest / _MASS).bit_length())
    mark_bits = min(8 * _MARK, 62 - bits)
    # summaries go straight to their partitions, and their shuffle is gone before n-grams are counted
    with scratch(docs.sparkSession, "phrases") as keep:
        keys = keep(_survivors(_summaries(texts, longest, bits, mark_bits), least, mark_bits), "keys")
        count = keys.count()
        known = Known(keys) if count <= most_keys else Filter(keys, count)
    counted = _counted(texts, longest, bits + mark_bits, known)
    added = counted.groupBy("lang", "size", "phrase").agg(F.sum("times").alias("times"))
    return materialize(added.where((F.col("size") == 0) | (F.col("times") >= least)), "phrases-counts")


def _part(first: int | str, count: int | str):
    return F.expr(f"concat_ws(' ', slice(words, {first}, {count}))")


def mine_collocations(
    docs: DataFrame, longest: int = 3, least: int = 10, top: int = 2000, scale: int = 1_000_000, covered: int = 50, most_keys: int = 4_000_000
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n and score.

    ``docs`` has text and lang.  A-Z are lower-cased; marks ``.,;:!?`` and line ends
    part pieces, blanks and tabs part words; a phrase has 2 to ``longest`` words of
    one piece and ``least`` occurrences or more, overlaps included.  a is its
    frequency; l and r are those of the two parts of the cut with the lowest score
    floor(``scale`` * a * a / (l * r)), the earliest one of equals; n counts the words of the
    language.  Phrases inside a longer candidate with ``covered`` percent of their
    occurrences or more are left out.  Ranks go by score, a (both descending) and phrase.

    A null text is empty, a null lang is ``und``; repeated rows count as often as they
    stand; other columns are not read; texts without words add nothing; an empty
    table gives no rows.  ``longest`` is 2 or more; frequencies stay below 10^16.
    """
    counts = frequent_ngrams(docs, longest, least, most_keys)
    held = counts.where("size > 0").select("lang", "phrase", "times")
    found = counts.where("size > 1").select("lang", "phrase", "size", F.col("times").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = found.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "size", "a", "k", _part(1, "k").alias("left"), _part("k + 1", "size - k").alias("right"))
    left = held.select("lang", F.col("phrase").alias("left"), F.col("times").alias("l"))
    right = held.select("lang", F.col("phrase").alias("right"), F.col("times").alias("r"))
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    wide = "cast({} as decimal(16,0))".format
    score = F.expr(f"({wide('a')} * {wide('a')} * cast({scale} as decimal(7,0))) div ({wide('l')} * {wide('r')})")
    low = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("low")
    scored = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), low)
    # what the longer candidates hold
    inner = found.where("size > 2").select("*", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("take"))
    inner = inner.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("take") + 1)).alias("first"))
    inner = inner.select("lang", _part("first", "take").alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(inner, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a")))
    kept = kept.select("lang", "phrase", "a", "low.l", "low.r", "low.score")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = kept.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    words = counts.where("size = 0").select("lang", F.col("times").alias("n"))
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

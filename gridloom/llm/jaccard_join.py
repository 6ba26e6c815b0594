"""Jaccard self-join of documents over word shingles by rare shingles and parity sketches.

Two sets of similarity t share at least t * n elements, n the size of the larger one.  So
of each set, all but t * n of its elements, and one more, hold a common one, whatever
order all sets are put in.  Shingles are counted in slots of a hash table first, and a
set's keys are its rarest: passages of many documents are keys of a set only if it has
little else, so few keys are shared but by copies.

Sizes are banded so that both sides of a pair can be compared in one band, and an equi-join on
(band, shingle) finds every pair that can reach the similarity.

The shingles of a document are also dealt to blocks by a hash; a block is a bit field
in which every shingle flips one bit.  Shingles that two documents share cancel,
so the number of blocks (as of bits) in which their sketches differ is at most the
size of the symmetric difference of their sets.  Pairs whose sketches differ in more
than their sizes allow are dropped before any set is read.

Groups of documents that share a key may be large, so their pairs are never
written out.  Equal sets are one class from the start.  A few blocks of every set link
most near copies first: each class is checked against the smallest it meets.  Then the
rare shingles are joined, a part of the key space at a time, and only keys whose classes are
not yet in one component are kept.  Keys of a few classes give pairs.  Keys of many classes,
of sets that consist of passages of many documents, are compared sketch by sketch
in blocks of bounded size, and only close pairs leave the task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.graph import components
from gridloom.llm.storage import materialize, scratch
from gridloom.llm.words import mix, shingle_hashes

#: Ratio of the bounds of neighbouring size bands.
_BAND = 1.4
#: One spare block for so many, and the share of blocks that weak ones may not use up.
_SPARE, _RESERVE = 4, 16
#: Bits of an id filter for each id, and at most (256 MB; beyond that it lets more through, and the join does the rest).
_FILTER_BITS, _MOST_SLOTS = 32, 1 << 31
#: Blocks of a band that are joined first.
_FIRST_BLOCKS = 6
#: Parts of the key space that are joined one after the other, for each key that a shingle has.
_ROUNDS = 12
#: Keys of more open classes are hot.
_HOT = 16
#: When more pairs than this would come of a key, its sketches are compared in blocks.
_MANY_PAIRS = 2048
#: Words of the short sketch that is compared before the long one.
_FOLD = 4
_SHORT = [f"f{k}" for k in range(_FOLD)]
#: Rows whose sets a worker holds at once.
_ROWS_AT_ONCE = 1000
#: Most rows of one side of such a block.
_BLOCK = 2048
#: Bytes of text for each slot in which shingles are counted, slots at least and at most, and slots in a row.
_SLOT_BYTES, _FEWEST_SLOTS, _MOST_COUNTED, _SLOT_ROW = 64, 1 << 16, 1 << 23, 1 << 13


def size_bands(similarity: Fraction, most: int = 1 << 32) -> tuple[np.ndarray, np.ndarray]:
    """Lower bounds of the size bands, and the number of blocks of each, spare ones among them.

    Sizes below the first bound can only link when their sets are equal.
    """
    lows, blocks, low = [], [], None
    step = (1 - similarity) / (1 + similarity)
    # the smallest size of the larger side that leaves room for one difference
    low = 1
    while 2 * low * step < 1:
        low += 1
    low = max(1, low - 1)
    while low < most:
        high = max(low + 1, int(low * _BAND))
        lows.append(low)
        most_apart = int(2 * (high - 1) * step)
        blocks.append(most_apart + 1 + (1 + most_apart // _SPARE if most_apart else 0))
        low = high
    return np.array(lows, dtype=np.int64), np.array(blocks, dtype=np.int64)


def sketch(shingles: np.ndarray, band: int, blocks: int) -> np.ndarray:
    """The parity bits of a set in the blocks of a band."""
    block = (shingles >> np.uint64(32)) % np.uint64(blocks)
    bit = np.uint64(1) << (shingles & np.uint64(63))
    order = np.argsort(block, kind="stable")
    block, bit = block[order], bit[order]
    first = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
    bits = np.zeros(blocks, dtype=np.uint64)
    bits[block[first].astype(np.int64)] = np.bitwise_xor.reduceat(bit, first)
    return bits


def fold(shingles: np.ndarray) -> np.ndarray:
    """A parity sketch of four words that is the same for all bands."""
    bits = np.zeros(_FOLD, dtype=np.uint64)
    np.bitwise_xor.at(bits, (shingles >> np.uint64(24)) % np.uint64(_FOLD), np.uint64(1) << (shingles >> np.uint64(8) & np.uint64(63)))
    return bits


def left_out(size: int, bits: np.ndarray, band: int, bands: tuple[np.ndarray, np.ndarray], similarity: Fraction) -> tuple[int, int, int]:
    """Which blocks of a set are no keys in a band: those with at most ``level`` bits.  (level, their number, blocks still to spare)

    A partner in the band has at most ``partner`` elements and the two differ in at
    most ``apart`` blocks, so they agree in all the others.  Blocks that agree have the
    same bits, so of those no more are weak than this set has weak ones.  Whatever level
    a partner takes, the reserve stays: no more hot keys than that can be spared besides.
    """
    lows, blocks = bands
    partner = int(size / similarity)
    if band + 1 < len(lows):
        partner = min(partner, int(lows[band + 1]) - 1)
    apart = int((size + partner) * (1 - similarity) / (1 + similarity))
    spare = int(blocks[band]) - apart - 1
    weak = np.cumsum(np.bincount(np.bitwise_count(bits)))
    reserve = bits.size // _RESERVE
    level = int(np.searchsorted(weak, spare - reserve, side="right")) - 1
    dropped = int(weak[level]) if level >= 0 else 0
    return level, dropped, min(reserve, spare - dropped)


def _room(total: Column, similarity: Fraction) -> Column:
    """The most elements in which two sets of together ``total`` elements differ if they link."""
    num, den = similarity.numerator, similarity.denominator
    return F.floor(total * (den - num) / F.lit(den + num) + 1e-9)


def _may_link(similarity: Fraction) -> Column:
    """Whether sizes and short sketches of ``u_`` and ``v_`` columns leave room for the similarity."""
    num, den = similarity.numerator, similarity.denominator
    low, high = F.least("u_n_shingles", "v_n_shingles"), F.greatest("u_n_shingles", "v_n_shingles")
    apart = sum((F.bit_count(F.col(f"u_{c}").bitwiseXOR(F.col(f"v_{c}"))) for c in _SHORT), F.lit(0))
    return (low * den >= high * num) & (apart <= _room(low + high, similarity))


def sketches_of(shingles: np.ndarray, bands: tuple[np.ndarray, np.ndarray], similarity: Fraction) -> tuple[int, list[np.ndarray], list[tuple[int, int, int]]]:
    """Own band; sketch there, and in the next band if a partner may lie there; what is left out in both."""
    lows, blocks = bands
    own = int(np.searchsorted(lows, shingles.size, side="right")) - 1
    parts, out = [np.empty(0, dtype=np.uint64)] * 2, [(-1, 0, 0)] * 2
    for k in range(2):
        band = own + k
        near = k == 0 or band < len(lows) and shingles.size >= similarity * int(lows[band])
        if shingles.size and band >= 0 and near and blocks[band] > 1:
            parts[k] = sketch(shingles, band, int(blocks[band]))
            out[k] = left_out(shingles.size, parts[k], band, bands, similarity)
    return own, parts, out


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum([p.size for p in parts], dtype=np.int64))).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _set_names(shingles: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit names of a set; 0 is the empty set's."""
    if not shingles.size:
        return 0, 0
    with np.errstate(over="ignore"):
        sums = np.array([np.add.reduce(mix(shingles)) ^ np.bitwise_xor.reduce(mix(shingles + np.uint64(1))), np.add.reduce(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)))])
    first, second = mix(sums).view(np.int64).tolist()
    return first or 1, second


def _in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shorter batches, as the sets of a long one take several times the room of its texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS_AT_ONCE):
            yield batch.slice(at, _ROWS_AT_ONCE)


def _slots(shingles: np.ndarray, slots: int) -> np.ndarray:
    return (shingles >> np.uint64(16) & np.uint64(slots - 1)).astype(np.int64)


def _counts(docs: DataFrame, width: int) -> Broadcast:
    """How many sets have a shingle of each slot, up to 65,535; the table does not grow beyond ``_MOST_COUNTED`` slots."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slots = min(_MOST_COUNTED, max(_FEWEST_SLOTS, 1 << (size // _SLOT_BYTES).bit_length()))
    schema = "part int, counts binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(slots, dtype=np.uint32)
        for batch in batches:
            for t in batch.column("text"):
                np.add.at(held, _slots(shingle_hashes(t.as_py(), width), slots), 1)
        rows = np.minimum(held, 255).astype(np.uint8).reshape(-1, _SLOT_ROW)
        some = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([rows[k].tobytes() for k in some], pa.binary())], ["part", "counts"])
        pa.default_memory_pool().release_unused()

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(_SLOT_ROW, dtype=np.uint32)
        for c in table.column("counts"):
            total += np.frombuffer(c.as_py(), dtype=np.uint8)
        return pa.table([table.column("part")[:1], pa.array([np.minimum(total, 65535).astype(np.uint16).tobytes()], pa.binary())], names=["part", "counts"])

    counts = np.zeros((slots // _SLOT_ROW, _SLOT_ROW), dtype=np.uint16)
    for row in docs.select("text").mapInArrow(count, schema).groupBy("part").applyInArrow(add, schema).collect():
        counts[row.part] = np.frombuffer(bytes(row.counts), dtype=np.uint16)
    return docs.sparkSession.sparkContext.broadcast(counts.ravel())


def rarest(shingles: np.ndarray, counts: np.ndarray, similarity: Fraction) -> np.ndarray:
    """The rarest elements of a set, 32 bits of each: as many as it may lack of a set that links with it, and one more."""
    take = shingles.size - -(-shingles.size * similarity.numerator // similarity.denominator) + 1
    order = np.lexsort((shingles, counts[_slots(shingles, counts.size)]))
    return shingles[order[:take]].astype(np.uint32).view(np.int32)


MADE = "doc_id long, uid long, n_shingles long, set_id long, check long, band int, bits array<long>, next_bits array<long>, f0 long, f1 long, f2 long, f3 long, level int, next_level int, rare array<int>"


def _sketches(docs: DataFrame, width: int, similarity: Fraction, counts: Broadcast) -> DataFrame:
    """doc_id, a number of the row, n_shingles, two names of the set, band, the sketches in that band and the next, and the rarest shingles."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = size_bands(similarity)
        for batch in _in_parts(batches):
            sets = [shingle_hashes(t.as_py(), width) for t in batch.column("text")]
            made = [sketches_of(s, bands, similarity) for s in sets]
            names = np.array([_set_names(s) for s in sets], dtype=np.int64).reshape(-1, 2)
            columns = [
                batch.column("doc_id"),
                batch.column("uid"),
                pa.array([s.size for s in sets], pa.int64()),
                pa.array(names[:, 0]),
                pa.array(names[:, 1]),
                pa.array([m[0] for m in made], pa.int32()),
                *(_lists([m[1][k] for m in made]) for k in range(2)),
                *(pa.array(c) for c in np.array([fold(s) for s in sets], dtype=np.uint64).reshape(-1, _FOLD).T.copy().view(np.int64)),
                *(pa.array([m[2][k][0] for m in made], pa.int32()) for k in range(2)),
                pa.array([rarest(s, counts.value, similarity) for s in sets], pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in MADE.split(", ")])
        # the worker lives on for other tasks
        pa.default_memory_pool().release_unused()

    return docs.select(F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("uid"), "text").mapInArrow(rows, MADE)


class IdFilter:
    """A bitmap over hashed ids; it lets some other ids through, but never drops one of its own.

    Spark builds it; it has ``_FILTER_BITS`` bits an id, and ``_MOST_SLOTS`` at most.
    """

    size = 4096

    def __init__(self, ids: DataFrame, column: str):
        self.slots = min(_MOST_SLOTS, max(1 << 20, 1 << (ids.count() * _FILTER_BITS).bit_length()))
        parts = (
            ids.groupBy(F.bitmap_bucket_number(self._slot(column)).alias("part"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(self._slot(column))).alias("bits"))
            .collect()
        )
        filled = np.zeros(self.slots // 8 + 2 * self.size, dtype=np.uint8)
        for row in parts:
            filled[row.part * self.size : (row.part + 1) * self.size] = np.frombuffer(bytes(row.bits), dtype=np.uint8)
        self.held = ids.sparkSession.sparkContext.broadcast(filled)

    def _slot(self, column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.slots))

    def columns(self, column: str) -> list[Column]:
        return [F.bitmap_bucket_number(self._slot(column)).alias("_part"), F.bitmap_bit_position(self._slot(column)).alias("_bit")]

    def hits(self, batch: pa.RecordBatch) -> np.ndarray:
        part, bit = batch.column("_part").to_numpy(), batch.column("_bit").to_numpy()
        return (self.held.value[part * self.size + (bit >> 3)] >> (bit & 7).astype(np.uint8) & 1).astype(bool)

    def __reduce__(self):
        return _restored, (self.held, self.slots)


def _restored(held, slots: int) -> IdFilter:
    made = IdFilter.__new__(IdFilter)
    made.held, made.slots = held, slots
    return made


def _thinned(rows: DataFrame, column: str, wanted: IdFilter) -> DataFrame:
    """The rows whose id the filter lets through."""
    names = rows.columns

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(wanted.hits(batch))).select(names)

    return rows.select(*names, *wanted.columns(column)).mapInArrow(thin, rows.schema)


def _exploded(sketches: DataFrame, own: Column, later: Column) -> DataFrame:
    """(set_id, key, later) of the keys of sets in their own band and, ``later``, the next."""
    mark = lambda keys, k: F.transform(keys, lambda h: F.struct(h.alias("key"), F.lit(k).alias("later")))
    return sketches.select("set_id", F.explode(F.concat(mark(own, False), mark(later, True))).alias("k")).select("set_id", "k.key", "k.later")


def _block_keys(sketches: DataFrame, first: int) -> DataFrame:
    """(set_id, key, later) of the ``first`` blocks of sets, without those that are left out."""

    def of(bits: str, level: str, later: int) -> Column:
        named = F.transform(F.slice(bits, 1, first), lambda x, i: F.when(F.bit_count(x) > F.col(level), F.xxhash64(F.col("band") + later, i, x)))
        return F.filter(named, lambda h: h.isNotNull())

    return _exploded(sketches, of("bits", "level", 0), of("next_bits", "next_level", 1))


def _rare_keys(sketches: DataFrame, wanted) -> DataFrame:
    """(set_id, key, later) of the rarest shingles of sets, in every band in which the set has a sketch."""

    def of(bits: str, later: int) -> Column:
        rare = F.slice("rare", 1, F.when(F.size(bits) > 0, F.size("rare")).otherwise(0))
        return F.filter(F.transform(rare, lambda x: F.xxhash64(F.col("band") + later, x)), lambda h: wanted(h))

    return _exploded(sketches, of("bits", 0), of("next_bits", 1))


def _shared_keys(rows: DataFrame, keep) -> DataFrame:
    """(key, set_id, later, low) of the keys that more than one set has, one of them in its own band; low is the smallest set.

    The keys are counted by one aggregation with partial sums; a filter of the shared
    ones then thins out the rows before they are shuffled again.
    """
    counted = rows.groupBy("key").agg(F.min("set_id").alias("low"), F.max("set_id").alias("high"), F.min("later").alias("later"))
    shared = keep(counted.where("low <> high AND NOT later").select("key", "low"), "shared-keys")
    kept = _thinned(rows, "key", IdFilter(shared, "key"))
    return kept.distinct().join(shared, "key").select("key", "set_id", "later", "low")


def _sketches_of_sets(sketches: DataFrame, classes: DataFrame, ids: DataFrame, keep) -> DataFrame:
    """set_id and sketches of the first row of each of the sets ``ids`` (set_id)."""
    first = keep(ids.distinct().join(classes, "set_id").select(F.col("first_uid").alias("uid")), "first-rows")
    rows = sketches.select("uid", "set_id", "bits", "next_bits")
    return keep(_thinned(rows, "uid", IdFilter(first, "uid")).join(first, "uid", "left_semi").drop("uid"), "some-sketches")


def _close(pairs: DataFrame, sketches: DataFrame, classes: DataFrame, similarity: Fraction, keep) -> DataFrame:
    """The pairs (u, v) whose sketches, and sizes, leave room for the similarity."""

    def both(rows: DataFrame, table: DataFrame, names: list[str]) -> DataFrame:
        u = table.select(F.col("set_id").alias("u"), *[F.col(c).alias(f"u_{c}") for c in names])
        v = table.select(F.col("set_id").alias("v"), *[F.col(c).alias(f"v_{c}") for c in names])
        return rows.join(v, "v").join(u, "u")

    # sizes and short sketches first, so that few pairs carry their long ones
    room, step = _room(F.col("u_n_shingles") + F.col("v_n_shingles"), similarity), F.col("v_band") - F.col("u_band")
    some = both(pairs, classes, ["n_shingles", "band", *_SHORT]).where(_may_link(similarity) & (F.abs(step) <= 1))
    some = keep(some.select("u", "v", room.alias("room"), step.alias("step")), "short")

    held = _sketches_of_sets(sketches, classes, some.select(F.col("u").alias("set_id")).union(some.select("v")), keep)
    # one array a side is carried on: that of the band in which the two are compared
    right = held.select(F.col("set_id").alias("v"), F.col("bits").alias("b"), F.col("next_bits").alias("nb"))
    some = some.join(right, "v").select("u", "v", "room", "step", F.when(F.col("step") == -1, F.col("nb")).otherwise(F.col("b")).alias("right"))
    left = held.select(F.col("set_id").alias("u"), F.col("bits").alias("b"), F.col("next_bits").alias("nb"))
    some = some.join(left, "u").withColumn("left", F.when(F.col("step") == 1, F.col("nb")).otherwise(F.col("b")))
    bits = F.zip_with("left", "right", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.coalesce(F.aggregate(bits, F.lit(0), lambda s, x: s + x), F.lit(0))
    return some.where(apart <= F.col("room")).select("u", "v")


def _shingle_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(set_id, shingles) of the ``wanted`` (set_id, check, first_id), out of the texts of their first documents."""
    ids = IdFilter(wanted, "first_id")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _in_parts(batches):
            kept = batch.filter(pa.array(ids.hits(batch)))
            sets = [shingle_hashes(t.as_py(), width) for t in kept.column("text")]
            names = np.array([_set_names(s) for s in sets], dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(names[:, 0]), pa.array(names[:, 1]), _lists(sets)], ["name", "check", "shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("first_id"), "text").select("text", *ids.columns("first_id"))
    # a set is found by both of its names, as its set_id may be another one (see _told_apart)
    made = texts.mapInArrow(rows, "name long, check long, shingles array<long>")
    return made.join(wanted.select("set_id", "name", "check"), ["name", "check"]).dropDuplicates(["set_id"]).select("set_id", "shingles")


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, width: int, similarity: Fraction, keep) -> DataFrame:
    """The pairs (u, v) of sets whose similarity is reached, by their whole shingle sets."""
    named = pairs.select(F.col("u").alias("set_id")).union(pairs.select("v")).distinct()
    wanted = keep(named.join(classes, "set_id"), "wanted")
    sets = keep(_shingle_sets(docs, wanted, width), "sets")
    v = sets.select(F.col("set_id").alias("v"), F.col("shingles").alias("b"))
    u = sets.select(F.col("set_id").alias("u"), F.col("shingles").alias("a"))
    num, den = similarity.numerator, similarity.denominator
    both = F.size(F.array_intersect("a", "b"))
    total = F.size("a") + F.size("b")
    # den * |both| >= num * |either|, where |either| = total - |both|
    return pairs.join(v, "v").join(u, "u").where((den + num) * both >= num * total).select("u", "v")


def _across(members: DataFrame, similarity: Fraction) -> DataFrame:
    """Pairs (u, v) of hot keys in different components, one of them outside the main component.

    Those that share a cold key, or one of a large group, are found by that; these
    must share more keys here than the smaller of their spare ones.
    """
    short = lambda x: [F.col(c).alias(f"{x}_{c}") for c in ("n_shingles", *_SHORT)]
    rest = members.where("root <> main").select("key", F.col("set_id").alias("u"), F.col("root").alias("ru"), F.col("later").alias("lu"), F.col("spare").alias("su"), *short("u"))
    other = members.select("key", F.col("set_id").alias("v"), F.col("root").alias("rv"), F.col("later").alias("lv"), F.col("spare").alias("sv"), (F.col("root") == F.col("main")).alias("mv"), *short("v"))
    # of two sets outside the main component only one order counts
    pairs = rest.join(other, "key").where("ru <> rv AND NOT (lu AND lv) AND (mv OR u < v)").where(_may_link(similarity))
    pairs = pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), F.least("su", "sv").alias("spare"))
    return pairs.groupBy("u", "v").agg(F.count("*").alias("n"), F.min("spare").alias("spare")).where("n > spare").select("u", "v")


def _close_in_blocks(members: DataFrame, sketches: DataFrame, similarity: Fraction) -> DataFrame:
    """Close pairs (u, v) of large groups: the sketches of a key's band are compared in blocks of bounded size.

    The sets of a key are dealt to blocks by a hash; every two blocks of a key, and
    each with itself, meet in one task, and only pairs that are close enough leave it.
    """
    num, den = similarity.numerator, similarity.denominator
    bits = F.when(F.col("later"), F.col("next_bits")).otherwise(F.col("bits"))
    parts = F.ceil(F.col("n") / _BLOCK).cast("int")
    columns = ["key", "set_id", "root", "later", "n_shingles", "bits"]
    held = members.join(sketches, "set_id").select(*columns[:5], bits.alias("bits"), parts.alias("parts"))
    held = held.withColumn("own", F.pmod(F.xxhash64("set_id", F.lit(3)), F.col("parts")).cast("int"))
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    held = held.select(*columns, "own", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"))

    def compare(t: pa.Table) -> pa.Table:
        ids, root, later, size, own = (t.column(c).to_numpy() for c in ("set_id", "root", "later", "n_shingles", "own"))
        words = t.column("bits").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(ids), -1)
        p, q = t.column("p")[0].as_py(), t.column("q")[0].as_py()
        at_a, at_b = np.flatnonzero(own == p), np.flatnonzero(own == q)
        found: list[list[np.ndarray]] = [[], []]
        for k in range(0, at_a.size, 256):
            some = at_a[k : k + 256]
            distance = np.zeros((some.size, at_b.size), dtype=np.int32)
            for j in range(words.shape[1]):
                distance += np.bitwise_count(words[some, j][:, None] ^ words[at_b, j])
            sizes = size[some][:, None] + size[at_b]
            ok = (distance * (den + num) <= sizes * (den - num)) & (root[some][:, None] != root[at_b]) & ~(later[some][:, None] & later[at_b])
            if p == q:
                ok &= ids[some][:, None] < ids[at_b]
            i, j = np.nonzero(ok)
            found[0].append(np.minimum(ids[some[i]], ids[at_b[j]]))
            found[1].append(np.maximum(ids[some[i]], ids[at_b[j]]))
        return pa.table({n: pa.array(np.concatenate(f) if f else np.empty(0, np.int64), pa.int64()) for n, f in zip("uv", found)})

    return held.groupBy("key", "p", "q").applyInArrow(compare, "u long, v long").distinct()


def _told_apart(sketches: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables with a set_id that different sets do not share.

    Sets are told apart by two names, 128 bits; the first of them is the set_id.  Some
    sets of 10^10 may share it and are named anew, so the list of those is short.
    """
    clashes = classes.groupBy("set_id").agg(F.count("*").alias("n")).where("n > 1").select("set_id").collect()
    if not clashes:
        return sketches, classes
    again = F.when(F.col("set_id").isin([r.set_id for r in clashes]), F.xxhash64("set_id", "check")).otherwise(F.col("set_id"))
    return sketches.withColumn("set_id", again), classes.withColumn("set_id", again)


def _rooted(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """``members`` (set_id ...) with the root of their component."""
    return members.join(nodes.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))


def _pairs_with_enough(cold: DataFrame, sets: DataFrame, similarity: Fraction, keep) -> DataFrame:
    """Pairs (u, v) of ``cold`` (key, set_id, later, root) in different components that share as many keys as they must to link.

    Two sets that link agree in more blocks than either can spare; of these only hot
    ones are not here, no more than either set has.  A pair of sets that both keep their
    hot keys is taken here with any key, or found by hot keys alone.

    Passages of many documents give pairs whose number grows with the square of the
    table.  Every row carries its set's short sketch, so nearly all of them are dropped
    where a key is joined, before anything is written of them.
    """
    most = (1 << 16) - 1
    # band, keys to spare and hot keys, in one number; a longer count only makes more pairs pass
    told = F.col("later").cast("long") * (1 << 32) + F.least("spare", F.lit(most - 1)).cast("long") * (1 << 16) + F.least("hot", F.lit(most))
    carried = ["set_id", "root", "told", "n_shingles", *_SHORT]
    rows = keep(cold.join(sets.select("set_id", "later", told.alias("told"), "n_shingles", *_SHORT), ["set_id", "later"]).select("key", *carried), "cold")

    def of(x: str) -> tuple[Column, ...]:
        told = F.col(f"{x}_told")
        return told.bitwiseAND(1 << 32) != 0, F.shiftright(told, 16).bitwiseAND(most), told.bitwiseAND(most)

    (u_later, u_spare, u_hot), (v_later, v_spare, v_hot) = of("u"), of("v")
    light = (u_hot <= u_spare) | (v_hot <= v_spare)
    must = F.when(light, F.greatest(F.least(u_spare, v_spare) + 1 - F.least(u_hot, v_hot), F.lit(1))).otherwise(1)
    u, v = (rows.select("key", *[F.col(c).alias(f"{x}_{c}") for c in carried]) for x in "uv")
    pairs = u.join(v, "key").where("u_set_id < v_set_id AND u_root <> v_root").where(~(u_later & v_later) & _may_link(similarity))
    pairs = pairs.select(F.col("u_set_id").alias("u"), F.col("v_set_id").alias("v"), must.alias("must"))
    counted = pairs.groupBy("u", "v").agg(F.count("*").alias("n"), F.min("must").alias("must"))
    return keep(counted.where("n >= must").select("u", "v"), "pairs")


def jaccard_components(docs: DataFrame, width: int = 5, similarity: Fraction = Fraction(4, 5)) -> DataFrame:
    """Shingle-set size and component of every document.

    Returns doc_id, n_shingles, set_id (equal sets have the same) and component_id,
    the smallest doc_id that links reach.  Two documents link when the similarity of
    their sets of ``width``-word shingles is at least ``similarity``.  Texts that are
    null or have no words have no shingles and link with nothing.  Every row is a
    document of its own: a repeated doc_id is returned once a row, each with the
    component of its own text; a null doc_id is returned, but names no component.
    Other columns are left out.  An empty table gives an empty result.
    """
    with scratch(docs.sparkSession, "sketches") as keep:
        with scratch(docs.sparkSession, "counts"):
            counts = _counts(docs, width)
        sketches = keep(_sketches(docs, width, similarity, counts), "sketches")
        return materialize(_components(docs, sketches, width, similarity, keep), "components")


def _components(docs: DataFrame, sketches: DataFrame, width: int, similarity: Fraction, hold) -> DataFrame:
    """``jaccard_components`` from the sketches; ``hold`` keeps what all phases need."""
    spark = docs.sparkSession
    classes = sketches.where("n_shingles > 0").groupBy("set_id", "check").agg(
        F.min("doc_id").alias("first_id"), F.min("uid").alias("first_uid"),
        *[F.max(c).alias(c) for c in ("n_shingles", "band", *_SHORT)],
    )
    classes = hold(classes.withColumn("name", F.col("set_id")), "classes")
    sketches, classes = _told_apart(sketches, classes)

    # a few blocks: every member against the smallest set of its key
    with scratch(spark, "first") as keep:
        members = keep(_shared_keys(_block_keys(sketches, _FIRST_BLOCKS), keep), "members")
        first = members.where("low < set_id").select(F.col("low").alias("u"), F.col("set_id").alias("v")).distinct()
        near = keep(_close(first, sketches, classes, similarity, keep), "near")
        links = hold(_verified(near, docs, classes, width, similarity, keep), "links")
    nodes = components(links)

    # rare shingles: keys whose sets are not yet in one component
    rounds = math.ceil(_ROUNDS * (1 - similarity) / (1 + similarity)) or 1
    parts = []
    for part in range(rounds):
        with scratch(spark, "round") as keep:
            keys = _rare_keys(sketches, lambda h, part=part: F.pmod(h, F.lit(rounds)) == part)
            placed = keep(_rooted(_shared_keys(keys, keep).drop("low"), nodes), "placed")
            spread = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n")).where("low <> high")
            parts.append(hold(placed.join(spread.select("key", (F.col("n") > _HOT).alias("many")), "key"), "open"))
    open_ = reduce(DataFrame.unionByName, parts)

    with scratch(spark, "pairs") as keep:
        hot = open_.where("many")
        counts = hot.groupBy("set_id", "later").agg(F.count("*").alias("hot"))
        # one rare shingle is all that a pair is sure to share, so no key can be spared
        sets = [classes.select("set_id", "n_shingles", *_SHORT, (F.col("band") + int(later)).alias("band"), F.lit(0).alias("spare"), F.lit(later).alias("later")) for later in (False, True)]
        sets = sets[0].unionByName(sets[1]).join(counts, ["set_id", "later"], "left").withColumn("hot", F.coalesce("hot", F.lit(0)))
        sets = keep(sets, "sets")
        pairs = _pairs_with_enough(open_.where("NOT many").drop("many"), sets, similarity, keep)
        near = keep(_close(pairs, sketches, classes, similarity, keep), "near")
        if not near.isEmpty():
            links = hold(links.unionByName(_verified(near, docs, classes, width, similarity, keep)), "links")
            nodes = components(links)

        heavy = sets.where("hot > spare").select("set_id", "later", "spare", "n_shingles", *_SHORT)
        placed = keep(_rooted(hot.select("key", "set_id", "later").join(heavy, ["set_id", "later"]), nodes), "hot")
        sizes = placed.groupBy("key", "root").agg(F.count("*").alias("n"))
        mains = sizes.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("n"))
        mains = mains.where("n > most").withColumn("many", (F.col("n") - F.col("most")) * F.col("n") > _MANY_PAIRS)
        held = keep(placed.join(mains, "key"), "hot-open")
        if not held.isEmpty():
            near = _close(keep(_across(held.where("NOT many"), similarity), "few-pairs"), sketches, classes, similarity, keep)
            many = held.where("many")
            if not many.isEmpty():
                some = _sketches_of_sets(sketches, classes, many.select("set_id"), keep)
                near = near.union(_close_in_blocks(many, some, similarity))
            near = keep(near.distinct(), "hot-near")
            links = hold(links.unionByName(_verified(near, docs, classes, width, similarity, keep)), "links")
            nodes = components(links)

    rooted = hold(_rooted(classes.select("set_id", "first_id"), nodes), "rooted")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = rooted.select("set_id", "root").join(least, "root").select("set_id", "component_id")
    names = sketches.select("doc_id", "n_shingles", "set_id")
    return (
        names.where("n_shingles > 0").join(labels, "set_id")
        .unionByName(names.where("n_shingles = 0").withColumn("component_id", F.col("doc_id")))
        .select("doc_id", "n_shingles", "set_id", "component_id")
    )

"""Hard negatives by threshold joins of anchors with all rows.

Anchors and rows meet in cells of a grid: rows are dealt to its lines, anchors to
its columns, so that every pair meets in one cell and no cell outgrows its task.  In a
cell an inverted index over the leading dimensions gathers partial scores; of each row
it omits the trailing dimensions whose norm, times that of the anchors there, is
below the lowest threshold.  Pairs whose partial score cannot reach the anchor's threshold
with the norms that remain are dropped, the others are scored to the end.

A threshold join takes windows of scores: from each anchor's window the first few
rows are sought.  The first thresholds are estimated from a bounded sample; windows
that are not full then are sought again with lower ones, down to their own end, so the
estimate bears on speed alone.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.storage import materialize

_LOWEST, _HIGHEST = -(2**63), 2**63 - 1
#: Products of norms from here on are added up in Python's integers.
_EXACT = 2.0**52
#: Dimensions that are added between two tests of the remaining norms.
_SLAB = 8
#: Anchors of a cell that are scored at once.
_AT_ONCE = 256
_FOUND = T.StructType(
    [
        T.StructField("anchor", T.LongType()),
        T.StructField("w", T.IntegerType()),
        T.StructField("score", T.LongType()),
        T.StructField("id", T.LongType()),
    ]
)


def whole_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """row, vec_id, label and q (floor of ``scale`` times each component) of the rows that take part."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    taking = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(sound)
    q = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    return taking.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), F.col("label").cast("long"), q.alias("q")
    )


def _matrix(column: pa.ChunkedArray | pa.Array, width: int, order: np.ndarray) -> np.ndarray:
    """The vectors of a column as rows of integers, shorter ones ending in zeros, dimensions in ``order``."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(lists.offsets.to_numpy())
    if flat.size == width * sizes.size:
        dense = flat.reshape(sizes.size, width)
    else:
        dense = np.zeros((sizes.size, width), dtype=flat.dtype)
        dense[np.arange(width) < sizes[:, None]] = flat
    return dense[:, order].astype(np.int64)


def _rest_norms(x: np.ndarray, borders: range) -> np.ndarray:
    """Norms of what lies at or behind each slab border, a border a column; the last is 0."""
    square = np.add.reduceat(x.astype(np.float64) ** 2, list(borders), axis=1) if x.size else np.zeros((len(x), len(borders)))
    # rounded up a little: bounds must never fall short
    rest = np.sqrt(np.cumsum(square[:, ::-1], axis=1)[:, ::-1]) * (1 + 1e-12)
    return np.hstack((rest, np.zeros((len(x), 1))))


class _Index:
    """Leading dimensions of the rows of a cell by slabs; ``threshold`` is the lowest that any anchor of the cell asks for."""

    def __init__(self, x: np.ndarray, anchors_rest: np.ndarray, threshold: int):
        self.borders = range(0, max(1, x.shape[1]), _SLAB)
        rest = _rest_norms(x, self.borders)
        most = anchors_rest.max(axis=0)
        # the first border from where on the dimensions are covered by the bound
        self.cut = np.argmax(rest * most < threshold, axis=1) if threshold > 0 else np.full(len(x), len(self.borders))
        #: rows with the most indexed slabs come first, so that a slab's postings are a prefix
        self.rows = np.argsort(-self.cut, kind="stable")
        self.rows = self.rows[: int((self.cut > 0).sum())]
        self.x, self.rest, self.cut = x[self.rows].astype(np.float64), rest[self.rows], self.cut[self.rows]
        self.postings = [int((self.cut > k).sum()) for k in range(len(self.borders))]

    def search(self, a: np.ndarray, a_rest: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of anchors and rows, and scores, of all pairs that reach the anchor's threshold."""
        a = a.astype(np.float64)
        score = np.zeros((len(a), len(self.rows)))
        for k, first in enumerate(self.borders):
            n, slab = self.postings[k], slice(first, first + _SLAB)
            score[:, :n] += a[:, slab] @ self.x[:n, slab].T
        need = thresholds.astype(np.float64)[:, None] - 0.5
        live = score + a_rest[:, self.cut] * self.rest[np.arange(len(self.rows)), self.cut] >= need
        # the omitted slabs: for all pairs while many are left, then pair by pair
        for k, first in enumerate(self.borders):
            n, slab = self.postings[k], slice(first, first + _SLAB)
            if n == len(self.rows):
                continue
            if live.mean() * 16 < 1:
                return self._finish(a, a_rest, need, score, live, k)
            score[:, n:] += a[:, slab] @ self.x[n:, slab].T
            live[:, n:] &= score[:, n:] + np.outer(a_rest[:, k + 1], self.rest[n:, k + 1]) >= need
        i, j = np.nonzero(live)
        return i, j, score[i, j]

    def _finish(self, a, a_rest, need, score, live, k):
        i, j = np.nonzero(live)
        found = score[i, j]
        for k in range(k, len(self.borders)):
            late = np.flatnonzero(self.cut[j] <= k)
            slab = slice(self.borders[k], self.borders[k] + _SLAB)
            found[late] += np.einsum("ij,ij->i", a[i[late], slab], self.x[j[late], slab])
            at = np.maximum(self.cut[j], k + 1)
            kept = found + a_rest[i, at] * self.rest[j, at] >= need[i, 0]
            i, j, found = i[kept], j[kept], found[kept]
        return i, j, found


def _pairs(a: np.ndarray, x: np.ndarray, thresholds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All pairs of an anchor and a row whose whole score reaches the anchor's threshold, a few anchors at a time."""
    borders = range(0, max(1, x.shape[1]), _SLAB)
    a_rest, x_norm = _rest_norms(a, borders), _rest_norms(x, borders)[:, 0]
    # scores that doubles do not hold exactly
    is_wide = x_norm * a_rest[:, 0].max() >= _EXACT
    wide, plain = np.flatnonzero(is_wide), np.flatnonzero(~is_wide)
    if wide.size:
        ax, xx = a.astype(object), x[wide].astype(object)
        for i in range(len(a)):
            exact = np.clip(xx @ ax[i], _LOWEST, _HIGHEST).astype(np.int64)
            hit = np.flatnonzero(exact >= thresholds[i])
            yield np.full(hit.size, i), wide[hit], exact[hit]
    if not plain.size:
        return
    index = _Index(x[plain], a_rest, int(thresholds.min()))
    for first in range(0, len(a), _AT_ONCE):
        some = slice(first, first + _AT_ONCE)
        i, j, score = index.search(a[some], a_rest[some], thresholds[some])
        yield i + first, plain[index.rows[j]], np.rint(score).astype(np.int64)


def _top(anchor: np.ndarray, score: np.ndarray, ids: np.ndarray, need: int) -> np.ndarray:
    """Places of the first ``need`` of every anchor: higher scores first, ties by smaller id."""
    order = np.lexsort((ids, ~score, anchor))
    anchor = anchor[order]
    first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])) if anchor.size else np.empty(0, dtype=np.int64)
    rank = np.arange(anchor.size) - np.repeat(first, np.diff(np.append(first, anchor.size)))
    return order[rank < need]


class ThresholdJoin:
    """Rows that fill windows of scores of anchors; ``rows`` is a written table of ``whole_vectors``."""

    def __init__(self, rows: DataFrame, sample_rows: int, block_rows: int):
        self.spark = rows.sparkSession
        largest = F.array_max(F.transform("q", lambda x: F.greatest(x, F.bitwise_not(x))))
        known = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("q")).alias("width"), F.max(largest).alias("largest")).first()
        self.count, self.width = known.n, max(1, known.width or 1)
        kind = "smallint" if (known.largest or 0) < 2**15 else "int" if known.largest < 2**31 else "bigint"
        self.rows = rows.withColumn("q", F.col("q").cast(f"array<{kind}>"))
        self.block = max(256, min(block_rows, 2**23 // self.width))
        share = F.lit(min(1.0, 2 * sample_rows / max(1, self.count)))
        some = self.rows.where(F.pmod(F.xxhash64("row"), F.lit(2**20)) < share * F.lit(2**20)).limit(sample_rows)
        sample = some.select("label", "q").toArrow()
        self.sample_labels = sample.column("label").to_numpy()
        self.sample = _matrix(sample.column("q"), self.width, np.arange(self.width)) if len(sample) else np.zeros((0, self.width), dtype=np.int64)
        #: dimensions by falling weight in the sample, so that few of them decide
        self.order = np.argsort(-(self.sample.astype(np.float64) ** 2).sum(axis=0), kind="stable")

    def with_estimates(self, anchors: DataFrame, need: int) -> DataFrame:
        """``anchors`` with a first threshold for rows of their label, and the spread of scores of both kinds of rows."""
        count, width, labels, plain = self.count, self.width, self.sample_labels, np.arange(self.width)
        sample = self.sample.astype(np.float64)
        out = T.StructType(
            [T.StructField(c, T.LongType()) for c in ("anchor", "vec_id", "label")]
            + [self.rows.schema["q"]]
            + [T.StructField(c, T.DoubleType()) for c in ("near", "near_spread", "mean", "spread")]
        )

        def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for first in range(0, len(whole), _AT_ONCE):
                    batch = whole.slice(first, _AT_ONCE)
                    scores = _matrix(batch.column("q"), width, plain).astype(np.float64) @ sample.T
                    same = batch.column("label").to_numpy()[:, None] == labels[None, :]
                    found = []
                    for s, m in zip(scores, same):
                        near, far = s[m], s[~m]
                        expected = count * near.size / max(1, s.size)
                        tail = min(0.5, 4 * need / expected) if expected else 0.5
                        z = NormalDist().inv_cdf(1 - tail)
                        found.append(
                            (
                                near.mean() + z * near.std() if near.size > 1 else float(_LOWEST),
                                near.std() if near.size > 1 else 0.0,
                                far.mean() if far.size > 1 else 0.0,
                                far.std() if far.size > 1 else 0.0,
                            )
                        )
                    values = [pa.array(v, pa.float64()) for v in zip(*found)]
                    yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("row", "vec_id", "label", "q")] + values, out.names)

        return anchors.select("row", "vec_id", "label", "q").mapInArrow(estimate, out)

    def _found(self, anchors: DataFrame, windows: DataFrame, same_label: bool, need: int) -> DataFrame:
        """The first ``need`` rows of each window at or above its threshold ``t``, ranked."""
        width, order = self.width, self.order
        per_anchor = windows.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("w", "lo", "hi", "t"))).alias("windows"))
        asked = anchors.select("anchor", "vec_id", "label", "q").join(per_anchor, "anchor")
        n_anchors = windows.select("anchor").distinct().count()
        lines = max(-(-self.count // self.block), min(self.spark.sparkContext.defaultParallelism, -(-self.count // 512)), 1)
        columns = max(1, -(-n_anchors // self.block))

        def cell(rows: pa.Table, anchors: pa.Table) -> pa.Table:
            parts: list[tuple] = []
            if len(rows) and len(anchors):
                x, a = (_matrix(t.column("q"), width, order) for t in (rows, anchors))
                ids, labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
                own, own_label = anchors.column("vec_id").to_numpy(), anchors.column("label").to_numpy()
                number = anchors.column("anchor").to_numpy()
                asked = anchors.column("windows").combine_chunks()
                owner = np.repeat(np.arange(len(anchors)), np.diff(asked.offsets.to_numpy()))
                fields = asked.flatten()
                w, lo, hi, t = (fields.field(c).to_numpy(zero_copy_only=False) for c in ("w", "lo", "hi", "t"))
                t = np.maximum(lo, t)
                lowest = np.full(len(anchors), _HIGHEST)
                np.minimum.at(lowest, owner, t)
                slots = np.arange(owner.size) - np.searchsorted(owner, owner)
                for i, j, score in _pairs(a, x, lowest):
                    fit = (ids[j] != own[i]) & ((labels[j] == own_label[i]) == same_label)
                    i, j, score = i[fit], j[fit], score[fit]
                    for slot in range(int(slots.max()) + 1):
                        at = np.flatnonzero(slots == slot)
                        place = np.full(len(anchors), -1)
                        place[owner[at]] = at
                        p = place[i]
                        hit = np.flatnonzero((p >= 0) & (score >= t[p]) & (score <= hi[p]))
                        hit = hit[_top(i[hit], score[hit], ids[j[hit]], need)]
                        parts.append((number[i[hit]], w[p[hit]], score[hit], ids[j[hit]]))
            flat = [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0, dtype=np.int64)] * 4
            return pa.table([pa.array(c, pa.int32() if n == "w" else pa.int64()) for c, n in zip(flat, _FOUND.names)], names=_FOUND.names)

        hashed = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
        each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        left = self.rows.select("vec_id", "label", "q", hashed("row", lines).alias("line"), each(columns).alias("column"))
        right = asked.select("*", hashed("anchor", columns).alias("column"), each(lines).alias("line"))
        met = left.groupBy("line", "column").cogroup(right.groupBy("line", "column")).applyInArrow(cell, _FOUND)
        best = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "id")
        return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= need)

    def fill(self, anchors: DataFrame, windows: DataFrame, same_label: bool, need: int, rounds: int = 3) -> DataFrame:
        """anchor, w, score, id and rank of the first ``need`` rows of every window.

        ``windows``: anchor, w, lo and hi (both within the window), t (where the
        search begins) and step (how far it goes down after an unfilled round; four
        times that in the next one).  The last round goes down to lo.
        """
        done = []
        for turn in range(rounds):
            found = materialize(self._found(anchors, windows, same_label, need), f"negatives-{turn}")
            if turn == rounds - 1:
                done.append(found)
                break
            filled = found.groupBy("anchor", "w").count()
            short = windows.join(filled, ["anchor", "w"], "left").where((F.coalesce("count", F.lit(0)) < need) & (F.col("t") > F.col("lo")))
            # null where a number leaves 64 bits, which greatest and least leave out
            lower = F.lit(_LOWEST) if turn == rounds - 2 else F.try_subtract("t", "step")
            wider = F.least(F.try_multiply("step", F.lit(4)), F.lit(_HIGHEST))
            short = short.select("anchor", "w", "lo", "hi", F.greatest("lo", lower).alias("t"), wider.alias("step"))
            short = materialize(short, "negatives-open")
            if short.isEmpty():
                done.append(found)
                break
            done.append(found.join(short.select("anchor", "w"), ["anchor", "w"], "left_anti"))
            windows = short
        return functools.reduce(DataFrame.unionByName, done)


def _long(x: Column) -> Column:
    """A double as a long; what lies outside of its range ends at its ends."""
    return F.floor(x).cast("long")


def mine_hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    sample_rows: int = 4096,
    block_rows: int = 8192,
) -> DataFrame:
    """For each anchor and each of its positives, the best rows of another label in a band below the positive's score.

    ``vectors`` has vec_id, label (both whole numbers) and embedding; ``is_anchor``
    tells the anchors by vec_id and label.  Components become floor(``scale`` * x), a
    score is the inner product of these.  An anchor's positives are the first
    ``positives`` rows of its label; negatives are the first ``negatives`` rows of other labels
    with low * positive_score <= 100 * negative_score <= high * positive_score;
    higher scores come first, ties go to the smaller vec_id.  Returns anchor_id,
    positive_id, rank, negative_id, positive_score and negative_score.

    Rows with a null vec_id, label, vector or component, or a component that is not
    finite, take no part.  A row never meets rows of its own vec_id; repeated rows
    are rows of their own, so a repeated anchor repeats its result.  Shorter vectors
    end in zeros; components and scores beyond 64 bits stay at the ends of their range.
    Other columns are not read; an empty table gives no rows.  ``sample_rows``
    bounds the sample that sets where the search begins and the order of dimensions.
    """
    rows = materialize(whole_vectors(vectors, scale), "negatives-rows")
    join = ThresholdJoin(rows, sample_rows, block_rows)
    anchors = materialize(join.with_estimates(join.rows.where(is_anchor), positives), "negatives-anchors")
    any_score = anchors.select(
        "anchor",
        F.lit(0).alias("w"),
        F.lit(_LOWEST).alias("lo"),
        F.lit(_HIGHEST).alias("hi"),
        _long("near").alias("t"),
        _long(F.col("near_spread") + 1).alias("step"),
    )
    best = join.fill(anchors, any_score, True, positives).select(
        "anchor", F.col("rank").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    best = materialize(best, "negatives-positives")
    score = F.col("positive_score")
    # in parts of 100, so that no product leaves 64 bits
    whole = F.expr("positive_score div 100")
    hi = whole * high + F.expr(f"((positive_score % 100) * {high}) div 100")
    lo = whole * low + F.expr(f"((positive_score % 100) * {low} + 99) div 100")
    # what the density of a bell curve at ``hi`` lets expect: four times the rows that are needed
    z = (F.col("hi") - F.col("mean")) / F.col("spread")
    gap = F.lit(4.0 * negatives / max(1, join.count)) * F.col("spread") * (2 * np.pi) ** 0.5 * F.exp(F.least(z * z / 2, F.lit(300.0)))
    gap = F.when(F.col("spread") > 0, _long(gap + 1)).otherwise(F.col("hi") - F.col("lo"))
    windows = (
        best.where(score >= 0)
        .select("anchor", "w", lo.alias("lo"), hi.alias("hi"))
        .where("lo <= hi")
        .join(anchors.select("anchor", "mean", "spread"), "anchor")
        .select("anchor", "w", "lo", "hi", F.least(gap, F.col("hi") - F.col("lo")).alias("step"))
        .select("anchor", "w", "lo", "hi", (F.col("hi") - F.col("step")).alias("t"), "step")
    )
    found = join.fill(anchors, materialize(windows, "negatives-windows"), False, negatives)
    return (
        found.join(best, ["anchor", "w"])
        .join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )

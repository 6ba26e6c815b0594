"""Near-duplicate vectors by an inverted multi-index.

Two codebooks, one for each half of the vectors, form a grid of cells.  Every
vector lies in the cell of its nearest codewords; a query visits cells in the
order of the summed distances of its halves to the codewords (multi-sequence
traversal) and stops where the target recall is reached for partners at the threshold,
as measured on the sample that fitted the codebooks.

Groups of near copies may be large, so links are not written out pair by pair.
The vectors of a cell are covered by balls of half the threshold angle: all members
of a ball link with each other.  Only the balls' leaders are searched, each as far as
the threshold angle plus twice its radius: of two balls the wider one finds the other.
Two balls
whose radii leave no doubt link wholly or not at all; for others, members are held
against leaders, and only what is still in doubt is compared member by member.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.graph import components
from gridloom.llm.storage import materialize

#: Angles closer to a limit than this are decided by the vectors themselves.
_MARGIN = 1e-7
#: Most rows of one side of a block that a task compares.
_BLOCK = 4096
#: Steps of radius for which the reach of a search is fitted.
_LEVELS = 4


def unit_rows(column: pa.Array) -> tuple[list, np.ndarray]:
    """Unit vectors of the rows that have one, and a flag for each row."""
    out, good = [], np.zeros(len(column), dtype=bool)
    for i, value in enumerate(column.to_pylist()):
        if not value or any(x is None for x in value):
            continue
        x = np.asarray(value, dtype=np.float64)
        if not np.isfinite(x).all() or not x.any():
            continue
        x = x / np.abs(x).max()
        out.append(x / math.sqrt(x @ x))
        good[i] = True
    return out, good


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1), 0)


def _nearest(x: np.ndarray, centres: np.ndarray, rows: int = 2048) -> np.ndarray:
    """The nearest centre of every row, a slice of the rows at a time."""
    slices = [_squared(x[k : k + rows], centres).argmin(axis=1) for k in range(0, len(x), rows)]
    return np.concatenate(slices) if slices else np.empty(0, dtype=np.int64)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = _nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


class MultiIndex:
    """Codebooks for both halves of vectors of one dimension, and where a traversal may stop.

    ``slack[k]`` is how far above its nearest cell, in summed squared distance, a query
    of radius ``k / _LEVELS`` of the largest one has to go to meet the share ``recall``
    of partners at the threshold angle plus twice that radius.
    """

    def __init__(self, sample: np.ndarray, codewords: int, threshold: float, recall: float):
        rng = np.random.default_rng(7)
        self.half = sample.shape[1] // 2
        self.books = [_kmeans(h, codewords, rng) for h in self._halves(sample)]
        self.theta = math.acos(threshold)
        x = sample[rng.choice(len(sample), min(4000, len(sample)), replace=False)]
        step = rng.normal(size=x.shape)
        step -= (step * x).sum(1)[:, None] * x
        norm = np.sqrt((step * step).sum(1))[:, None]
        step /= np.where(norm > 0, norm, 1)
        self.slack = np.zeros(_LEVELS + 1)
        for k in range(_LEVELS + 1):
            angle = self.theta * (1 + k / _LEVELS)
            excess = self._excess(x, math.cos(angle) * x + math.sin(angle) * step)
            self.slack[k] = np.quantile(excess, recall, method="higher")
        self.slack = np.maximum.accumulate(self.slack)

    def _halves(self, x: np.ndarray) -> list[np.ndarray]:
        return [x[:, : self.half], x[:, self.half :]]

    def _scores(self, x: np.ndarray) -> list[np.ndarray]:
        return [_squared(h, b) for h, b in zip(self._halves(x), self.books)]

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = (_nearest(h, book) for h, book in zip(self._halves(x), self.books))
        return a * len(self.books[1]) + b

    def _excess(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How far the cell of each row of ``y`` lies, for its row of ``x``, above the nearest cell."""
        out = []
        for k in range(0, len(x), 1024):
            own = np.divmod(self.cells(y[k : k + 1024]), len(self.books[1]))
            out.append(sum(np.take_along_axis(s, o[:, None], 1)[:, 0] - s.min(axis=1) for s, o in zip(self._scores(x[k : k + 1024]), own)))
        return np.concatenate(out)

    def reach(self, radius: np.ndarray) -> np.ndarray:
        """The slack of balls of these radii; a ball answers for partners no wider than itself."""
        level = np.ceil(np.clip(radius / (self.theta / 2), 0, 1) * _LEVELS - 1e-9).astype(int)
        return self.slack[level]

    def traversal(self, x: np.ndarray, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) pairs by multi-sequence traversal, all rows a step at a time.

        Both lists of half distances are sorted.  A row's frontier holds, for each opened
        codeword of the first half, its next codeword of the second; the least sum is
        visited, and a first visit opens the next codeword.  A row stops when its least
        sum lies more than its slack above its nearest cell.
        """
        a, b = self._scores(x)
        ia, ib = a.argsort(axis=1, kind="stable"), b.argsort(axis=1, kind="stable")
        sa, sb = np.take_along_axis(a, ia, 1), np.take_along_axis(b, ib, 1)
        last = sb.shape[1] - 1
        limit = sa[:, 0] + sb[:, 0] + slack + 1e-12
        turn = np.zeros(sa.shape, dtype=np.int64)
        frontier = np.full(sa.shape, np.inf)
        frontier[:, 0] = sa[:, 0] + sb[:, 0]
        live, opened = np.arange(len(x)), 1
        rows, cells = [live[:0]], [live[:0]]
        while live.size:
            i = frontier[live, :opened].argmin(axis=1)
            on = frontier[live, i] <= limit[live]
            live, i = live[on], i[on]
            j = turn[live, i]
            rows.append(live)
            cells.append(ia[live, i] * (last + 1) + ib[live, j])
            turn[live, i] = j + 1
            frontier[live, i] = np.where(j < last, sa[live, i] + sb[live, np.minimum(j + 1, last)], np.inf)
            fresh = (j == 0) & (i + 1 < sa.shape[1])
            row, k = live[fresh], i[fresh] + 1
            frontier[row, k] = sa[row, k] + sb[row, 0]
            opened = max(opened, int(k.max(initial=0)) + 1)
        return np.concatenate(rows), np.concatenate(cells)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _vectors(rows: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """uid, vec_id, label, dim and unit vector; dim is 0 where there is no vector or label."""

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, good = unit_rows(batch.column("vec"))
            found = iter(found)
            units = [next(found) if g else None for g in good]
            dims = [len(u) if u is not None else 0 for u in units]
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("vec_id"), batch.column("label"), pa.array(dims, pa.int32()), pa.array(units, pa.list_(pa.float64()))],
                ["uid", "vec_id", "label", "dim", "unit"],
            )

    picked = rows.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vec_col).cast("array<double>").alias("vec"),
    )
    made = picked.mapInArrow(units, "uid long, vec_id long, label string, dim int, unit array<double>")
    return made.withColumn("dim", F.when(F.col("label").isNull(), 0).otherwise(F.col("dim")))


def _blocks(sizes: DataFrame, name: str) -> DataFrame:
    """In how many blocks of bounded size each cell is split."""
    return sizes.withColumn(name, F.ceil(F.col("n") / _BLOCK).cast("int"))


def _dot(a: str, b: str):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _angle(a: str, b: str):
    return F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), _dot(a, b))))


def link_vectors(
    rows: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.93,
    recall: float = 0.999,
    sample_rows: int = 20_000,
    cell_rows: int = 256,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector.

    Vectors are compared when their labels are equal and not null and their lengths
    agree; those that are null, empty, zero or hold null or non-finite components
    link with nothing.  Every row is a vector of its own, so a row that repeats a
    vec_id links with its copy.  ``component_id`` is the smallest vec_id that links
    reach.  An empty table gives an empty result.

    The codebooks are fitted on at most ``sample_rows`` vectors, those with the
    smallest hashes; every row is indexed and searched.  Codebooks are sized for about
    ``cell_rows`` vectors of the largest label in a cell, with at least 16 sampled vectors for a
    codeword: 20,000 carry 400 million vectors of a label, more need more ``sample_rows``.
    """
    theta = math.acos(threshold)
    vectors = materialize(_vectors(rows, id_col, vec_col, label_col), "vectors")
    indexed = vectors.where("dim > 0")
    # the largest label decides: a search looks through the cells of one label
    shape = indexed.groupBy("dim", "label").agg(F.count("*").alias("n")).groupBy("dim").agg(F.max("n").alias("largest")).collect()
    indexes = {}
    for s in shape:  # one per dimension
        taken = indexed.where(F.col("dim") == s.dim).orderBy(F.xxhash64("unit", "uid")).limit(sample_rows).select("unit").toArrow()
        codewords = int(np.clip(math.sqrt(s.largest / cell_rows), 2, max(2, sample_rows // 16)))
        indexes[s.dim] = MultiIndex(_matrix(taken.column("unit")), codewords, threshold, recall)
    held = rows.sparkSession.sparkContext.broadcast(indexes)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.zeros(batch.num_rows, dtype=np.int64)
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                cells[at] = held.value[int(dim)].cells(_matrix(batch.column("unit").take(pa.array(at))))
            yield batch.append_column("cell", pa.array(cells))

    columns = "uid long, vec_id long, label string, dim int, unit array<double>"
    celled = materialize(indexed.mapInArrow(assign, f"{columns}, cell long"), "cells")
    cell = ["label", "dim", "cell"]
    parts = _blocks(celled.groupBy(*cell).agg(F.count("*").alias("n")), "parts").drop("n")
    parts = materialize(parts, "parts")
    salted = celled.join(parts, cell).withColumn("part", F.pmod(F.xxhash64("uid"), F.col("parts")))

    inner = math.cos(theta / 2 - _MARGIN)

    def cover(group: pa.Table) -> pa.Table:
        x = _matrix(group.column("unit"))
        left = np.arange(len(x))
        uid = group.column("uid").to_numpy()
        ball, angle = np.empty(len(x), dtype=np.int64), np.zeros(len(x))
        while left.size:
            near = x[left] @ x[left[0]]
            near[0] = 1.0
            hit = near >= inner
            members = left[hit]
            ball[members] = uid[left[0]]
            angle[members] = np.arccos(np.clip(near[hit], -1, 1))
            left = left[~hit]
        kept = group.select(["uid", "vec_id", "label", "dim", "cell", "unit"])
        return kept.append_column("ball", pa.array(ball)).append_column("angle", pa.array(angle))

    members = salted.groupBy(*cell, "part").applyInArrow(cover, "uid long, vec_id long, label string, dim int, cell long, unit array<double>, ball long, angle double")
    members = materialize(members, "members")
    summed = members.groupBy("ball").agg(F.count("*").alias("size"), F.max("angle").alias("radius"))
    leaders = members.where("uid = ball").select("ball", *cell, "unit")
    balls = materialize(leaders.join(summed, "ball"), "balls")

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                index = held.value[int(dim)]
                for some in np.array_split(at, max(1, at.size // 512)):
                    rows_ = batch.take(pa.array(some))
                    row, near = index.traversal(_matrix(rows_.column("unit")), index.reach(rows_.column("radius").to_numpy()))
                    for k in range(0, row.size, _BLOCK):
                        again = rows_.take(pa.array(row[k : k + _BLOCK]))
                        yield again.set_column(again.schema.get_field_index("cell"), "cell", pa.array(near[k : k + _BLOCK]))

    # blocks of bounded size on both sides: index rows x rows that visit the cell
    ball_schema = "ball long, label string, dim int, cell long, unit array<double>, radius double"
    index_rows = balls.select("ball", *cell, "unit", "radius")
    queries = index_rows.mapInArrow(visit, ball_schema)
    index_parts = _blocks(balls.groupBy(*cell).agg(F.count("*").alias("n")), "iparts").drop("n")
    query_parts = _blocks(queries.groupBy(*cell).agg(F.count("*").alias("n")), "qparts").drop("n")
    tiles = materialize(index_parts.join(query_parts, cell), "tiles")
    both = [F.col(c).alias(c) for c in tiles.columns]
    columns = ["ball", *cell, "unit", "radius", "i", "q"]
    left = (
        index_rows.join(tiles.select(*both), cell)
        .withColumn("i", F.pmod(F.xxhash64("ball"), F.col("iparts")).cast("int"))
        .withColumn("q", F.explode(F.sequence(F.lit(0), F.col("qparts") - 1)))
        .select(*columns)
    )
    right = (
        queries.join(tiles.select(*both), cell)
        .withColumn("q", F.pmod(F.xxhash64("ball"), F.col("qparts")).cast("int"))
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("iparts") - 1)))
        .select(*columns)
    )

    def near_balls(a: pa.Table, b: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[], [], []]
        if a.num_rows and b.num_rows:
            xa, xb = _matrix(a.column("unit")), _matrix(b.column("unit"))
            ia, ib = a.column("ball").to_numpy(), b.column("ball").to_numpy()
            ra, rb = a.column("radius").to_numpy(), b.column("radius").to_numpy()
            for k in range(0, len(ib), 512):
                angle = np.arccos(np.clip(xb[k : k + 512] @ xa.T, -1, 1))
                hit = angle <= theta + ra[None, :] + rb[k : k + 512, None] + _MARGIN
                q, i = np.nonzero(hit & (ib[k : k + 512, None] != ia[None, :]))
                found[0].append(np.minimum(ib[k + q], ia[i]))
                found[1].append(np.maximum(ib[k + q], ia[i]))
                found[2].append(angle[q, i])
        return pa.table({n: pa.array(np.concatenate(f) if f else np.empty(0), t) for n, f, t in zip("uva", found, (pa.int64(), pa.int64(), pa.float64()))})

    key = [*cell, "i", "q"]
    near = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(near_balls, "u long, v long, a double")
    near = near.groupBy("u", "v").agg(F.min("a").alias("a"))
    side = balls.select("ball", "size", "radius")
    near = near.join(side.toDF("u", "u_size", "u_radius"), "u").join(side.toDF("v", "v_size", "v_radius"), "v")
    reach = F.col("a") + F.col("u_radius") + F.col("v_radius")
    near = materialize(near.withColumn("whole", reach <= theta - _MARGIN), "near")
    whole = near.where("whole")
    # two balls of one vector each are decided by their angle alone, but for the margin
    doubt = near.where("NOT whole")

    # members of the smaller ball of a doubtful pair against the leader of the other
    swap = F.col("u_size") <= F.col("v_size")
    doubt = doubt.select(F.when(swap, F.col("u")).otherwise(F.col("v")).alias("ball"), F.when(swap, F.col("v")).otherwise(F.col("u")).alias("other"))
    unit = balls.select(F.col("ball").alias("other"), F.col("unit").alias("other_unit"), F.col("size").alias("other_size"), F.col("radius").alias("other_radius"))
    against = doubt.join(members.select("ball", "uid", "unit"), "ball").join(unit, "other")
    against = against.withColumn("b", _angle("unit", "other_unit")).where(F.col("b") - F.col("other_radius") <= theta + _MARGIN)
    against = against.withColumn("all", F.col("b") + F.col("other_radius") <= theta - _MARGIN)
    against = materialize(against.select("ball", "other", "uid", "unit", "other_size", "all"), "against")
    taken = against.where("all")
    last = against.where("NOT all").select("ball", "other", F.col("uid").alias("x"), "unit")
    each = members.select(F.col("ball").alias("other"), F.col("uid").alias("y"), F.col("unit").alias("y_unit"))
    pairs = last.join(each, "other").where(_dot("unit", "y_unit") >= threshold).select("ball", "other", "x", "y")
    pairs = materialize(pairs, "pairs")

    links = (
        whole.select("u", "v")
        .unionByName(taken.select(F.col("ball").alias("u"), F.col("other").alias("v")).distinct())
        .unionByName(pairs.select(F.col("ball").alias("u"), F.col("other").alias("v")).distinct())
    )
    roots = components(links).withColumnRenamed("node", "ball")
    n = "n_links"
    by_ball = (
        balls.select("ball", (F.col("size") - 1).alias(n))
        .unionByName(whole.select(F.col("u").alias("ball"), F.col("v_size").alias(n)))
        .unionByName(whole.select(F.col("v").alias("ball"), F.col("u_size").alias(n)))
        .unionByName(taken.select(F.col("other").alias("ball"), F.lit(1).cast("long").alias(n)))
        .groupBy("ball")
        .agg(F.sum(n).alias("ball_links"))
    )
    by_row = (
        taken.select("uid", F.col("other_size").alias(n))
        .unionByName(pairs.select(F.col("x").alias("uid"), F.lit(1).cast("long").alias(n)))
        .unionByName(pairs.select(F.col("y").alias("uid"), F.lit(1).cast("long").alias(n)))
        .groupBy("uid")
        .agg(F.sum(n).alias("row_links"))
    )
    summed = by_ball.join(roots, "ball", "left").select("ball", "ball_links", F.coalesce("root", "ball").alias("root"))
    summed = materialize(summed, "ball-links")
    placed = members.select("uid", "vec_id", "ball").join(summed, "ball").join(by_row, "uid", "left")
    placed = materialize(placed.select("vec_id", "root", (F.col("ball_links") + F.coalesce("row_links", F.lit(0))).alias(n)), "placed")
    least = materialize(placed.groupBy("root").agg(F.min("vec_id").alias("component_id")), "least")
    linked = placed.join(least, "root").select("vec_id", n, "component_id")
    alone = vectors.where("dim = 0").select("vec_id", F.lit(0).cast("long").alias(n), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))

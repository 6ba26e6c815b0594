"""Best-fit packing with certified bin counts and repacking of what is not certified.

Documents stay whole unless they are longer than a window.  Their pieces are dealt to
salted partitions of bounded size and packed there by best-fit decreasing.  Dual
feasible functions give each partition a lower bound of its bins: a partition that
meets its bound is certified and settles all bins but its emptiest one; any other
settles its full bins only.  What is not settled is exchanged, that is dealt anew
between fewer partitions, and packed again until nothing is won or the whole
packing meets the bound of the whole table.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.packing import encoder
from gridloom.llm.storage import materialize

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("row", T.LongType()),
    ]
)
PACKED = T.StructType(
    [
        *PIECES.fields,
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("settled", T.BooleanType()),
    ]
)


def cut_documents(docs: DataFrame, tokenizer: str, window: int, end_id: int) -> DataFrame:
    """One row per piece: a document of at most ``window`` tokens whole, a longer one in full windows with the short piece first.

    ``row`` numbers the input rows, so that repeated or null doc_ids stay apart.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer)
        for batch in batches:
            flat, totals = tool.encode_flat(batch.column("text"), end_id)
            flat = np.ascontiguousarray(flat, dtype="<u4")
            cuts = -(-totals // window)
            doc = np.repeat(np.arange(totals.size), cuts)
            piece = np.arange(doc.size) - np.repeat(np.cumsum(cuts) - cuts, cuts)
            head = totals[doc] - (cuts[doc] - 1) * window
            start = np.where(piece == 0, 0, head + (piece - 1) * window)
            length = np.where(piece == 0, head, window)
            first = (np.cumsum(totals) - totals)[doc] + start
            crc = [zlib.crc32(flat[x:y]) for x, y in zip(first.tolist(), (first + length).tolist())]
            at = pa.array(doc)
            columns = [
                batch.column("doc_id").take(at),
                pa.array(piece, pa.int32()),
                *(pa.array(c, pa.int64()) for c in (start, length, crc)),
                batch.column("row").take(at),
            ]
            yield pa.RecordBatch.from_arrays(columns, PIECES.names)

    numbered = docs.select(F.col("doc_id").cast("long"), F.col("text"), F.monotonically_increasing_id().alias("row"))
    return numbered.mapInArrow(pieces, PIECES)


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, int]:
    """The bin of each length and the number of bins, by best-fit decreasing.

    Bins are stacked by the room they have left; the bits of one integer tell which
    rooms occur, so the tightest fit is the lowest bit from the length upwards.
    """
    stacks: list[list[int]] = [[] for _ in range(window + 1)]
    rooms, used = 0, 0
    bins = np.empty(len(lengths), dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    for i, length in zip(order.tolist(), lengths[order].tolist()):
        fits = rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            number = stacks[room].pop()
            if not stacks[room]:
                rooms ^= 1 << room
        else:
            room, number, used = window, used, used + 1
        if room > length:
            stacks[room - length].append(number)
            rooms |= 1 << room - length
        bins[i] = number
    return bins, used


@functools.lru_cache(maxsize=4)
def _dual_feasible(window: int, most: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Integer values of dual feasible functions at every length, a function a row, and the value of a whole window in each.

    For any lengths that fit in one window the values add up to at most the window's, so
    the values of all lengths over it bound the number of windows from below.
    """
    x = np.arange(window + 1, dtype=np.int64)
    # every function gives a bound, so of a very wide window fewer are held
    steps = max(16, min(window // 2, 4_000_000 // (window + 1)))
    half = np.unique(np.linspace(1, max(1, window // 2), steps).astype(np.int64))[:, None]
    # long lengths count as whole windows, those too short to stand beside them as nothing
    rounded = np.where(x > window - half, window, np.where(x >= half, x, 0))
    # lengths rounded down to steps of one k-th of a window
    k = np.arange(1, most + 1, dtype=np.int64)[:, None]
    stepped = np.where(x * (k + 1) % window == 0, x * k, x * (k + 1) // window * window)
    # short lengths count once each, long ones as what they keep short ones from
    parts = window // half
    counted = np.where(2 * x > window, parts - (window - x) // half, (x >= half).astype(np.int64))
    values = np.concatenate((x[None, :], rounded, stepped, counted))
    whole = np.concatenate(([window], np.full(half.size, window), k.ravel() * window, parts.ravel()))
    return values, whole


def least_bins(counts: np.ndarray, window: int) -> int:
    """A lower bound of the windows that the lengths with these counts (index: length) need."""
    values, whole = _dual_feasible(window)
    present = np.flatnonzero(counts)
    if not present.size:
        return 0
    return int((-(-(values[:, present] @ counts[present]) // whole)).max())


def _pack(pieces: DataFrame, window: int, buckets: int, turn: int, last: bool) -> DataFrame:
    """Best-fit decreasing in every one of ``buckets`` partitions, with what each of them settles."""

    def pack(part: pa.Table) -> pa.Table:
        bucket = part.column("bucket")[0].as_py()
        lengths = part.column("length").to_numpy()
        # the order of rows in a group may change when a task is run again
        order = np.lexsort((part.column("piece").to_numpy(), part.column("row").to_numpy()))
        bins = np.empty(len(lengths), dtype=np.int64)
        bins[order], used = best_fit(lengths[order], window)
        by_bin = order[np.argsort(bins[order], kind="stable")]
        fill = np.bincount(bins, weights=lengths, minlength=used).astype(np.int64)
        before = np.cumsum(lengths[by_bin]) - lengths[by_bin]
        offset = np.empty(len(lengths), dtype=np.int64)
        offset[by_bin] = before - np.repeat(np.cumsum(fill) - fill, np.bincount(bins, minlength=used))
        if last:
            settled = np.ones(used, dtype=bool)
        elif used == least_bins(np.bincount(lengths, minlength=window + 1), window):
            settled = np.arange(used) != np.argmin(fill)
        else:
            settled = fill == window
        table = part.select(PIECES.names)
        sequence = (turn << 58) + (bucket << 26) + bins
        for name, values in (("sequence_id", sequence), ("offset", offset), ("settled", settled[bins])):
            table = table.append_column(name, pa.array(values))
        return table

    dealt = pieces.select(*PIECES.names, F.pmod(F.xxhash64("row", "piece", F.lit(turn)), F.lit(buckets)).alias("bucket"))
    return dealt.groupBy("bucket").applyInArrow(pack, PACKED)


def _bins(packed: DataFrame) -> tuple[int, int]:
    """Rows and sequences of a packing; each sequence has one piece at offset 0."""
    found = packed.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("offset") == 0).alias("bins")).first()
    return found.rows, found.bins


def best_fit_documents(
    docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 0, partition_rows: int = 20_000, rounds: int = 6
) -> DataFrame:
    """Where every piece of every document lies in the packed sequences.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id and offset.  A
    null or empty text has the end id alone.  Repeated rows are packed one by one
    and null doc_ids stay null; other columns of ``docs`` are not read; an empty
    table gives no rows.  Partitions hold about ``partition_rows`` pieces, dealt by a
    hash of the input row.  At most ``rounds`` rounds of packing are run; each but
    the first takes only what the one before did not settle, and one that wins no
    sequence is not used.  ``window`` is at most 65,536.
    """
    spark = docs.sparkSession
    pieces = materialize(cut_documents(docs, tokenizer, window, end_id), "bestfit-pieces")
    out = [c for c in PACKED.names if c not in ("row", "settled")]
    whole = pieces.where(F.col("length") == window).select(
        *PIECES.names,
        # full windows take the negative numbers, which no packed sequence has
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    short = pieces.where(F.col("length") < window)
    # at most one row a length reaches the driver
    histogram = np.zeros(window + 1, dtype=np.int64)
    for row in short.groupBy("length").count().collect():
        histogram[row["length"]] = row["count"]
    rows, bound = int(histogram.sum()), least_bins(histogram, window)
    done, settled_bins = [whole.select(out)], 0
    now, open_bins = None, 0
    for turn in range(rounds):
        buckets = max(1, -(-rows // partition_rows))
        last = buckets == 1 or turn == rounds - 1
        packed = materialize(_pack(short, window, buckets, turn, last), f"bestfit-{turn}")
        bins = _bins(packed)[1]
        if now is not None and bins >= open_bins:
            break
        now, open_bins = packed, bins
        rest_rows, rest_bins = (0, 0) if last else _bins(packed.where(~F.col("settled")))
        if not rest_rows or settled_bins + bins == bound:
            break
        done.append(packed.where("settled").select(out))
        settled_bins += bins - rest_bins
        short = now = packed.where(~F.col("settled"))
        rows, open_bins = rest_rows, rest_bins
    if now is not None:
        done.append(now.select(out))
    return functools.reduce(DataFrame.unionByName, done)

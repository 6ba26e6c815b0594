"""Packing token pieces into fixed windows by minimum bin slack.

Every document is cut into full windows and one tail.  Full windows are
sequences of their own; tails are packed, by their lengths only, inside salted
buckets of bounded size.  In a bucket, windows are filled one after the other: the
longest tail left opens a window, and a subset-sum program over the multiset of
the remaining lengths picks what fills the rest of it closest to capacity.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.storage import materialize

_ENCODERS: dict = {}
PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("row", T.LongType()),
    ]
)


def encoder(path: str):
    """The encoder of this worker, with its cache, for a tokenizer file."""
    from gridloom.llm.bpe import ChunkEncoder

    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def cut_pieces(docs: DataFrame, tokenizer: str, window: int, end_id: int) -> DataFrame:
    """One row per piece: full windows of a document, then its tail.

    ``row`` numbers the input rows, so that repeated or null doc_ids stay apart.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer)
        for batch in batches:
            flat, totals = tool.encode_flat(batch.column("text"), end_id)
            flat = np.ascontiguousarray(flat, dtype="<u4")
            cuts = -(-totals // window)
            doc = np.repeat(np.arange(totals.size), cuts)
            start = window * (np.arange(doc.size) - np.repeat(np.cumsum(cuts) - cuts, cuts))
            length = np.minimum(totals[doc] - start, window)
            first = (np.cumsum(totals) - totals)[doc] + start
            crc = np.fromiter(map(zlib.crc32, (flat[x:y] for x, y in zip(first.tolist(), (first + length).tolist()))), dtype=np.int64, count=doc.size)
            at = pa.array(doc)
            columns = [batch.column("doc_id").take(at), start, length, crc, totals[doc], batch.column("row").take(at)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) if isinstance(c, np.ndarray) else c for c in columns], PIECES.names)

    return docs.select(
        F.col("doc_id").cast("long"), F.col("text"), F.monotonically_increasing_id().alias("row")
    ).mapInArrow(pieces, PIECES)


def fill(counts: np.ndarray, room: int) -> list[int]:
    """Lengths, out of the multiset ``counts``, whose sum is the largest that is at most ``room``.

    Reachable sums are the bits of one integer.  Lengths are added from long to
    short, each in binary parts of its count, until the full room can be reached;
    the choice is then read off backwards.
    """
    reach, steps, mask = 1, [], (1 << (room + 1)) - 1
    full = 1 << room
    for length in np.flatnonzero(counts[: room + 1])[::-1].tolist():
        left, part = min(int(counts[length]), room // length), 1
        while left and not reach & full:
            part = min(part, left)
            steps.append((reach, length, part))
            reach |= reach << (length * part) & mask
            left -= part
            part *= 2
        if reach & full:
            break
    best = reach.bit_length() - 1
    chosen: list[int] = []
    for before, length, part in reversed(steps):
        if not before >> best & 1:
            chosen += [length] * part
            best -= length * part
    return chosen


def pack_lengths(lengths: np.ndarray, window: int) -> list[list[int]]:
    """Indexes of ``lengths`` for every window, each index in exactly one window."""
    order = np.argsort(lengths, kind="stable")
    groups = np.searchsorted(lengths[order], np.arange(window + 2))
    heads = groups[:-1].copy()
    counts = np.diff(groups)
    windows = []
    for longest in range(window, 0, -1):
        while counts[longest]:
            counts[longest] -= 1
            chosen = [longest, *fill(counts, window - longest)]
            for length in chosen[1:]:
                counts[length] -= 1
            members = []
            for length in chosen:
                members.append(int(order[heads[length]]))
                heads[length] += 1
            windows.append(members)
    return windows


def pack_documents(
    docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1, bucket_rows: int = 50_000
) -> DataFrame:
    """Where every piece of every document lies in the packed sequences.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and
    sequence_length: the tokens of a sequence, padded to ``window`` unless that
    length is a power of two (padded_length).  A null or empty text has the end id
    alone.  Repeated rows are packed one by one; an empty table gives no rows.
    Buckets are dealt by a hash of the input row, so that no key can grow one of
    them, and hold about ``bucket_rows`` tails.
    """
    spark = docs.sparkSession
    pieces = materialize(cut_pieces(docs, tokenizer, window, end_id), "pieces")
    tails = pieces.where(F.col("length") < window)
    buckets = max(1, -(-tails.count() // bucket_rows))
    whole = pieces.where(F.col("length") == window).select(
        *PIECES.names[:5],
        # full windows take the negative numbers, which no packed sequence has
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.lit(window).cast("long").alias("sequence_length"),
    )
    out = whole.schema

    def pack(part: pa.Table) -> pa.Table:
        bucket = part.column("bucket")[0].as_py()
        lengths = part.column("length").to_numpy()
        sequence = np.empty(len(lengths), dtype=np.int64)
        offset, size = sequence.copy(), sequence.copy()
        for number, members in enumerate(pack_lengths(lengths, window)):
            taken = np.cumsum(lengths[members])
            sequence[members] = bucket << 32 | number
            offset[members] = taken - lengths[members]
            size[members] = taken[-1]
        table = part.select(PIECES.names[:5])
        for name, values in (("sequence_id", sequence), ("offset", offset), ("sequence_length", size)):
            table = table.append_column(name, pa.array(values))
        return table

    packed = (
        tails.withColumn("bucket", F.pmod(F.xxhash64("row", "start"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInArrow(pack, out)
    )
    both = whole.unionByName(packed)
    size = F.col("sequence_length")
    power = size.bitwiseAND(size - 1) == 0
    return both.withColumn("padded_length", F.when(power, size).otherwise(F.lit(window).cast("long")))

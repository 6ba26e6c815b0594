"""Token ids in Arrow stream files of equal-length sequences.

The ids of all documents, in ascending doc_id order, form one stream that is
dealt to shards by ranges of doc_id.  A shard is one Arrow stream file whose
batches hold ``ids``, a fixed-size list of small unsigned integers, and ``mask``,
a fixed-size list of booleans that marks padding in its last sequence; beside it
lies an Arrow stream file with doc_id, start and n_tokens of its documents.
Both map into memory without a copy.  All batches but the last of a shard have equal
length in bytes, so sequence k is found by its number alone (``ShardSequences``,
``read_sequences``).

A task that runs again writes files of new names; only the files named in the
returned manifest count.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.packing import encoder
from gridloom.llm.storage import materialize, new_folder

#: Most text of a shard, on average.
SHARD_BYTES = 512 << 20
MANIFEST = "path string, first_id long, first_row long, docs long, tokens long"
READ = "path string, doc_id long, start long, n_tokens long, ids_crc32 long"
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def _file_system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


class ShardWriter:
    """Writes one shard: sequences of ``length`` ids, and the index of documents."""

    def __init__(self, folder: str, length: int, small: bool, rows_per_batch: int = 1024):
        self.fs, root = _file_system(folder)
        self.fs.create_dir(root, recursive=True)
        name = f"shard-{uuid.uuid4().hex}"
        self.path, self.length, self.rows = f"{folder}/{name}", length, rows_per_batch
        self.dtype = np.dtype("<u2" if small else "<u4")
        kind = pa.uint16() if small else pa.uint32()
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.files = [self.fs.open_output_stream(f"{root}/{name}.{x}") for x in ("ids", "docs")]
        self.ids = pa.ipc.new_stream(self.files[0], self.schema)
        self.docs = pa.ipc.new_stream(self.files[1], INDEX)
        self.kept, self.waiting, self.start, self.n_docs = [], 0, 0, 0

    def _sequences(self, flat: np.ndarray, filled: int) -> None:
        mask = np.zeros(flat.size, dtype=bool)
        mask[:filled] = True
        columns = [pa.array(flat, self.schema.field(0).type.value_type), pa.array(mask)]
        self.ids.write_batch(
            pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(c, self.length) for c in columns], schema=self.schema)
        )

    def add(self, names: pa.Array, flat: np.ndarray, sizes: np.ndarray) -> None:
        starts = self.start + np.cumsum(sizes) - sizes
        self.docs.write_batch(pa.RecordBatch.from_arrays([names, pa.array(starts), pa.array(sizes)], schema=INDEX))
        self.kept.append(flat.astype(self.dtype))
        self.start += int(sizes.sum())
        self.n_docs += len(names)
        self.waiting += self.kept[-1].size
        block = self.length * self.rows
        if self.waiting >= block:
            flat = np.concatenate(self.kept)
            full = flat.size // block * block
            for k in range(0, full, block):
                self._sequences(flat[k : k + block], block)
            self.kept, self.waiting = [flat[full:]], flat.size - full

    def close(self) -> None:
        flat = np.concatenate(self.kept) if self.kept else np.empty(0, self.dtype)
        if flat.size:
            short = -flat.size % self.length
            self._sequences(np.concatenate((flat, np.zeros(short, self.dtype))), flat.size)
        for stream in (self.ids, self.docs, *self.files):
            stream.close()


def _opened(folder_path: str):
    fs, path = _file_system(folder_path)
    source = pa.memory_map(path) if fs.type_name == "local" else fs.open_input_file(path)
    return pa.ipc.open_stream(source)


class ShardSequences:
    """The sequences of a shard by number; only the batch that holds one is read, without a copy where the file is local."""

    def __init__(self, path: str):
        fs, where = _file_system(f"{path}.ids")
        self.file = pa.memory_map(where) if fs.type_name == "local" else fs.open_input_file(where)
        self.schema = pa.ipc.read_schema(self.file)
        self.first = self.file.tell()
        self.rows = self._batch().num_rows
        self.step, self.end = self.file.tell() - self.first, self.file.size()

    def _batch(self) -> pa.RecordBatch:
        return pa.ipc.read_record_batch(pa.ipc.read_message(self.file), self.schema)

    def __getitem__(self, k: int) -> tuple[np.ndarray, int]:
        """The ids of sequence ``k``, padding included, and how many of them are no padding."""
        block, row = divmod(k, self.rows)
        at = self.first + block * self.step
        # behind the last batch lies the mark of the end, of 8 bytes
        if k < 0 or at + 8 >= self.end:
            raise IndexError(k)
        self.file.seek(at)
        batch = self._batch()
        if row >= batch.num_rows:
            raise IndexError(k)
        ids, mask = (c[row].values for c in batch.columns)
        return ids.to_numpy(), mask.true_count


def shard_documents(path: str) -> Iterator[tuple[list, list, list, list]]:
    """doc_id, start in the shard, ids and crc32 of the documents of a shard, in batches."""
    sequences = (b.column(0).flatten().to_numpy(zero_copy_only=True) for b in _opened(f"{path}.ids"))
    held, before = np.empty(0, dtype="<u2"), 0
    for batch in _opened(f"{path}.docs"):
        names, starts, sizes = (c.to_pylist() for c in batch.columns)
        ids = []
        for start, size in zip(starts, sizes):
            parts, have = [held[start - before :]], held.size - (start - before)
            while have < size:
                before, held = before + held.size, next(sequences)
                parts.append(held)
                have += held.size
            ids.append(np.concatenate(parts)[:size].astype("<u4"))
        yield names, starts, sizes, ids


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, length: int = 2048, end_id: int = 2, shards: int | None = None) -> DataFrame:
    """Write all documents in ascending doc_id order; return the manifest, one row per shard.

    Null texts are empty, so they hold the end id alone.  Null doc_ids come first;
    rows that repeat a doc_id lie next to each other, ordered by the hash of their
    text.  Without rows there are no shards.  Shards grow in number with the text, not
    in size.
    """
    spark = docs.sparkSession
    if shards is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(spark.sparkContext.defaultParallelism * 4, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer)
        small = max(tool.library.get_vocab_size(), end_id + 1) <= 1 << 16
        shard, first = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column("doc_id")
            if shard is None:
                shard, first = ShardWriter(folder, length, small), (names[0].as_py(), batch.column("tie")[0].as_py())
            shard.add(names, *tool.encode_flat(batch.column("text"), end_id))
        if shard is not None:
            shard.close()
            row = [[shard.path], [first[0]], [first[1]], [shard.n_docs], [shard.start]]
            yield pa.RecordBatch.from_arrays([pa.array(row[0]), *(pa.array(c, pa.int64()) for c in row[1:])], ["path", "first_id", "first_row", "docs", "tokens"])

    ordered = (
        docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tie"), F.col("text"))
        .repartitionByRange(shards, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
    )
    return materialize(ordered.mapInArrow(write, MANIFEST), "manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Every document of the files of a manifest: path, doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it: the ids of earlier shards,
    summed over the manifest (one row per shard), and those before it in its shard.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                for names, starts, sizes, ids in shard_documents(path):
                    crc = [zlib.crc32(x.tobytes()) for x in ids]
                    starts = [before + x for x in starts]
                    columns = [pa.array([path] * len(names)), *(pa.array(c, pa.int64()) for c in (names, starts, sizes, crc))]
                    yield pa.RecordBatch.from_arrays(columns, ["path", "doc_id", "start", "n_tokens", "ids_crc32"])

    n = max(manifest.sparkSession.sparkContext.defaultParallelism, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = Window.orderBy(F.col("first_id").asc_nulls_first(), "first_row").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("path", F.coalesce(F.sum("tokens").over(order), F.lit(0)).alias("before"))
    return placed.repartition(n).mapInArrow(read, READ)


def read_sequences(wanted: DataFrame) -> DataFrame:
    """path, sequence, ids and n_ids (without padding) of the ``wanted`` (path, sequence) of written shards, in any order.

    Rows that are asked for twice come twice; nulls, and numbers a shard does not have, give no row.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, shard = None, None
        for batch in batches:
            found = []
            for name, k in zip(batch.column("path").to_pylist(), batch.column("sequence").to_pylist()):
                if name != path:
                    path, shard = name, ShardSequences(name)
                try:
                    ids, n = shard[k]
                except IndexError:
                    continue
                found.append((name, k, ids.tolist(), n))
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["path", "sequence", "ids", "n_ids"])

    rows = wanted.select("path", F.col("sequence").cast("long")).where("path IS NOT NULL AND sequence IS NOT NULL")
    return rows.sortWithinPartitions("path", "sequence").mapInArrow(read, "path string, sequence long, ids array<long>, n_ids long")


def token_file_digest(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 2) -> DataFrame:
    """Write the files, read them back, and describe every document by what was read."""
    manifest = write_token_files(docs, tokenizer, new_folder(docs.sparkSession, "tokens"), length, end_id)
    return read_token_files(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")

"""Token ids in Arrow's file format: fixed-size-list batches of equal-length sequences and masks.

``write_tokens`` deals documents into ranges of ascending id, more of them for more bytes of input, and each range becomes one shard:
``shard-N.arrow``, whose record batches have the columns ``ids`` and ``mask``, each a
fixed-size list of ``sequence_length`` values, and ``shard-N.index.arrow`` with the place of each
document in the shard's run of ids. Both are uncompressed, so that a reader maps the file and
takes any sequence without copying (``open_sequences``). Only the last sequence of a shard has
masked places.

Edge cases: a null or empty text is its end id alone; rows that share an id follow one another in
order of their texts, and may lie in several shards; a null id comes first; a very long text is encoded at once by
one task and lies in as many batches as it needs; an empty table gives no shards and an empty
index; other columns are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path, partitions, session, ship
from .tokens import encoder, vocabulary_size

INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
#: Sequences in a record batch, and documents in a batch of the index.
BATCH, INDEX_BATCH = 512, 100_000
#: Bytes of input for a shard, and characters of a text by which rows of one id are dealt.
SHARD_BYTES, PREFIX = 256 << 20, 16


def _schema(length: int, wide: bool) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.uint32() if wide else pa.uint16(), length)), ("mask", pa.list_(pa.bool_(), length))],
                     metadata={"sequence_length": str(length)})


def _batch(schema: pa.Schema, ids: np.ndarray, valid: int) -> pa.RecordBatch:
    length = schema.field("ids").type.list_size
    mask = np.arange(len(ids)) < valid
    return pa.RecordBatch.from_arrays(
        [pa.FixedSizeListArray.from_arrays(pa.array(ids, schema.field("ids").type.value_type), length),
         pa.FixedSizeListArray.from_arrays(pa.array(mask), length)], schema=schema)


def open_sequences(path: str) -> pa.Table:
    """The sequences of a shard; of a local file without copying: the columns point into the mapped file."""
    where, name = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
    source = pa.memory_map(name) if isinstance(where, pafs.LocalFileSystem) else where.open_input_file(name)
    return pa.ipc.open_file(source).read_all()


def _read(where: pafs.FileSystem, name: str) -> pa.Table:
    source = pa.memory_map(name) if isinstance(where, pafs.LocalFileSystem) else where.open_input_file(name)
    return pa.ipc.open_file(source).read_all()


class _Shard:
    """Writes one shard; the files get their names when they are whole."""

    def __init__(self, where: pafs.FileSystem, name: str, attempt: int, length: int, wide: bool) -> None:
        self.where, self.name, self.attempt = where, name, attempt
        self.schema, self.length = _schema(length, wide), length
        self.kind = np.uint32 if wide else np.uint16
        self.out = where.open_output_stream(f"{name}.arrow.{attempt}")
        self.writer = pa.ipc.new_file(self.out, self.schema)
        self.index_out = where.open_output_stream(f"{name}.index.arrow.{attempt}")
        self.index = pa.ipc.new_file(self.index_out, INDEX)
        self.held: list[np.ndarray] = []
        self.n_held = self.total = self.n_docs = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.rows.append((doc_id, self.total, len(ids)))
        self.held.append(ids.astype(self.kind))
        self.n_held += len(ids)
        self.total += len(ids)
        if len(self.rows) == INDEX_BATCH:
            self._flush_index()
        if self.n_held >= self.length * BATCH:
            self._flush(self.n_held - self.n_held % (self.length * BATCH))

    def _flush(self, n: int) -> None:
        flat = np.concatenate(self.held) if self.held else np.zeros(0, self.kind)
        part, rest = flat[:n], flat[n:]
        self.held, self.n_held = ([rest] if len(rest) else []), len(rest)
        room = -len(part) % self.length
        part = np.concatenate([part, np.zeros(room, self.kind)])
        valid = len(part) - room
        for at in range(0, len(part), self.length * BATCH):
            block = part[at : at + self.length * BATCH]
            self.writer.write_batch(_batch(self.schema, block, valid - at))

    def _flush_index(self) -> None:
        self.index.write_batch(pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*self.rows)], schema=INDEX))
        self.n_docs += len(self.rows)
        self.rows = []

    def close(self) -> tuple[int, int]:
        if self.n_held:
            self._flush(self.n_held)
        if self.rows:
            self._flush_index()
        for opened in (self.writer, self.out, self.index, self.index_out):
            opened.close()
        for kind in ("arrow", "index.arrow"):
            self.where.move(f"{self.name}.{kind}.{self.attempt}", f"{self.name}.{kind}")
        return self.total, self.n_docs


def _shards(docs: DataFrame) -> int:
    """How many ranges: at least Spark's own number, and more if the optimizer's estimate of the input asks for it."""
    least = partitions(session(docs))
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 60:  # no estimate
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(least, -(-size // SHARD_BYTES))


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, *, sequence_length: int = 2048,
                 id_col: str = "doc_id", text_col: str = "text", by_word: bool = True) -> list[tuple[int, str, int]]:
    """Write all documents under ``path``; returns (shard, its file's stem, ids of the shards before it).

    The one shuffle deals texts by ranges of the id. The driver receives one row for each shard.
    """
    spark = session(docs)
    ship(spark)
    wide = max(vocabulary_size(tokenizer), end_id + 1) > 1 << 16

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shard = encoder(tokenizer, by_word), None
        context = TaskContext.get()
        number = context.partitionId()
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), own.encode_all(text.as_py() for text in batch.column(1))):
                if shard is None:
                    where, base = pafs.FileSystem.from_uri(path)
                    where.create_dir(base, recursive=True)
                    shard = _Shard(where, f"{base}/shard-{number:06d}", context.taskAttemptId(), sequence_length, wide)
                shard.add(doc_id, np.append(ids, np.uint32(end_id)))
        if shard is not None:
            total, rows = shard.close()
            yield pa.RecordBatch.from_pydict({"shard": pa.array([number], pa.int64()), "n_ids": pa.array([total], pa.int64()), "n_docs": pa.array([rows], pa.int64())})

    # the start of a text parts the rows of a repeated id
    chosen = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    dealt = chosen.repartitionByRange(_shards(chosen), F.col("doc_id"), F.substring("text", 1, PREFIX)).sortWithinPartitions("doc_id", "text")
    found = sorted((r.shard, r.n_ids) for r in dealt.mapInArrow(work, "shard long, n_ids long, n_docs long").collect())
    shards, before = [], 0
    for number, n_ids in found:
        shards.append((number, f"{path}/shard-{number:06d}", before))
        before += n_ids
    return shards


def read_tokens(spark: SparkSession, shards: list[tuple[int, str, int]], *, ids: bool = False) -> DataFrame:
    """Documents as read back from the files: doc_id, start, n_tokens, ids_crc32, and ``ids`` if asked for.

    One task reads one shard, a window of its sequences at a time.
    """
    ship(spark)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if ids else "")
    if not shards:
        return spark.createDataFrame([], schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for stem, before in zip(batch.column("stem").to_pylist(), batch.column("before").to_pylist()):
                where, name = pafs.FileSystem.from_uri(stem)
                local = isinstance(where, pafs.LocalFileSystem)
                source = pa.memory_map(f"{name}.arrow") if local else where.open_input_file(f"{name}.arrow")
                index = _read(where, f"{name}.index.arrow")
                yield from _documents(pa.ipc.open_file(source), index, before, ids)

    table = spark.createDataFrame([(s, p, b) for s, p, b in shards], "shard long, stem string, before long")
    return table.repartition(min(len(shards), 4096)).mapInArrow(work, schema)


def _documents(file: pa.ipc.RecordBatchFileReader, index: pa.Table, before: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    """Walk the batches once; a document may lie in several of them."""
    batch_at, flat, base = -1, np.zeros(0, np.uint32), 0  # flat: the valid ids of batch batch_at, of which base is the first
    rows: list[tuple] = []
    size = 0

    def emit() -> pa.RecordBatch:
        cols = list(zip(*rows))
        kinds = [pa.int64()] * 4 + [pa.binary()] * with_ids
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(kinds)])

    listed = ((n, s, l) for part in index.to_batches() for n, s, l in zip(*(c.to_pylist() for c in part.columns)))
    for number, start, length in listed:
        parts, at = [], start
        while at < start + length:
            while at >= base + len(flat):
                base += len(flat)
                batch_at += 1
                batch = file.get_batch(batch_at)
                values = batch.column("ids").flatten().to_numpy(zero_copy_only=True)
                flat = values[: int(np.count_nonzero(batch.column("mask").flatten().to_numpy(zero_copy_only=False)))]
            upto = min(start + length, base + len(flat))
            parts.append(flat[at - base : upto - base])
            at = upto
        data = b"".join(p.astype("<u4").tobytes() for p in parts)
        rows.append((number, before + start, length, zlib.crc32(data), *([data] * with_ids)))
        size += length
        if len(rows) >= 10_000 or size >= 4_000_000:
            yield emit()
            rows.clear()
            size = 0
    if rows:
        yield emit()


def tokens_path(spark: SparkSession) -> str:
    """A new folder for shards in the shared folder."""
    return new_path(spark, "tokens")

"""Harmonic packing of token sequences.

A piece longer than C/(k+1) and at most C/k tokens is of class k, and a bin of class k takes k
pieces, whatever their lengths. Documents may be cut, so a document is cut at reciprocals of the
capacity: whole sequences first (class 1), then from the rest again and again the longest C/k
that fits. Bins of class k so close with fewer than k tokens to spare. Pieces below C/M are small:
they fill bins of their own one after another, cut where a bin ends. Each worker fills its bins
alone; what its open bins hold at the end is laid end to end and cut into full sequences and, for
the last part, into powers of two.

Edge cases: a null or empty text is a document of its end id alone; a repeated row is packed again
as a document of its own; a null id stays null; a very long text is encoded at once by one task and
leaves it as full sequences, but for its end; an empty table gives no rows; other columns are not
read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import session, ship
from .tokens import encoder

#: Classes of reciprocal lengths; pieces shorter than capacity/CLASSES are small.
CLASSES = 32
#: Ids in one batch that goes back to the executor.
FLUSH = 500_000
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Packer:
    """One worker's open bins. A piece is (document's number, start, length)."""

    def __init__(self, capacity: int, classes: int, first_sequence: int = 0) -> None:
        self.capacity, self.classes = capacity, min(classes, capacity)
        self.next = first_sequence
        self.open: dict[int, list[tuple]] = {}
        self.small: list[tuple] = []
        self.small_used = 0
        self.done: list[tuple] = []

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, length in pieces:
            self.done.append((doc, start, length, self.next, offset))
            offset += length
        self.next += 1

    def whole(self) -> int:
        """The number of a sequence that one piece fills."""
        self.next += 1
        return self.next - 1

    def add(self, doc: object, length: int) -> None:
        start, limit = 0, self.capacity
        while length - start >= max(1, limit // self.classes):
            rest = length - start
            k = max(1, -(-limit // rest))
            if k > 1 and limit // (k - 1) <= rest:  # a whole number of tokens fits one class up
                k -= 1
            size = limit // k
            bin_ = self.open.setdefault(k, [])
            bin_.append((doc, start, size))
            if len(bin_) == k:
                self._close(self.open.pop(k))
            start += size
        while start < length:
            size = min(length - start, limit - self.small_used)
            self.small.append((doc, start, size))
            self.small_used += size
            start += size
            if self.small_used == limit:
                self._close(self.small)
                self.small, self.small_used = [], 0

    def finish(self) -> None:
        """Lay the open bins end to end; full sequences, then powers of two."""
        left = [p for k in sorted(self.open) for p in self.open[k]] + self.small
        self.open, self.small, self.small_used = {}, [], 0
        total = sum(p[2] for p in left)
        sizes = [self.capacity] * (total // self.capacity)
        rest = total % self.capacity
        sizes += [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        at, used = 0, 0
        for size in sizes:
            bin_, room = [], size
            while room:
                doc, start, length = left[at]
                take = min(room, length - used)
                bin_.append((doc, start + used, take))
                room -= take
                used += take
                if used == length:
                    at, used = at + 1, 0
            self._close(bin_)

    def take(self) -> list[tuple]:
        done, self.done = self.done, []
        return done


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])


def pack(docs: DataFrame, tokenizer: str, end_id: int, *, capacity: int = 4096, classes: int = CLASSES,
         id_col: str = "doc_id", text_col: str = "text", by_word: bool = True) -> DataFrame:
    """Pieces of all documents (``SCHEMA``), ``ids`` little-endian unsigned 32-bit.

    Documents are read once, without a shuffle. Full sequences leave a worker at once. Of the rest of
    a document, shorter than a sequence, it holds the ids until the last of its pieces leaves; one bin
    of each class is open, so these are at most ``classes``**2 / 2 documents and those of the batch.
    """
    ship(session(docs))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, by_word)
        packer = Packer(capacity, classes, TaskContext.get().partitionId() << 36)
        held: dict[int, list] = {}  # of a document's rest: id, ids, ids of the document, ids before it, ids still here
        number = 0
        rows: list[tuple] = []

        def left() -> Iterator[pa.RecordBatch]:
            nonlocal rows
            size = 0
            for doc, start, length, sequence, offset in packer.take():
                entry = held[doc]
                rows.append((entry[0], entry[3] + start, length, entry[1][start : start + length].tobytes(), entry[2], sequence, offset))
                entry[4] -= length
                if entry[4] == 0:
                    del held[doc]
                size += length
                if size >= FLUSH:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)
                rows = []

        waiting = 0
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), own.encode_all(text.as_py() for text in batch.column(1))):
                total = len(ids) + 1
                full = total - total % capacity
                ids = np.append(ids, np.uint32(end_id))
                for start in range(0, full, capacity):
                    rows.append((doc_id, start, capacity, ids[start : start + capacity].tobytes(), total, packer.whole(), 0))
                    if len(rows) * capacity >= FLUSH:
                        yield _batch(rows)
                        rows = []
                if full < total:
                    held[number] = [doc_id, ids[full:].copy(), total, full, total - full]
                    packer.add(number, total - full)
                    number += 1
                waiting += total % capacity
                if waiting >= FLUSH:
                    yield from left()
                    waiting = 0
        packer.finish()
        yield from left()

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(work, SCHEMA)

"""Language-model scoring with a hashed maximum-entropy model.

The next word's symbol is predicted in two steps, its class and then its place in the class, each by
a softmax over hashed features of the words before: the last word, the last two (n-grams), the word
two back and the word three back (skips). Symbols are the most frequent training tokens and one for
all others; a token of that one has the share that its count gives it among the others.

Counts are exact and over all training documents. Words that may be frequent (``HEAD``: at most so
many words can have that share of all tokens) go to the workers as a table of bounded size; counts
of the others are looked up by a join. Training takes every training document once, in ``ROUNDS``
rounds: each task runs gradient updates over its documents from the round's common weights, and the
rows of the weight tables are then averaged over tasks, weighted by their uses, in steps of
bounded fan-in. Scoring runs over batches of token numbers in numpy.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_of_id, remove, session, ship, written

#: Words with at least 1/HEAD of all training tokens are sent to the workers: so many at most.
HEAD = 1 << 20
#: Classes, and symbols in a class.
CLASSES = WIDTH = 32
#: Hashed rows of a weight table unless ``rows`` is given, a power of two of at most 2**24; the constants' rows follow.
ROWS = 1 << 14
ROUNDS = 2
BATCH = 32_768
RATE = 1.0
#: Tables of weights that are added up in one task.
FAN_IN = 32
BLOCKS = 32
#: The token at the end of a text; no word can be like it.
END = b"\n"
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def text_tokens(text: str | None) -> list[bytes]:
    """Words, ASCII letters lower-cased, and the end token."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    words.append(END)
    return words


@dataclass
class Vocabulary:
    """head: frequent words from the most frequent one; total, distinct: training tokens; other_*: those that are no symbols."""

    head: dict[bytes, int]
    counts: np.ndarray
    total: int
    distinct: int
    other_total: int
    other_distinct: int


@dataclass
class Weights:
    """Tables (rows + CLASSES, width + 2) of classes and of places in them; the last two columns are a row's squared gradients and uses."""

    tables: list[np.ndarray]

    @property
    def rows(self) -> int:
        return len(self.tables[0]) - CLASSES


def _learned(docs: DataFrame, modulus: int, remainder: int) -> DataFrame:
    return docs.where(crc_of_id("doc_id", modulus) != remainder)


def count_tokens(docs: DataFrame) -> DataFrame:
    """(word, c) over all rows of ``docs``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(counter), pa.binary()), pa.array(list(counter.values()), pa.int64())], names=["word", "c"])
            counter.clear()
            return made

        for batch in batches:
            for text in batch.column("text"):
                counter.update(text_tokens(text.as_py()))
                if len(counter) > 400_000:
                    yield out()
        if counter:
            yield out()

    return docs.select("text").mapInArrow(work, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def vocabulary(counts: DataFrame, head: int = HEAD) -> tuple[Vocabulary, int]:
    """The vocabulary, and the count from which a word is in its head."""
    row = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    total, distinct = row[0] or 0, row[1]
    least = max(1, -(-total // head))
    rows = sorted(((r.c, bytes(r.word)) for r in counts.where(F.col("c") >= least).collect()), key=lambda x: (-x[0], x[1]))
    symbols = rows[: CLASSES * WIDTH - 1]
    return Vocabulary({w: i for i, (_, w) in enumerate(rows)}, np.array([c for c, _ in rows], np.int64), total, distinct,
                      total - sum(c for c, _ in symbols), distinct - len(symbols)), least


def first_weights(v: Vocabulary, rows: int = ROWS) -> Weights:
    """Constants that give the training tokens' shares; all else zero."""
    share = np.zeros(CLASSES * WIDTH)
    share[0] = v.other_total + v.other_distinct + 1
    n = min(len(v.counts), len(share) - 1)
    share[1 : n + 1] = v.counts[:n]
    grid = (share / share.sum()).reshape(CLASSES, WIDTH)
    tables = [np.zeros((rows + CLASSES, w + 2), np.float32) for w in (CLASSES, WIDTH)]
    tables[0][rows, :CLASSES] = np.log(np.maximum(grid.sum(axis=1), 1e-9))
    tables[1][rows:, :WIDTH] = np.log(np.maximum(grid, 1e-9) / np.maximum(grid.sum(axis=1, keepdims=True), 1e-9))
    return Weights(tables)


class Stream:
    """Turns texts into arrays of codes: 0 for a word outside the head, i + 1 for its i-th word."""

    def __init__(self, v: Vocabulary) -> None:
        self.head = v.head
        self.begin = len(v.head) + 1

    def codes(self, tokens: list[bytes]) -> np.ndarray:
        out = np.fromiter(map(self.head.get, tokens, repeat(-1)), np.int64, len(tokens))
        out += 1
        return out

    def features(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols (tokens), and hashes (4, tokens) of the words before each, of documents one after another."""
        sizes = np.array([len(d) for d in docs])
        pad = np.full(3, self.begin, np.int64)
        flat = np.concatenate([x for d in docs for x in (pad, d)]).astype(np.uint64)
        at = np.arange(int(sizes.sum())) + 3 * (1 + np.repeat(np.arange(len(docs)), sizes))
        one, two, three = flat[at - 1], flat[at - 2], flat[at - 3]
        k = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
        hashes = np.stack([one * k[0] + np.uint64(1), one * k[0] + two * k[1] + np.uint64(2), two * k[0] + np.uint64(3 << 33), three * k[0] + np.uint64(5 << 34)])
        hashes ^= hashes >> np.uint64(29)
        hashes *= k[2]
        hashes ^= hashes >> np.uint64(32)
        symbols = flat[at].astype(np.int64)
        symbols[symbols >= CLASSES * WIDTH] = 0
        return symbols, hashes


def _places(hashes: np.ndarray, group: np.ndarray | None, rows: int) -> np.ndarray:
    if group is not None:
        hashes = (hashes + group.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0x9E3779B97F4A7C15)
    return (hashes >> np.uint64(40)).astype(np.int64) & (rows - 1)


def _softmax(table: np.ndarray, places: np.ndarray, constants: np.ndarray | None, width: int) -> np.ndarray:
    """``constants``: the row of each one's constant; None if all have the first."""
    z = table.take(places[0], axis=0)
    for p in places[1:]:
        z += table.take(p, axis=0)
    z += table[len(table) - CLASSES] if constants is None else table.take(constants, axis=0)
    z = np.minimum(z[:, :width], 60)  # exp stays finite without each row's maximum
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True) + np.float32(1e-30)
    return z


def symbol_logs(weights: Weights, symbols: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Natural log of each symbol's probability."""
    out = np.empty(len(symbols))
    for at in range(0, len(symbols), BATCH):
        own, h = symbols[at : at + BATCH], hashes[:, at : at + BATCH]
        group, place = own // WIDTH, own % WIDTH
        n = np.arange(len(own))
        p = _softmax(weights.tables[0], _places(h, None, weights.rows), None, CLASSES)[n, group]
        q = _softmax(weights.tables[1], _places(h, group, weights.rows), weights.rows + group, WIDTH)[n, place]
        out[at : at + BATCH] = np.log(np.maximum(p, 1e-30)) + np.log(np.maximum(q, 1e-30))
    return out


def _sums(g: np.ndarray, places: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that ``places`` names, the sum of the gradients ``g`` of each, and its uses.

    Sums run along contiguous rows of the transposed gradients, two columns in one complex number:
    several times faster than down columns.
    """
    flat = np.concatenate(places).astype(np.uint16 if n_rows <= 1 << 16 else np.uint32)  # those of 16 bits are sorted faster
    order = np.argsort(flat, kind="stable")
    rows = flat[order]
    starts = np.nonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))[0]
    pairs = np.ascontiguousarray(g.view(np.complex64).T)
    sums = np.add.reduceat(pairs.take(order % len(g), axis=1), starts, axis=1)
    return rows[starts].astype(np.int64), np.ascontiguousarray(sums.T).view(np.float32), np.diff(np.append(starts, len(rows)))


def _step(table: np.ndarray, places: np.ndarray, constants: np.ndarray | None, target: np.ndarray, width: int, rate: float) -> None:
    """One gradient update on a batch, with a step size for each row by its past gradients."""
    n = len(target)
    g = _softmax(table, places, constants, width)
    g[np.arange(n), target] -= 1
    own, sums, uses = _sums(g, places if constants is None else [*places, constants], len(table))
    if constants is None:
        own, sums, uses = np.append(own, len(table) - CLASSES), np.vstack([sums, g.sum(axis=0)]), np.append(uses, n)
    sums /= np.sqrt(uses, dtype=np.float32)[:, None]
    squares = table[own, width] + np.einsum("ij,ij->i", sums, sums)
    table[own, width] = squares
    table[own, width + 1] += uses
    sums *= (rate / (np.sqrt(squares) + 1e-3))[:, None]
    table[own, :width] -= sums


def train_on(weights: Weights, symbols: np.ndarray, hashes: np.ndarray, rate: float = RATE) -> None:
    for at in range(0, len(symbols), BATCH):
        own, h = symbols[at : at + BATCH], hashes[:, at : at + BATCH]
        group = own // WIDTH
        _step(weights.tables[0], _places(h, None, weights.rows), None, group, CLASSES, rate)
        _step(weights.tables[1], _places(h, group, weights.rows), weights.rows + group, own % WIDTH, WIDTH, rate)


def _buffered(batches: Iterator[pa.RecordBatch], stream: Stream, size: int = 16 * BATCH) -> Iterator[list[np.ndarray]]:
    held, n = [], 0
    for batch in batches:
        for text in batch.column("text"):
            codes = stream.codes(text_tokens(text.as_py()))
            held.append(codes)
            n += len(codes)
            if n >= size:
                yield held
                held, n = [], 0
    if held:
        yield held


def train(docs: DataFrame, v: Vocabulary, sent, rounds: int = ROUNDS, rows: int = ROWS) -> Weights:
    """``docs`` (doc_id, text): what to learn from; ``sent``: the broadcast vocabulary."""
    spark = session(docs)
    weights = first_weights(v, rows)
    if not v.total:
        return weights
    shapes = [t.shape for t in weights.tables]
    cut = [np.array_split(np.arange(s[0]), BLOCKS) for s in shapes]

    def blocks(tables: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
        for b in range(BLOCKS):
            parts = []
            for table, own in zip(tables, cut):
                part = table[own[b]].astype(np.float32)
                part[:, :-2] *= part[:, -1:]  # weights times uses
                part[:, -2] *= part[:, -1]
                parts.append(part.tobytes())
            yield b, b"".join(parts)

    for r in range(rounds):
        now = spark.sparkContext.broadcast(weights)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = Weights([t.copy() for t in now.value.tables])
            for t in own.tables:
                t[:, -1] = 0
            stream, any_ = Stream(sent.value), False
            for texts in _buffered(batches, stream):
                train_on(own, *stream.features(texts))
                any_ = True
            task = TaskContext.get().partitionId()
            if any_:
                found = list(blocks(own.tables))
                yield pa.RecordBatch.from_arrays([pa.array([task] * BLOCKS, pa.int64()), pa.array([b for b, _ in found], pa.int32()), pa.array([x for _, x in found], pa.binary())], names=["task", "block", "data"])

        def add(table: pa.Table) -> pa.Table:
            total = None
            for data in table["data"]:
                part = np.frombuffer(data.as_buffer(), np.float32)
                total = part.astype(np.float64) if total is None else total + part
            return pa.table({"task": pa.array([table["task"][0].as_py() // FAN_IN], pa.int64()), "block": table["block"][:1], "data": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

        mine = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(rounds)) == r).select("text")
        tasks = mine.rdd.getNumPartitions()
        found = mine.mapInArrow(work, "task long, block int, data binary")
        while True:
            found = found.groupBy("block", F.expr(f"task div {FAN_IN}").alias("part")).applyInArrow(add, "task long, block int, data binary")
            tasks = -(-tasks // FAN_IN)
            if tasks <= 1:
                break
        new = [t.copy() for t in weights.tables]
        for row in found.collect():  # BLOCKS rows, one copy of the weights
            data = np.frombuffer(row.data, np.float32)
            at = 0
            for table, own, shape in zip(new, cut, shapes):
                size = len(own[row.block]) * shape[1]
                part = data[at : at + size].reshape(-1, shape[1])
                used = part[:, -1] > 0
                table[own[row.block][used]] = part[used] / part[used, -1:]
                at += size
        weights = Weights(new)
        now.unpersist()
    return weights


def score(docs: DataFrame, *, modulus: int = 7, remainder: int = 2, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD, rounds: int = ROUNDS, rows: int = ROWS) -> DataFrame:
    """For each row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Documents whose crc32 of the id modulo ``modulus`` is ``remainder`` are held out. A row with a
    null id is not held out and is not learned from. A null or empty text is its end token alone.
    Repeated rows are learned from and scored each; with nothing to learn from, every token is
    unknown and has probability 1. Other columns are not read. ``rows`` (a power of two) is the size of
    the hashed tables, of which each worker holds two copies and each training task writes one; it is not
    raised with the input.
    """
    spark = session(docs)
    ship(spark)
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    learned = _learned(texts, modulus, remainder)
    counts = written(count_tokens(learned), "counts")
    v, least = vocabulary(counts, head)
    sent = spark.sparkContext.broadcast(v)
    weights = spark.sparkContext.broadcast(train(learned, v, sent, rounds, rows))
    base_log, other_log = np.log10(v.total + v.distinct + 1), np.log10(v.other_total + v.other_distinct + 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, model = sent.value, weights.value
        stream = Stream(own)
        logs = np.log10(np.concatenate([[0], own.counts]) + 1.0)  # code 0: the join adds what is missing
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids, column = batch.column("doc_id"), batch.column("text")
            at = 0
            while at < batch.num_rows:
                first, codes, tails, n = at, [], [], 0
                while at < batch.num_rows and n < 16 * BATCH:
                    tokens = text_tokens(column[at].as_py())
                    codes.append(stream.codes(tokens))
                    tails.append(Counter(tokens[i] for i in np.nonzero(codes[-1] == 0)[0].tolist()))
                    n += len(tokens)
                    at += 1
                symbols, hashes = stream.features(codes)
                flat, sizes = np.concatenate(codes), np.array([len(c) for c in codes])
                starts = np.cumsum(sizes) - sizes
                natural = symbol_logs(model, symbols, hashes) / np.log(10)
                # of a token that is no symbol: its share among those
                natural += np.where(symbols == 0, logs[flat] - other_log, 0)
                base = logs[flat] - base_log
                rows = at - first
                yield pa.RecordBatch.from_arrays([
                    pa.array(range(number, number + rows), pa.int64()), ids.slice(first, rows), pa.array(sizes, pa.int64()), pa.array(np.add.reduceat(flat > 0, starts, dtype=np.int64)),
                    pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(natural, starts)),
                    pa.array([list(t) for t in tails], pa.list_(pa.binary())), pa.array([list(t.values()) for t in tails], pa.list_(pa.int64()))],
                    names=["uid", "doc_id", "n_tokens", "n_head", "base", "model", "words", "times"])
                number += rows

    made = written(texts.mapInArrow(work, "uid long, doc_id long, n_tokens long, n_head long, base double, model double, words array<binary>, times array<long>"), "scored")
    tail = made.select("uid", F.explode(F.arrays_zip("words", "times")).alias("t")).select("uid", F.col("t.words").alias("word"), F.col("t.times").alias("times"))
    known = tail.join(counts.where(F.col("c") < least), "word")
    rest = known.groupBy("uid").agg(F.sum("times").alias("n_rest"), F.sum(F.col("times") * F.log10(F.col("c") + F.lit(1.0))).alias("rest"))
    rest = written(rest, "rest")
    held = F.coalesce(crc_of_id("doc_id", modulus) == remainder, F.lit(False))
    more = F.coalesce("rest", F.lit(0.0))
    return made.select("uid", "doc_id", "n_tokens", "n_head", "base", "model").join(rest, "uid", "left").select(
        "doc_id", held.alias("held_out"), "n_tokens", (F.col("n_head") + F.coalesce("n_rest", F.lit(0))).alias("n_known"), F.lit(v.total).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"), (F.col("model") + more).alias("score"))

"""Nearest neighbours by cosine with randomly rotated one-bit codes.

A vector is scaled to length 1, less a common centre, and turned by a random rotation; its code is the
sign of each coordinate, packed into bits, beside two scalars: its distance from the centre and the
inner product of the turned direction with its code. These two make the packed bits an unbiased
estimate of the inner product with any query, and give the estimate's error bound. A block of vectors
is scanned for all queries by their codes; a vector is reranked on its original coordinates unless
the upper bound of its estimate stays below the query's fifth best lower bound (or exact value)
so far. Codes, scalars and vectors of all rows are written as a table of blocks, which queries in
blocks of bounded size are broadcast to; a task keeps the best few of all its blocks for each query, with
whose scores it also closes rows, and these are merged by a window of that many rows for each task.

The score is computed in double precision coordinate by coordinate, in order, so that equal
vectors have equal scores wherever they lie. A vector is first scaled by a power of two to a largest
component near 1: that changes no cosine, and keeps squares of very large and small ones finite.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import session, ship, written

#: Error bound in standard deviations of the estimate.
BOUND = 3.0
#: Rows in a block of codes, and queries that are broadcast at once.
ROW_BLOCK, QUERY_BLOCK = 4_096, 4_096
#: Rows that the centre is the mean of, at most.
CENTRE_SAMPLE = 20_000


@dataclass
class Quantizer:
    rotation: np.ndarray
    centre: np.ndarray


@dataclass
class Codes:
    """bits: (n, bytes); far: distance from the centre; fit: inner product of direction and code; lean: inner product with the centre."""

    bits: np.ndarray
    far: np.ndarray
    fit: np.ndarray
    lean: np.ndarray


def quantizer(dimension: int, sample: np.ndarray, seed: int = 5) -> Quantizer:
    """A random rotation and the mean of a sample of vectors of length 1."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dimension, dimension)))
    return Quantizer(q * np.sign(np.diag(r)), sample.mean(axis=0) if len(sample) else np.zeros(dimension))


def norms(vectors: np.ndarray) -> np.ndarray:
    """Lengths; squares are added in the coordinates' order."""
    total = np.zeros(len(vectors))
    for k in range(vectors.shape[1]):
        total += vectors[:, k] * vectors[:, k]
    return np.sqrt(total)


def cosines(a: np.ndarray, b: np.ndarray, a_norm: np.ndarray, b_norm: np.ndarray) -> np.ndarray:
    """Row by row; products are added in the coordinates' order."""
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        total += a[:, k] * b[:, k]
    return total / (a_norm * b_norm)


def encode(q: Quantizer, unit: np.ndarray) -> Codes:
    d = unit.shape[1]
    off = unit - q.centre
    far = np.sqrt((off * off).sum(axis=1))
    turned = (off / np.maximum(far, 1e-300)[:, None]) @ q.rotation
    fit = np.abs(turned).sum(axis=1) / np.sqrt(d)
    return Codes(np.packbits(turned >= 0, axis=1, bitorder="little"), far, fit, unit @ q.centre)


def estimate(q: Quantizer, codes: Codes, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries, n) of vectors of length 1, and error bounds of one deviation."""
    d = queries.shape[1]
    off = queries - q.centre
    size = np.sqrt((off * off).sum(axis=1))
    turned = (off @ q.rotation).astype(np.float32)
    signs = np.unpackbits(codes.bits, axis=1, count=d, bitorder="little").astype(np.float32)
    signs *= 2
    signs -= 1
    fit = np.maximum(codes.fit, 1e-12)
    ratio = codes.far / fit  # of a vector at the centre: far is 0, so nothing is estimated
    along = (turned @ signs.T) / np.sqrt(d) * ratio
    error = (np.sqrt(np.maximum(1 - codes.fit**2, 0)) * ratio / np.sqrt(max(d - 1, 1)))[None, :] * size[:, None]
    # <o, q> = <o - c, q - c> + <o, c> + <q, c> - <c, c>
    return along + codes.lean[None, :] + (queries @ q.centre - q.centre @ q.centre)[:, None], error


class Best:
    """The best ``k`` rows of each query so far: scores and ids, best first."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.scores = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    def merge(self, i: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[i], scores]), np.concatenate([self.ids[i], ids])
        at = np.lexsort((ids, -scores))[: self.k]
        self.scores[i], self.ids[i] = scores[at], ids[at]

    def rows(self, query_ids: np.ndarray) -> pa.RecordBatch:
        some = self.scores > -np.inf
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(query_ids, some.sum(axis=1))), pa.array(self.ids[some]), pa.array(self.scores[some])], names=["query_id", "vec_id", "score"])


def search_block(q: Quantizer, codes: Codes, ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, best: Best, bound: float = BOUND) -> None:
    """Merge the block's best rows for each query into ``best``, the query's own row left out."""
    k = best.k
    row_norms, query_norms = norms(vectors), norms(queries)
    unit = queries / query_norms[:, None]
    for first in range(0, len(queries), 128):
        part = slice(first, first + 128)
        near, error = estimate(q, codes, unit[part])
        error *= bound
        error += 1e-6  # single precision
        own = query_ids[part][:, None] == ids[None, :]
        low = np.where(own, -np.inf, near - error)
        kth = min(k, len(ids)) - 1
        floor = np.maximum(-np.partition(-low, kth, axis=1)[:, kth] if k <= len(ids) else -np.inf, best.scores[part, -1] - 1e-9)
        open_ = (near + error >= floor[:, None]) & ~own
        for i in range(len(near)):
            at = np.nonzero(open_[i])[0]
            # best estimates first: an exact k-th score then closes most of the rest
            at = at[np.argsort(-near[i, at], kind="stable")]
            head = at[: 8 * k]
            score = _rerank(vectors, row_norms, head, queries[first + i], query_norms[first + i])
            if len(at) > len(head):
                least = max(-np.partition(-score, k - 1)[k - 1], best.scores[first + i, -1])
                rest = at[8 * k :]
                rest = rest[(near[i] + error[i])[rest] >= least - 1e-9]
                score = np.concatenate([score, _rerank(vectors, row_norms, rest, queries[first + i], query_norms[first + i])])
                head = np.concatenate([head, rest])
            if len(head):
                best.merge(first + i, score, ids[head])


def _rerank(vectors: np.ndarray, row_norms: np.ndarray, at: np.ndarray, query: np.ndarray, norm: float) -> np.ndarray:
    return cosines(vectors[at], np.broadcast_to(query, (len(at), len(query))), row_norms[at], np.full(len(at), norm))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): vectors as doubles, without null ids and without vectors that are null, empty, zero or hold a null or a non-finite component."""
    v = F.transform(vectors[vector_col], lambda x: x.cast("double"))
    made = vectors.select(vectors[id_col].cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null and size(v) > 0")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return made.where(fine).where(F.exists("v", lambda x: x != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of vectors, each scaled by a power of two."""
    rows = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1))[1][:, None])


_BLOCK = "ids binary, vectors binary, bits binary, far binary, fit binary, lean binary"


def index(rows: DataFrame, dimension: int, q: Quantizer) -> DataFrame:
    """Blocks of codes, scalars and vectors of all rows (vec_id, v), written to the shared folder."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROW_BLOCK):
                part = batch.slice(at, ROW_BLOCK)
                ids, vectors = part.column("vec_id").to_numpy(), _matrix(part.column("v"))
                codes = encode(q, vectors / norms(vectors)[:, None])
                cells = [ids.astype("<i8"), vectors.astype("<f8"), codes.bits, codes.far, codes.fit, codes.lean]
                yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cells], names=["ids", "vectors", "bits", "far", "fit", "lean"])

    return written(rows.mapInArrow(work, _BLOCK), "codes")


def nearest(vectors: DataFrame, *, k: int = 5, every: int = 50, bound: float = BOUND, id_col: str = "vec_id", vector_col: str = "embedding", query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every`` the ``k`` nearest other rows.

    Nearest first, ties to the smaller id; all candidates if there are fewer. Vectors that are null,
    empty, zero or hold a null or non-finite component take no part, nor do null ids; neither do
    vectors of another number of components than most have (the fewest, in ties). Rows that share
    an id are all candidates, and none of them for a query of that id; each of them with a usable
    vector would be that query, and the one that sorts first is. Other columns are not read.
    """
    spark = session(vectors)
    ship(spark)
    out = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors, id_col, vector_col)
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], out)
    dimension = sizes.d
    rows = rows.where(F.size("v") == dimension)
    share = min(1.0, CENTRE_SAMPLE / sizes["count"])
    drawn = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(share * (1 << 30))).orderBy(F.xxhash64("vec_id"), "vec_id").limit(CENTRE_SAMPLE).toArrow()
    sample = _matrix(drawn["v"].combine_chunks()) if drawn.num_rows else np.zeros((0, dimension))
    q = quantizer(dimension, sample / norms(sample)[:, None] if len(sample) else sample)
    sent = spark.sparkContext.broadcast(q)
    blocks = index(rows, dimension, q)

    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    # queries in blocks of about query_block, dealt by a hash
    n_blocks = max(1, -(-asked.count() // query_block))
    asked = written(asked.withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(23)), F.lit(n_blocks)).cast("int")), "queries")
    found = None
    for part in range(n_blocks):
        table = asked.where(F.col("part") == part).select("vec_id", "v").toArrow()
        if not table.num_rows:
            continue
        order = np.argsort(table["vec_id"].to_numpy())
        these = spark.sparkContext.broadcast((table["vec_id"].to_numpy()[order], _matrix(table["v"].combine_chunks())[order]))
        best = written(blocks.mapInArrow(_search(sent, these, dimension, k, bound), "query_id long, vec_id long, score double"), "best")
        found = best if found is None else found.unionByName(best)
    if found is None:
        return spark.createDataFrame([], out)
    # k rows of each task for a query
    window = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _search(sent, these, dimension: int, k: int, bound: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, (query_ids, queries) = sent.value, these.value
        best = Best(len(queries), k)
        for batch in batches:
            for i in range(batch.num_rows):
                cell = {name: batch.column(name)[i].as_buffer() for name in batch.schema.names}
                ids = np.frombuffer(cell["ids"], "<i8")
                take = lambda name, kind=np.float64: np.frombuffer(cell[name], kind)  # noqa: B023, E731
                codes = Codes(take("bits", np.uint8).reshape(len(ids), -1), take("far"), take("fit"), take("lean"))
                search_block(q, codes, ids, take("vectors").reshape(len(ids), dimension), query_ids, queries, best, bound)
        yield best.rows(query_ids)

    return work


#: DuckDB SQL for ``nearest`` on the table embeddings: brute force over all pairs of a query and a row.
SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
n AS (SELECT vec_id, v, sqrt(list_reduce(list_transform(v, lambda x: x * x), lambda a, b: a + b)) AS norm FROM e),
p AS (SELECT q.vec_id AS query_id, r.vec_id, list_reduce(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * r.v[i]), lambda a, b: a + b) / (r.norm * q.norm) AS score
      FROM n q JOIN n r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id WHERE q.norm > 0 AND r.norm > 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

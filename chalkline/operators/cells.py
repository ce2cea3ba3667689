"""Vectors in k-means cells, of which a search reads those that can hold a neighbour.

Centres are fitted to unit vectors of a bounded sample (``SAMPLE`` rows, those of the least hash of their id), every row goes to the cell of
its nearest centre, and a cell keeps its radius: the largest angle between its centre and a row of it. A row of a cell is
then at least ``angle(query, centre) - radius`` away, which bounds its cosine. A search reads the nearest cells until they hold enough rows,
and then all whose bound reaches the worst score found: its results are those of a whole scan, whatever the sample was.

Rows without a direction (null or zero vectors, or components that aren't finite) lie in a cell of their own that is always read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.functions.vectors import cosine
from chalkline.shipping import ship

#: Rows the centres are fitted to, the most cells, rounds of fitting, and the cell of rows without a direction.
SAMPLE, MOST, ROUNDS, ODD = 20_000, 4096, 8, -1
#: What rounding may cost a bound.
SLACK = 1e-6


def _units(vectors: list, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, and which rows have a direction."""
    out, good = np.zeros((len(vectors), size)), np.zeros(len(vectors), bool)
    for n, v in enumerate(vectors):
        if v is not None and len(v) == size and None not in v:
            row = np.asarray(v, float)
            largest = np.abs(row).max(initial=0.0)
            if np.isfinite(largest) and largest > 0:
                row = row / largest
                out[n], good[n] = row / np.sqrt(row @ row), True
    return out, good


def fit(units: np.ndarray, n: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of at most ``n`` cells, as unit vectors: each first centre is a row far from those before it."""
    if not len(units):
        return np.zeros((0, units.shape[1]))
    rng = np.random.default_rng(7)
    chosen = [0]
    near = units @ units[0]
    for _ in range(min(n, len(units)) - 1):
        weight = np.maximum(1 - near, 0)
        if weight.sum() <= 1e-12:
            break
        chosen.append(int(rng.choice(len(units), p=weight / weight.sum())))
        near = np.maximum(near, units @ units[chosen[-1]])
    centres = units[chosen]
    for _ in range(rounds):
        cell = np.argmax(units @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, units)
        length = np.linalg.norm(sums, axis=1)
        keep = length > 1e-12
        centres = sums[keep] / length[keep, None]
    return centres


def write(points: DataFrame, path: str, *, cells: int | None = None, id_col: str = "id", vector_col: str = "vector") -> None:
    """Write ``rows`` (id, vector; a folder a cell) and ``centres`` (cell, centre, n, radius) under ``path``."""
    spark = points.sparkSession
    ship(spark)
    chosen = points.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    n = chosen.count()
    sample = [r.vector for r in chosen.where("vector is not null").orderBy(F.xxhash64("id")).limit(SAMPLE).select("vector").collect()]
    size = len(sample[0]) if sample else 1
    units, good = _units(sample, size)
    centres = fit(units[good], cells or min(MOST, max(1, math.isqrt(n))))
    kind = chosen.schema["id"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, fine = _units(batch.column(1).to_pylist(), size)
            cell, angle = np.full(len(batch), ODD, np.int32), np.zeros(len(batch))
            if len(centres) and fine.any():
                near = rows[fine] @ centres.T
                cell[fine] = near.argmax(axis=1)
                angle[fine] = np.arccos(np.clip(near.max(axis=1), -1, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell), pa.array(angle)], names=["id", "vector", "cell", "angle"])

    made = chosen.mapInArrow(assign, f"id {kind}, vector array<double>, cell int, angle double")
    # a large cell lies over several tasks
    made.repartition(F.col("cell"), F.pmod(F.xxhash64("id"), F.lit(4))).write.mode("overwrite").partitionBy("cell").parquet(f"{path}/rows")
    rows = spark.read.schema(f"id {kind}, vector array<double>, angle double, cell int").parquet(f"{path}/rows")
    table = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)] + [(ODD, None)], "cell int, centre array<double>")  # at most MOST rows
    sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius"))
    sizes.join(F.broadcast(table), "cell", "left").select("cell", "centre", "n", "radius").coalesce(1).write.mode("overwrite").parquet(f"{path}/centres")


@dataclass
class Cells:
    """The written cells of one or more segments; ``latest`` (id, last) names the last segment that brings an id again."""

    rows: DataFrame  # id, vector, cell, seg
    centres: list  # rows of seg, cell, centre, n, radius
    latest: DataFrame | None = None

    @staticmethod
    def read(spark, paths: list[str], latest: DataFrame | None = None, kind: str = "string") -> Cells:
        rows, centres = None, []
        for seg, path in enumerate(paths):
            own = spark.read.schema(f"id {kind}, vector array<double>, cell int").parquet(f"{path}/rows").withColumn("seg", F.lit(seg))
            rows = own if rows is None else rows.unionByName(own)
            centres += [(seg, r.cell, r.centre, r.n, r.radius) for r in spark.read.parquet(f"{path}/centres").collect()]
        return Cells(rows, centres, latest)

    def bounds(self, vector: list[float]) -> list[tuple[float, int, int, int]]:
        """(largest cosine a row may have, seg, cell, rows) of each cell, best first."""
        query, good = _units([vector], len(vector))
        out = []
        for seg, cell, centre, n, radius in self.centres:
            bound = math.inf
            if cell != ODD and good[0] and len(centre) == len(vector):
                apart = math.acos(max(-1.0, min(1.0, float(query[0] @ np.asarray(centre)))))
                bound = math.cos(max(0.0, apart - radius)) + SLACK
            out.append((bound, seg, cell, n))
        return sorted(out, key=lambda b: (-b[0], b[1], b[2]))

    def _scored(self, vector: list[float], chosen: list[tuple[int, int]]) -> DataFrame:
        query, some = F.array(*[F.lit(float(x)) for x in vector]), F.lit(False)
        for seg in sorted({s for s, _ in chosen}):
            some = some | ((F.col("seg") == seg) & F.col("cell").isin([c for s, c in chosen if s == seg]))
        rows = self.rows.where(some)
        if self.latest is not None:
            rows = rows.join(self.latest, "id", "left").where(F.col("last").isNull() | (F.col("last") <= F.col("seg")))
        return rows.select("id", cosine(F.col("vector"), query).alias("score")).where(F.col("score").isNotNull())

    def chosen(self, vector: list[float], limit: int) -> list[tuple[int, int]]:
        """The cells (seg, cell) that can hold one of the ``limit`` nearest rows."""
        order = self.bounds(vector)
        first, n = [], 0
        for bound, seg, cell, size in order:
            if n >= 4 * limit and bound < math.inf:
                break
            first.append((seg, cell))
            n += size if bound < math.inf else 0
        if len(first) == len(order):
            return first
        found = self._scored(vector, first).orderBy(F.desc("score")).limit(limit).collect()
        worst = found[-1].score if len(found) == limit else -math.inf
        return first + [(seg, cell) for bound, seg, cell, _ in order[len(first) :] if bound >= worst]

    def nearest(self, vector: list[float], limit: int) -> DataFrame:
        """(id, score) of the ``limit`` rows of the largest cosine, best first, ties to the smaller id."""
        return self._scored(vector, self.chosen(vector, limit)).orderBy(F.desc("score"), "id").limit(limit)

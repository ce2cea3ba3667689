"""Which frames to take of a video, and which of them to keep."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chalkline.functions.vectors import hex_words
from chalkline.shipping import ship

# Scenes longer than this may scroll and are sampled at this interval; bits that two frames'
# hashes of 1024 bits may differ in and still be one picture.
SCROLL_SECONDS, SAMPLE_SECONDS = 45.0, 20.0
HAMMING_BITS, HASH_SIDE = 24, 32


def thousandths(x: Column) -> Column:
    """Rounded to three decimals from the exact binary value, a tie to the even digit.

    The product with 1000 is split into its double and its exact error, so that no tie is taken for one that isn't. Beyond
    2**43 neighbouring doubles are further apart than a thousandth.
    """
    product = x * F.lit(1000.0)
    big = x * F.lit(134217729.0)  # 2**27 + 1: parts x into two halves of 26 bits
    high = big - (big - x)
    error = (high * F.lit(1000.0) - product) + (x - high) * F.lit(1000.0)
    below = F.floor(product).cast("double")
    over = product - below
    odd = F.pmod(below, F.lit(2.0)) == 1
    up = (over > 0.5) | ((over == 0.5) & ((error > 0) | ((error == 0) & odd)))
    return F.when(F.abs(x) < float(1 << 43), (below + F.when(up, 1.0).otherwise(0.0)) / F.lit(1000.0)).otherwise(x)


def candidate_times(scenes: DataFrame, *, scroll: float = SCROLL_SECONDS, every: float = SAMPLE_SECONDS) -> DataFrame:
    """(job_id, timestamp): the middle of each scene, and of long ones a time every ``every`` seconds; distinct at three decimals."""
    length = F.col("end") - F.col("start")
    steps = F.greatest(F.ceil(length / F.lit(every)).cast("int") - 1, F.lit(0))
    some = F.when((length > scroll) & (steps > 0), F.transform(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), lambda k: F.col("start") + k * F.lit(every)))
    times = F.concat(F.array((F.col("start") + F.col("end")) / 2), F.coalesce(some, F.array().cast("array<double>")))
    return scenes.select("job_id", F.explode(times).alias("timestamp")).select("job_id", thousandths(F.col("timestamp")).alias("timestamp")).distinct()


class Kept:
    """Hashes kept of one job so far, found again by parts of their bits.

    Two hashes that differ in at most ``bits`` bits agree in one of ``bits`` + 1 parts at least; only hashes that share a part are compared.
    """

    def __init__(self, bits: int, words: int) -> None:
        self.bits, self.words = bits, words
        edges = np.linspace(0, words * 64, min(bits + 1, words * 64) + 1).astype(int)
        self.parts = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
        self.rows = np.zeros((64, words), np.uint64)
        self.n = 0
        self.where: list[dict[int, list[int]]] = [{} for _ in self.parts]

    def add(self, words: list[int]) -> bool:
        """Keep a hash that no kept one is near; whether it was kept."""
        row = np.array(words, np.int64).view(np.uint64)
        number = sum((int(w) & (1 << 64) - 1) << 64 * i for i, w in enumerate(words))
        keys = [number >> a & (1 << b - a) - 1 for a, b in self.parts]
        met: set[int] = set()
        for key, known in zip(keys, self.where):
            met.update(known.get(key, ()))
        if met:
            apart = np.bitwise_count(self.rows[np.fromiter(met, np.int64, len(met))] ^ row).sum(axis=1)
            if (apart <= self.bits).any():
                return False
        if self.n == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[self.n] = row
        for key, known in zip(keys, self.where):
            known.setdefault(key, []).append(self.n)
        self.n += 1
        return True


def dedup_frames(keyframes: DataFrame, bits: int = HAMMING_BITS) -> DataFrame:
    """``keyframes`` without near copies of earlier kept frames of the same job.

    Equal hashes are made one first, wherever they lie: of these only the earliest can be kept. The rest is greedy in a job's time order, so
    a job's distinct frames pass one task, a batch at a time; the task holds the kept hashes of that job.
    """
    ship(keyframes.sparkSession)
    words = HASH_SIDE * HASH_SIDE // 64
    own = keyframes.select("job_id", "kf_ord", "timestamp", hex_words(F.col("phash"), words * 16).alias("h"))
    distinct = own.groupBy("job_id", "h").agg(F.min(F.struct("timestamp", "kf_ord")).alias("at"))
    dealt = distinct.select("job_id", F.col("at.timestamp").alias("timestamp"), F.col("at.kf_ord").alias("kf_ord"), "h").repartition("job_id").sortWithinPartitions("job_id", "timestamp", "kf_ord")
    kinds = {f.name: f.dataType.simpleString() for f in keyframes.schema}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        job, kept = None, None
        for batch in batches:
            marks = []
            for j, h in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                if kept is None or j != job:
                    job, kept = j, Kept(bits, words)
                marks.append(h is None or None in h or kept.add(h))
            yield batch.select(["job_id", "kf_ord"]).filter(pa.array(marks, pa.bool_()))

    kept = dealt.mapInArrow(work, f"job_id {kinds['job_id']}, kf_ord {kinds['kf_ord']}")
    return keyframes.join(kept, ["job_id", "kf_ord"], "left_semi")


def scaled_height(width: Column, height: Column, most: int) -> Column:
    """Height of a frame scaled down to ``most`` pixels of width; its own if it is no wider."""
    return F.when(width > most, F.bround(height * F.lit(float(most)) / width, 0).cast("int")).otherwise(height)

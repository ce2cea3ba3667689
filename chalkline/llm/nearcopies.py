"""Near copies by SimHash, verified by the exact Jaccard similarity of word shingles; MinHash bands for what SimHash can't reach.

Texts of the same set of shingles are one class from the start. SimHash comes first: the classes' fingerprints are linked within ``RADIUS``
bits as in ``simhash`` (pigeonhole partitions, thresholds, probes), and each link, and each class of a fingerprint with the
first of it, is verified on whole shingle sets. Three bits stand for a similarity of about 0.98, and a radius for 0.8 (some ten bits) has no selective
partition; so pairs between that and the threshold, and those that a forest of links leaves out, are found by bands, starting from SimHash's groups.

For the bands, a class has a number of keys, each of some of its ``VALUES`` MinHash values; classes that share a key are a bucket, and pairs from buckets are verified
on whole shingle sets. The threshold says how many values a key takes: the most with which a pair at the threshold shares
no key with probability ``LOST`` or less. At 0.8 these are 40 keys of five, and 1.3e-7; more similar pairs are lost still less often.

Only pairs between groups that aren't linked yet are verified. A bucket with more than ``SMALL`` members
is first held against a few hubs of it a round, so a large group of near copies is linked without
all of its pairs. Hubs are the members that share the most buckets, as those are the most like the others, and some drawn by a hash; each
member is held against the first of its buckets' hubs only, a pair a round. What the rounds leave apart in a bucket is
compared with all of it inside tasks, some ``MEMBERS`` against some ``MEMBERS`` at a time, and only links leave them, one for each group that is met:
pairs are never rows.

Edge cases: a null text is an empty one; texts without words are copies of each other; a null id is the last of its copies; repeated rows are
copies; an empty table gives an empty one; columns may have any name. A very long text is one task's set of shingles, read in
blocks of ``BLOCK``. Ids are read as longs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import remove, same, session, ship, written
from .components import components
from .simhash import RADIUS, keep_first, majority, shingle_hashes

#: Words in a shingle, and the similarity from which two texts are near copies.
SHINGLE, THRESHOLD = 5, 0.8
#: MinHash values of a set, and the probability with which a pair at the threshold may be lost.
VALUES, LOST = 200, 1e-6
#: Members up to which all pairs of a bucket are verified at once, and rounds with hubs at most.
SMALL, ROUNDS = 32, 3
#: Members of a bucket that are compared with as many others in one task.
MEMBERS = 256
#: Shingles whose MinHash values are held at once.
BLOCK = 1024
_FACTORS = np.random.default_rng(42).integers(0, 1 << 63, (2, VALUES), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct shingles in order; words as in ``simhash``."""
    return np.unique(shingle_hashes(text, size))


def banding(threshold: float) -> tuple[int, int, int]:
    """Keys of a set, values of a key, and the shingles below which only equal sets are similar."""
    if not 0 < threshold < 1:
        raise ValueError(f"a threshold lies between 0 and 1, not {threshold}")
    rows = max((r for r in range(1, VALUES + 1) if (1 - threshold**r) ** (VALUES // r) <= LOST), default=0)
    if not rows:
        raise ValueError(f"{VALUES} values find too few pairs at {threshold}")
    return VALUES // rows, rows, math.ceil(threshold / (1 - threshold) - 1e-9)


def band_keys(hashes: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """A key for each band; none for sets so small that only equal ones are similar."""
    bands, rows, smallest = banding(threshold)
    if len(hashes) < smallest:
        return np.zeros(0, np.int64)
    least = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), BLOCK):
        least = np.minimum(least, (hashes[at : at + BLOCK, None] * _FACTORS[0] + _FACTORS[1]).min(axis=0))
    # the band's number is part of its key
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), k) for k, row in enumerate(least[: bands * rows].reshape(bands, rows))], np.uint64).view(np.int64)


def marked(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, th, fp, sim, keys): hash of the text, hash of its set of shingles, its SimHash and its band keys."""
    banding(threshold)  # before any task
    ship(session(docs))
    text = F.coalesce(docs[text_col], F.lit(""))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, sim, keys = np.zeros(batch.num_rows, np.uint64), np.zeros(batch.num_rows, np.uint64), []
            for n, t in enumerate(batch.column(2)):
                hashes = shingle_hashes(t.as_py(), shingle)
                sim[n] = majority(hashes)
                own = np.unique(hashes)
                fp[n] = xxhash.xxh64_intdigest(own.tobytes(), 42)
                keys.append(band_keys(own, threshold))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp.view(np.int64)), pa.array(sim.view(np.int64)), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "th", "fp", "sim", "keys"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text")).mapInArrow(work, "doc_id long, th long, fp long, sim long, keys array<long>")


def simhash_pairs(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b) of different classes ``fp``, written: of fingerprints ``sim`` that ``simhash.links`` links, and of the same one.

    A fingerprint is stood for by its smallest class, which its other classes are paired with, so there are fewer pairs than links and classes.
    """
    classes = written(rows.select("sim", "fp").distinct(), "classes")
    first = written(classes.groupBy("sim").agg(F.min("fp").alias("first")), "first")
    close = simhash.links(first.select(F.col("sim").alias("fp")), radius)
    same_ = classes.join(first, "sim").select(F.col("first").alias("a"), F.col("fp").alias("b"))
    one, two = first.select(F.col("sim").alias("a"), F.col("first").alias("x")), first.select(F.col("sim").alias("b"), F.col("first").alias("y"))
    near = close.join(one, "a").join(two, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    pairs = written(same_.unionByName(near).where("a <> b").distinct(), "pairs")
    remove(session(rows), classes, first, close)
    return pairs


def shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(fp, hs): shingle hashes of each row of (fp, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py(), shingle).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["fp", "hs"])

    return texts.mapInArrow(work, "fp long, hs array<long>")


def _similar(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Those of the pairs (a, b) whose sets have the similarity."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            keep = []
            for x, y in zip(left, right):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= (threshold - 1e-12) * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("fp").alias("a"), F.col("hs").alias("x"), F.size("hs").alias("m"))
    two = sets.select(F.col("fp").alias("b"), F.col("hs").alias("y"), F.size("hs").alias("n"))
    close = F.least("m", "n") >= F.greatest("m", "n") * F.lit(threshold - 1e-9)
    held = pairs.join(one.hint("merge"), "a").join(two.hint("merge"), "b").where(close)
    return held.select("a", "b", "x", "y").mapInArrow(work, "a long, b long")


def _crossing(open_: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between members (key, fp, root) of one bucket and different roots; of a member's links to one root, one a task.

    One of each such pair isn't of the bucket's largest group. So all members are dealt into blocks, those outside the largest group into chunks,
    and each block meets each chunk.
    """
    counts = open_.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    parts = lambda n: F.ceil(n / F.lit(float(MEMBERS))).cast("int")
    sized = counts.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("largest"), parts(F.sum("n")).alias("blocks"), parts(F.sum("n") - F.max("n")).alias("chunks"))
    dealt = open_.join(sized, "key").where("chunks > 0")
    some = lambda of, seed: F.pmod(F.xxhash64("fp", F.lit(seed)), of).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), of - 1))
    whole = dealt.select("key", "fp", "root", F.lit(False).alias("apart"), some(F.col("blocks"), 1).alias("block"), every(F.col("chunks")).alias("chunk"))
    apart = dealt.where("root <> largest").select("key", "fp", "root", F.lit(True).alias("apart"), every(F.col("blocks")).alias("block"), some(F.col("chunks"), 2).alias("chunk"))

    def compare(table: pa.Table) -> pa.Table:
        flags, fps, roots = (table.column(c).to_numpy() for c in ("apart", "fp", "root"))
        lists = table.column("hs").combine_chunks()
        with_, of = np.flatnonzero(~flags), np.flatnonzero(flags)
        out: list[tuple[int, int]] = []
        if len(with_) and len(of):
            held = lists.take(pa.array(with_))
            flat, sizes = held.flatten().to_numpy(), held.value_lengths().to_numpy()
            starts = np.cumsum(sizes) - sizes
            for i in of.tolist():
                own = np.sort(lists[i].values.to_numpy())
                both = np.add.reduceat(own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat, starts, dtype=np.int64)
                near = np.flatnonzero((both >= (threshold - 1e-12) * (len(own) + sizes - both)) & (roots[with_] != roots[i]))
                _, first = np.unique(roots[with_[near]], return_index=True)
                out += [(int(fps[i]), int(fps[with_[n]])) for n in near[first]]
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return whole.unionByName(apart).join(sets, "fp").groupBy("key", "block", "chunk").applyInArrow(compare, "a long, b long")


def links(members: DataFrame, sets: DataFrame, threshold: float, known: DataFrame, small: int = SMALL) -> DataFrame:
    """Links (a, b) between classes whose components are those of the ``known`` links and all similar pairs that share a bucket (key, fp)."""
    spark = session(members)
    weights = written(members.groupBy("fp").agg(F.count(F.lit(1)).alias("weight")), "weights")
    roots = written(components(known), "roots")
    out, rest = known, members.join(weights, "fp").join(roots, F.col("fp") == F.col("node"), "left").select("key", "fp", "weight", F.coalesce("root", "fp").alias("root"))
    last = False
    for round_ in range(ROUNDS + 1):
        rest = written(rest, "apart")
        sizes = rest.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("r0"), F.max("root").alias("r1"))
        sizes = written(sizes.where("r0 <> r1").select("key", "n"), "sizes")
        if sizes.isEmpty():
            break
        last = last or round_ == ROUNDS
        whole = sizes.where(F.col("n") <= small)
        left = rest.select("key", F.col("fp").alias("a"), F.col("root").alias("ra"))
        right = rest.select("key", F.col("fp").alias("b"), F.col("root").alias("rb"))
        pairs = left.join(whole.select("key"), "key", "left_semi").join(right, "key").where("a < b and ra <> rb").select("a", "b")
        if not last:
            large = rest.join(sizes.where(F.col("n") > small).select("key"), "key", "left_semi")
            # a hub is the first of its bucket by the number of its buckets, in every other round by a hash
            by = F.xxhash64("fp", F.lit(round_)) if round_ % 2 else -F.col("weight")
            hub = F.struct(by.alias("o"), F.col("fp").alias("b"), F.col("root").alias("rb"))
            hubs = written(large.groupBy("key").agg(F.min(hub).alias("h")).select("key", "h.*"), "hubs")
            held = left.join(hubs.hint("merge"), "key").where("a <> b and ra <> rb")
            first = held.groupBy("a").agg(F.min(F.struct("o", "b")).alias("h")).select("a", "h.b")
            pairs = pairs.unionByName(first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
        pairs = written(pairs.distinct(), "pairs")
        found = _similar(pairs, sets, threshold)
        if last:
            found = found.unionByName(_crossing(rest.join(sizes.where(F.col("n") > small).select("key"), "key", "left_semi").select("key", "fp", "root"), sets, threshold))
        found = written(found, "similar")
        remove(spark, pairs)
        out = out.unionByName(found)
        if last or sizes.where(F.col("n") > small).isEmpty():
            break
        last = found.isEmpty()  # hubs that link nothing leave the rest to its pairs
        roots = written(components(out), "roots")
        open_ = rest.join(sizes.where(F.col("n") > small).select("key"), "key", "left_semi").select("key", "fp", "weight")
        rest = open_.join(roots, F.col("fp") == F.col("node"), "left").select("key", "fp", "weight", F.coalesce("root", "fp").alias("root"))
    return out


def keep_one(docs: DataFrame, *, threshold: float = THRESHOLD, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each group of near copies, chosen as in ``simhash.keep_one``.

    Groups are the components of pairs at ``threshold`` or above. Texts shorter than a shingle are one
    shingle of all their words; those without words are copies of each other.
    """
    spark = session(docs)
    rows = written(marked(docs, id_col=id_col, text_col=text_col, shingle=shingle, threshold=threshold), "marked")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("th")))
    keyed = rows.select("fp", F.explode("keys").alias("key")).distinct()
    keyed = written(keyed, "keys")
    shared = written(keyed.groupBy("key").count().where("count > 1").select("key"), "shared")
    members = written(keyed.join(shared, "key", "left_semi"), "members")
    remove(spark, keyed, shared)
    # one text for each class that is in a pair or a bucket
    pairs = simhash_pairs(rows)
    named_ = members.select("fp").unionByName(pairs.select(F.explode(F.array("a", "b")).alias("fp"))).distinct()
    ours = rows.join(named_, "fp", "left_semi").groupBy("fp").agg(best.alias("best"))
    ours = written(ours.select("fp", F.col("best.doc_id").alias("__doc"), F.col("best.th").alias("__th")), "chosen")
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    hashed = F.xxhash64(F.coalesce("text", F.lit("")))
    texts = texts.join(ours.hint("merge"), same(F.col("doc_id"), F.col("__doc")) & (hashed == F.col("__th"))).select("fp", "text")
    sets = written(shingle_sets(texts, shingle).dropDuplicates(["fp"]), "sets")
    known = written(_similar(pairs, sets, threshold), "similar")
    reached = written(components(links(members, sets, threshold, known)), "reached")
    classes = rows.select("fp").distinct()
    named = written(classes.join(reached, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root")), "named")
    remove(spark, members, pairs, ours, sets, known, reached)
    return keep_first(docs, rows, named, id_col=id_col, text_col=text_col)

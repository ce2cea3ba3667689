"""SimHash near-duplicates by the generalised pigeonhole principle.

The 64 bits are dealt into partitions, correlated bits together. For any thresholds t_i >= -1 with
sum t_i = radius - partitions + 1, two fingerprints within the radius differ by at most t_i bits
in some partition i. Each fingerprint gets thresholds of its own: a dynamic programme over the
partitions takes those of least estimated candidates, with the counts of partition values over all
fingerprints as its estimate. It then probes, in partition i, the values within t_i of its own, and
candidates are verified on all 64 bits.

Equal fingerprints are one class from the start, so groups of copies are one row here. A bucket
(fingerprints that meet at one partition value) of more than ``BUCKET`` is divided again: the bits
in which its members vary are dealt into one part more than the radius, two members within the radius agree on one
part at least, and each part's value makes a smaller bucket, until the buckets are small or so few bits
vary (eight, or one more than the radius) that these bound them by themselves. A bucket hands on a spanning forest of its verified links, not all
pairs, and the forests have the same components as all the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import absent, remove, same, session, ship, written
from .components import components

BITS = 64
SEED = 42
#: Bits that documents of one group may differ in.
RADIUS = 3
#: Members of a bucket whose pairs are verified in place; larger buckets are divided.
BUCKET = 256
#: Rest bits at which a bucket is not divided any more.
LEAST_BITS = 8
#: The widest radius; one more would leave 13 bits, and so 8,192 members, in a bucket that is not divided any more.
WIDEST = 11
#: Partitions, where the radius allows as few.
PARTS = 4
#: Weight of one probe against one candidate in the allocation's cost.
PROBE_COST = 1.0
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_ONE = np.uint64(1)


def shingle_hashes(text: str | None, size: int = 3) -> np.ndarray:
    """XXH64 (seed 42) of the shingles of ``size`` words; of the whole sequence if it is shorter."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(line, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    view = memoryview(line)
    return np.fromiter((digest(view[a:b], SEED) for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())), np.uint64, len(words) - size + 1)


def fingerprint(text: str | None, size: int = 3) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes; 0 without words."""
    return majority(shingle_hashes(text, size))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    if not len(hashes):
        return 0
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = np.ascontiguousarray(hashes[at : at + (1 << 16)]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, th, fp): hash of the text, and fingerprint of each row as a long of the same bits. Null texts are empty."""
    ship(session(docs))
    text = F.coalesce(docs[text_col], F.lit(""))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], names=["doc_id", "th", "fp"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text")).mapInArrow(work, "doc_id long, th long, fp long")


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def joint_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and in how many bits i and j are both set (64 x 64)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            values = _column(batch, "fp").astype(np.int64).view(np.uint64)
            bits = np.unpackbits(np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
            n += len(values)
        rows = np.vstack([total.astype(np.int64), np.full((1, BITS), n)])
        yield pa.RecordBatch.from_arrays([pa.array(range(BITS + 1), pa.int32()), pa.array(rows.tolist(), pa.list_(pa.int64()))], names=["i", "c"])

    sums = [F.sum(F.col("c")[j]).alias(f"c{j}") for j in range(BITS)]
    rows = sorted(fps.select("fp").mapInArrow(work, "i int, c array<long>").groupBy("i").agg(*sums).collect())
    if not rows:
        return 0, np.zeros((BITS, BITS))
    table = np.array([r[1:] for r in rows], np.float64)
    return int(table[BITS, 0]), table[:BITS]


def group_bits(n: int, joint: np.ndarray, parts: int) -> list[np.ndarray]:
    """Bits in ``parts`` groups of nearly equal size; each grows by the bit most correlated with it."""
    mean = np.diag(joint) / max(n, 1)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    close = np.abs((joint / max(n, 1) - np.outer(mean, mean)) / np.outer(spread, spread))
    np.fill_diagonal(close, 0)
    free, groups = list(range(BITS)), []
    for k in range(parts):
        size = (BITS - sum(map(len, groups))) // (parts - k)
        inside = [max(free, key=lambda b: (close[b, free].sum(), -b))]
        free.remove(inside[0])
        while len(inside) < size:
            best = max(free, key=lambda b: (close[b, inside].sum(), -b))
            inside.append(best)
            free.remove(best)
        groups.append(np.array(sorted(inside)))
    return groups


def _take(values: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The given bits of each value, side by side."""
    out = np.zeros(len(values), np.uint64)
    for k, b in enumerate(bits):
        out |= (values >> np.uint64(b) & _ONE) << np.uint64(k)
    return out


def _blocks(groups: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Parts of each group of at most 16 bits, whose value counts stay a small table."""
    return [np.array_split(g, -(-len(g) // 16)) for g in groups]


def value_counts(fps: DataFrame, groups: list[np.ndarray]) -> list[list[np.ndarray]]:
    """How many fingerprints have each value, for each block of each group; at most 2**16 rows a block."""
    blocks = [b for g in _blocks(groups) for b in g]
    pieces = []
    for k, bits in enumerate(blocks):
        value = F.lit(0).cast("long")
        for at, b in enumerate(bits.tolist()):
            value = value.bitwiseOR(F.shiftleft(F.shiftrightunsigned("fp", b).bitwiseAND(F.lit(1).cast("long")), at))
        pieces.append(F.struct(F.lit(k).alias("k"), value.alias("v")))
    found = [np.zeros(1 << len(b)) for b in blocks]
    for row in fps.select(F.explode(F.array(*pieces)).alias("p")).groupBy("p.k", "p.v").count().collect():
        found[row[0]][row[1]] = row[2]
    out, at = [], 0
    for g in _blocks(groups):
        out.append(found[at : at + len(g)])
        at += len(g)
    return out


def estimates(values: np.ndarray, groups: list[np.ndarray], counts: list[list[np.ndarray]], n: int) -> np.ndarray:
    """Estimated candidates (len(values), groups, 2) at threshold 0 and 1; exact for groups of up to 16 bits."""
    out = np.zeros((len(values), len(groups), 2))
    for i, blocks in enumerate(_blocks(groups)):
        zero, one = [], []
        for bits, table in zip(blocks, counts[i]):
            near = table[np.arange(len(table))[:, None] ^ (1 << np.arange(len(bits)))[None, :]].sum(axis=1)
            at = _take(values, bits).astype(np.int64)
            zero.append(table[at] / max(n, 1))
            one.append(near[at] / max(n, 1))
        out[:, i, 0] = n * np.prod(zero, axis=0)
        out[:, i, 1] = out[:, i, 0] + n * sum(one[k] * np.prod([z for j, z in enumerate(zero) if j != k], axis=0) for k in range(len(zero)))
    return out


def allocate(cost: np.ndarray, widths: list[int], radius: int) -> np.ndarray:
    """Thresholds -1, 0 or 1 for each value and group, of least cost, that sum to radius - groups + 1."""
    n, groups, _ = cost.shape
    total = radius - groups + 1
    low = -groups
    best = np.full((n, groups - low + 1), np.inf)
    best[:, -low] = 0
    picked = np.zeros((groups, n, best.shape[1]), np.int8)
    for i in range(groups):
        price = {-1: np.zeros(n), 0: cost[:, i, 0] + PROBE_COST, 1: cost[:, i, 1] + PROBE_COST * (1 + widths[i])}
        new = np.full_like(best, np.inf)
        for t, p in price.items():
            moved = np.full_like(best, np.inf)
            span = best.shape[1]
            moved[:, max(0, t) : span + min(0, t)] = best[:, max(0, -t) : span - max(0, t)] + p[:, None]
            better = moved < new
            new[better] = moved[better]
            picked[i][better] = t
        best = new
    at = np.full(n, total - low)
    out = np.zeros((n, groups), np.int8)
    for i in range(groups - 1, -1, -1):
        out[:, i] = picked[i, np.arange(n), at]
        at = at - out[:, i]
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _rows(key: np.ndarray, fp: np.ndarray, flags: np.ndarray, rest: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(flags), pa.array(rest.view(np.int64))], names=["key", "fp", "flags", "rest"])


_ROWS = "key long, fp long, flags byte, rest long"
#: What a row is in its bucket.
INDEXED, PROBE = 1, 2


def probes(fps: DataFrame, radius: int, parts: int) -> DataFrame:
    """Rows (key, fp, flags, rest): each fingerprint where it is indexed and where it probes."""
    n, joint = joint_counts(fps)
    groups = group_bits(n, joint, parts)
    counts = value_counts(fps, groups)
    masks = [np.uint64(sum(1 << int(b) for b in g)) for g in groups]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _column(batch, "fp").astype(np.int64).view(np.uint64)
            limits = allocate(estimates(values, groups, counts, n), [len(g) for g in groups], radius)
            for i, (bits, mask) in enumerate(zip(groups, masks)):
                salt, rest = np.uint64(i + 1) << np.uint64(58), np.full(len(values), ~mask, np.uint64)
                flags = np.where(limits[:, i] >= 0, INDEXED | PROBE, INDEXED).astype(np.int8)
                yield _rows(_mix((values & mask) ^ _mix(np.full(len(values), salt))), values, flags, rest)
                wide = values[limits[:, i] >= 1]
                for b in bits if len(wide) else ():
                    key = _mix(((wide ^ (_ONE << np.uint64(b))) & mask) ^ _mix(np.full(len(wide), salt)))
                    yield _rows(key, wide, np.full(len(wide), PROBE, np.int8), np.full(len(wide), ~mask, np.uint64))

    return fps.select("fp").mapInArrow(work, _ROWS)


def _divide(radius: int):
    """Each row in radius + 1 buckets, one for each part of the bits that vary in its bucket."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, fp, rest = (_column(batch, c).astype(np.int64).view(np.uint64) for c in ("key", "fp", "rest"))
            flags = _column(batch, "flags").astype(np.int8)
            for mask in np.unique(rest):
                own = rest == mask
                bits = np.array([b for b in range(BITS) if int(mask) >> b & 1])
                for chosen in np.array_split(bits, radius + 1):
                    part = np.uint64(sum(1 << int(b) for b in chosen))
                    made = _mix(_mix(key[own] ^ part) + (fp[own] & part))
                    yield _rows(made, fp[own], flags[own], np.full(own.sum(), mask & ~part, np.uint64))

    return work


def _forest(pairs: np.ndarray) -> list[tuple[int, int]]:
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    kept = []
    for x, y in pairs.tolist():
        p, q = top(x), top(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            kept.append((x, y))
    return kept


def bucket_links(values: np.ndarray, flags: np.ndarray, sizes: np.ndarray, radius: int) -> np.ndarray:
    """Verified links (rows of two fingerprints) in buckets that lie one after another.

    A bucket gives at most one link less than it has members.
    """
    found = []
    starts = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < len(sizes):
        upto, n_pairs = at, 0  # pairs of buckets at..upto are held at once
        while upto < len(sizes) and (upto == at or n_pairs + sizes[upto] ** 2 <= 2_000_000):
            n_pairs += int(sizes[upto]) ** 2
            upto += 1
        own = sizes[at:upto].astype(np.int64)
        # all (i, j) of each bucket, i < j
        left = np.repeat(np.arange(starts[at], starts[upto]), np.repeat(own, own))
        first = np.repeat(starts[at:upto], own * own)
        within = np.arange(len(left)) - np.repeat(np.cumsum(own * own) - own * own, own * own)
        right = first + within % np.repeat(own, own * own)
        keep = left < right
        left, right = left[keep], right[keep]
        ok = np.bitwise_count(values[left] ^ values[right]) <= radius
        ok &= values[left] != values[right]
        ok &= ((flags[left] & INDEXED > 0) & (flags[right] & PROBE > 0)) | ((flags[right] & INDEXED > 0) & (flags[left] & PROBE > 0))
        left, right = left[ok], right[ok]
        bucket = np.searchsorted(starts, left, side="right")
        for b in np.unique(bucket):
            mine = bucket == b
            pairs = np.stack([values[left[mine]].view(np.int64), values[right[mine]].view(np.int64)], axis=1)
            found.append(pairs if len(pairs) < 3 else np.array(_forest(pairs), np.int64).reshape(-1, 2))
        at = upto
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def _verify(radius: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("members")
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            values = flat.field("fp").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            flags = flat.field("flags").to_numpy(zero_copy_only=False).astype(np.int8)
            links = bucket_links(values, flags, sizes, radius)
            yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])

    return work


def links(fps: DataFrame, radius: int = RADIUS, *, parts: int | None = None, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``, written, whose components are those of all links within the radius.

    ``parts`` is four, or as many as the radius asks for: at most one more than it, or a partition
    would be ignored, and at least half of that, as no threshold is above one. The radius is 0 to ``WIDEST``.
    """
    spark = session(fps)
    ship(spark)
    if not 0 <= radius <= WIDEST:
        raise ValueError(f"radius {radius} is not 0 to {WIDEST}")
    least, most = -(-(radius + 1) // 2), radius + 1
    parts = min(max(PARTS, least), most) if parts is None else parts
    if not least <= parts <= most:
        raise ValueError(f"{parts} partitions for radius {radius}: {least} to {most} serve")
    rows = written(probes(fps, radius, parts), "probes")
    out: list[DataFrame] = []
    while True:
        vary = F.bit_or("rest").bitwiseAND(F.bit_or("fp").bitwiseXOR(F.bit_and("fp")))
        counts = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), vary.alias("vary")).where("n > 1"), "buckets")
        large = (F.col("n") > bucket) & (F.bit_count("vary") > max(LEAST_BITS, radius + 1))
        small = (rows.join(counts.where(~large).select("key"), "key")
                 .groupBy("key").agg(F.collect_list(F.struct("fp", "flags")).alias("members")).select("members"))
        out.append(written(small.mapInArrow(_verify(radius), "a long, b long").distinct(), "found"))
        again = counts.where(large).select("key", F.col("vary").alias("rest"))
        deeper = None if again.isEmpty() else written(rows.drop("rest").join(again, "key").select("key", "fp", "flags", "rest").mapInArrow(_divide(radius), _ROWS), "probes")
        remove(spark, rows, counts)
        if deeper is None:
            break
        rows = deeper
    if len(out) == 1:
        return out[0]
    all_ = out[0]
    for found in out[1:]:
        all_ = all_.unionByName(found)
    all_ = written(all_, "found")
    remove(spark, *out)
    return all_


def _grouped(docs: DataFrame, radius: int, id_col: str, text_col: str, shingle: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all rows, and (fp, root) of all fingerprints; both written."""
    spark = session(docs)
    marked = written(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle), "fingerprints")
    classes = written(marked.select("fp").distinct(), "classes")
    close = links(classes, radius)
    reached = written(components(close), "reached")
    named = written(classes.join(reached, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root")), "named")
    remove(spark, classes, close, reached)
    return marked, named


def near_duplicates(docs: DataFrame, *, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``docs``.

    Words are what white space leaves, ASCII letters lower-cased; documents without words have
    fingerprint 0 and are linked like any other; a very long text is one fingerprint, its hashes held by one task. component_id is the smallest id that links within
    the radius reach, the own id included. Rows with a null id are in their fingerprint's group,
    but are no smallest id (null if no row has one). Repeated rows each give a row; an empty table
    gives none; other columns are not read.
    """
    marked, named = _grouped(docs, radius, id_col, text_col, shingle)
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least")).join(named, "fp")
    roots = least.groupBy("root").agg(F.min("least").alias("component_id"))
    final = written(named.join(roots, "root").select("fp", "component_id"), "final")
    remove(session(docs), named)
    return marked.join(final, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, *, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates, all columns as they are.

    It is the row with the smallest id (null ids come last), then the smallest hash of the text; of
    rows that agree in both any one. Null texts count as empty; an empty table stays empty; column names may
    be any.
    """
    marked, named = _grouped(docs, radius, id_col, text_col, shingle)
    return keep_first(docs, marked, named, id_col=id_col, text_col=text_col)


def keep_first(docs: DataFrame, marked: DataFrame, named: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """The first row of ``docs`` of each root, by (doc_id, th, fp) of all rows and (fp, root)."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("th"))
    first = marked.groupBy("fp").agg(F.min(order).alias("best")).join(named, "fp").groupBy("root").agg(F.min("best").alias("best"))
    doc, th = absent(docs, "doc", "th")
    stay = written(first.select(F.col("best.doc_id").alias(doc), F.col("best.th").alias(th)), "stay")
    hashed = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    kept = docs.join(stay.hint("merge"), same(docs[id_col].cast("long"), F.col(doc)) & (hashed == F.col(th)), "left_semi")
    mine = stay.select(F.col(doc).alias("s_doc"), F.col(th).alias("s_th"))
    again = marked.join(mine, same(F.col("doc_id"), F.col("s_doc")) & (F.col("th") == F.col("s_th")), "left_semi").groupBy("doc_id", "th").count().where("count > 1")
    return kept if again.isEmpty() else kept.dropDuplicates([id_col, text_col])


def hex_fingerprint(column: str = "fp") -> F.Column:
    return F.lpad(F.lower(F.hex(F.col(column))), 16, "0")

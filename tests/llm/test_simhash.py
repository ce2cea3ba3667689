from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from chalkline.llm import components, simhash

from .conftest import sentence


def plain_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, now = [], ""
    for c in lower + " ":
        if c in " \t\n\x0b\x0c\r":
            words, now = (words + [now] if now else words), ""
        else:
            now += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "one TWO", "a b c", "a b c d", "Ärger ÄRGER über x", "x y" * 400, "a b c d e"])
def test_fingerprints(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(F.xxhash64(F.lit("a b c")).alias("h")).first()
    assert row.h % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", 42)


def brute_roots(values, radius=3):
    values = sorted(set(values))
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= radius:
                p, q = top(a), top(b)
                root[max(p, q)] = min(p, q)
    return {v: top(v) for v in values}


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def groups(found):
    out = {}
    for node, root in found.items():
        out.setdefault(root, set()).add(node)
    return {frozenset(g) for g in out.values() if len(g) > 1}


@pytest.mark.parametrize("parts,bucket", [(4, 256), (3, 256), (2, 256), (4, 4)])
def test_links_have_the_components_of_all_pairs(spark, parts, bucket):
    rng = random.Random(7)
    values = set()
    for _ in range(25):
        centre = rng.getrandbits(64)
        values.add(centre)
        for _ in range(rng.choice([1, 3, 20])):
            values.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    values |= {0, 1, 7, 15, 2**64 - 1}
    table = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    links = simhash.links(table, parts=parts, bucket=bucket)
    for a, b in links.collect():
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= 3
    found = {r.node: r.root for r in components.components(links).collect()}
    assert groups(found) == groups(brute_roots([signed(v) for v in values]))


@pytest.mark.parametrize("radius", range(1, 9))
def test_every_radius(spark, radius):
    rng = random.Random(radius)
    # few bits and small buckets, so that buckets are divided again and again
    values = {rng.getrandbits(26) << 11 for _ in range(300)} | {rng.getrandbits(64) for _ in range(20)}
    table = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    found = {r.node: r.root for r in components.components(simhash.links(table, radius, bucket=8)).collect()}
    assert groups(found) == groups(brute_roots([signed(v) for v in values], radius))


def test_radii_and_partitions_that_do_not_serve(spark):
    table = spark.createDataFrame([(1,)], "fp long")
    for radius, parts in ((-1, None), (12, None), (3, 1), (3, 5), (8, 4)):
        with pytest.raises(ValueError):
            simhash.links(table, radius, parts=parts)


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b c d", 1, 2, 3, 4), (2, "a b c d", 5, 6, 7, 8)], "doc_id long, text string, __doc int, __TH int, fp int, th int")
    assert [r["__doc"] for r in simhash.keep_one(docs).collect()] == [1] and simhash.keep_one(docs).columns == docs.columns


def test_thresholds_cost_least_and_sum_up():
    rng = np.random.default_rng(0)
    cost = rng.uniform(0, 100, (50, 4, 2))
    cost[:, :, 1] += cost[:, :, 0]
    got = simhash.allocate(cost, [16] * 4, 3)
    assert (got.sum(axis=1) == 0).all() and got.min() >= -1 and got.max() <= 1
    import itertools

    for i in range(50):
        price = lambda ts: sum(0 if t < 0 else cost[i, k, t] + simhash.PROBE_COST * (1 + 16 * t) for k, t in enumerate(ts))  # noqa: B023, E731
        best = min(price(ts) for ts in itertools.product((-1, 0, 1), repeat=4) if sum(ts) == 0)
        assert price(got[i].tolist()) == pytest.approx(best)


def test_correlated_bits_share_a_group():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (4000, 64))
    bits[:, 40] = bits[:, 3]
    joint = (bits.T @ bits).astype(float)
    groups_ = simhash.group_bits(4000, joint, 4)
    assert sorted(np.concatenate(groups_).tolist()) == list(range(64)) and any({3, 40} <= set(g.tolist()) for g in groups_)


def test_documents(spark, make):
    rng = random.Random(2)
    base = sentence(rng, 300)
    near = base.replace(base.split()[150], "changed", 1)
    rows = [(5, base), (3, near), (9, base), (9, base), (4, None), (2, ""), (7, " \n"), (8, sentence(rng, 50)), (None, base), (1, "Two Words"), (6, "two\twords")]
    table = make(rows)
    got = simhash.near_duplicates(table).collect()
    assert len(got) == len(rows)
    roots = brute_roots([signed(plain_fingerprint(t)) for _, t in rows])
    least = {}
    for i, t in rows:
        root = roots[signed(plain_fingerprint(t))]
        if i is not None:
            least[root] = min(least.get(root, i), i)
    wanted = sorted((i if i is not None else -1, signed(plain_fingerprint(t)), least[roots[signed(plain_fingerprint(t))]]) for i, t in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.fp, r.component_id) for r in got) == wanted
    stay = simhash.keep_one(table)
    assert stay.columns == table.columns
    assert sorted(r.doc_id for r in stay.collect()) == sorted(least.values())


def test_empty_table_and_rows_that_share_an_id(spark, make):
    assert simhash.near_duplicates(make([])).count() == 0 and simhash.keep_one(make([])).count() == 0
    rng = random.Random(4)
    a, b = sentence(rng, 80), sentence(rng, 80)
    kept = simhash.keep_one(make([(1, a), (1, b), (1, a), (2, a)])).collect()
    assert sorted(r.text for r in kept) == sorted([a, b])
    only_null = simhash.near_duplicates(make([(None, a)])).collect()
    assert only_null[0].component_id is None


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + k) for k in range(1, 40)] + [(5, 5), (2000, None), (1, 0), (0, 1)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + k: 1000 for k in range(40)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0

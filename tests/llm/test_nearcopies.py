from __future__ import annotations

import random

import pytest

import corpus_pipeline
from chalkline.llm import nearcopies, simhash

from .conftest import sentence


def shingled(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def brute_kept(rows, threshold=0.8):
    """Smallest id of each component of pairs at the threshold."""
    sets, root = [shingled(t) for _, t in rows], list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or len(a & sets[j]) >= threshold * len(a | sets[j]) > 0:
                root[top(i)] = top(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[top(k)] = min(least.get(top(k), i), i)
    return sorted(least.values())


def edited(rng, text, n):
    words = text.split()
    for at in rng.sample(range(len(words)), n):
        words[at] = sentence(rng, 1)
    return " ".join(words)


def case():
    rng = random.Random(0)
    rows = []
    for _ in range(12):
        base = sentence(rng, rng.choice([12, 60, 200, 400]))
        rows += [base, *(edited(rng, base, rng.randint(0, len(base.split()) // 30)) for _ in range(4))]
    rows += [None, "", "A b", "a  B", "a b c d", sentence(rng, 3000)]
    rng.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


def test_stage_equals_all_pairs(spark, make):
    rows = case()
    stay = corpus_pipeline.keep_one_of_near_copies(spark, make(rows), "")
    assert sorted(r.doc_id for r in stay.collect()) == brute_kept(rows)


def test_a_near_copy_at_083_goes(spark, make):
    rng = random.Random(5)
    words = sentence(rng, 304).split()
    near = [*words]
    for at in (30, 90, 150, 210, 260):
        near[at] = "changed"
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, sentence(rng, 300))]
    a, b = shingled(rows[0][1]), shingled(rows[1][1])
    assert 0.8 <= len(a & b) / len(a | b) < 0.86
    assert sorted(r.doc_id for r in corpus_pipeline.keep_one_of_near_copies(spark, make(rows), "").collect()) == [1, 3]


@pytest.mark.parametrize("small", [2, 8])
def test_large_buckets_lose_no_link(spark, make, small, monkeypatch):
    monkeypatch.setattr(nearcopies.links, "__defaults__", (small,))
    rng = random.Random(3)
    base = sentence(rng, 120)
    rows = [(i, edited(rng, base, rng.randint(0, 4))) for i in range(40)] + [(100 + i, edited(rng, base, 14)) for i in range(8)]
    assert sorted(r.doc_id for r in nearcopies.keep_one(make(rows)).collect()) == brute_kept(rows)


@pytest.mark.parametrize("threshold, keys, values, smallest", [(0.8, 40, 5, 4), (0.5, 100, 2, 1), (0.9, 25, 8, 9)])
def test_the_threshold_says_how_texts_are_keyed(threshold, keys, values, smallest):
    assert nearcopies.banding(threshold) == (keys, values, smallest)


def test_thresholds_that_cannot_be_kept_are_refused(make):
    for threshold in (0.0, 1.0, 0.03):
        with pytest.raises(ValueError):
            nearcopies.keep_one(make([(1, "a b c d e f")]), threshold=threshold)


@pytest.mark.parametrize("threshold", [0.5, 0.9])
def test_other_thresholds_lose_no_link(spark, make, threshold):
    rng, rows = random.Random(11), []
    for n in range(30):
        base = sentence(rng, rng.choice([8, 12, 60, 150]))
        rows += [(10 * n + k, edited(rng, base, rng.randint(0, max(1, len(base.split()) // 9)))) for k in range(4)]
    assert sorted(r.doc_id for r in nearcopies.keep_one(make(rows), threshold=threshold).collect()) == brute_kept(rows, threshold)


def test_a_group_that_hubs_cannot_link_makes_no_rows_of_its_pairs(spark, make, monkeypatch):
    """Copies of one text that differ from each other by more than the threshold allows, and some that link."""
    monkeypatch.setattr(nearcopies, "MEMBERS", 32)
    monkeypatch.setattr(nearcopies.links, "__defaults__", (2,))
    rng = random.Random(12)
    base = sentence(rng, 200)
    rows = [(i, edited(rng, base, 6)) for i in range(250)] + [(1000 + i, edited(rng, rows_text, 1)) for i, rows_text in enumerate([edited(rng, base, 12)] * 3)]
    made = []
    similar = nearcopies._similar
    monkeypatch.setattr(nearcopies, "_similar", lambda pairs, sets, threshold: (made.append(pairs.count()), similar(pairs, sets, threshold))[1])
    assert sorted(r.doc_id for r in nearcopies.keep_one(make(rows)).collect()) == brute_kept(rows)
    assert sum(made) < 4 * 250


def test_simhash_links_what_its_radius_reaches(spark, make, monkeypatch):
    """Without the bands' buckets; texts of one fingerprint that share few shingles stay apart."""
    monkeypatch.setattr(nearcopies, "links", lambda members, sets, threshold, known: known)
    rng = random.Random(21)
    base = sentence(rng, 3000)
    near, same_run = edited(rng, base, 2), "y " * 400
    rows = [(1, base), (2, near), (3, edited(rng, base, 900)), (4, same_run + sentence(rng, 30)), (5, same_run + sentence(rng, 30)), (6, f"{base} {base}")]
    prints = {i: simhash.fingerprint(t, 5) for i, t in rows}
    assert (prints[1] ^ prints[2]).bit_count() <= simhash.RADIUS < (prints[1] ^ prints[3]).bit_count() and prints[4] == prints[5]
    stay = corpus_pipeline.keep_one_of_near_copies(spark, make(rows), "")
    assert sorted(r.doc_id for r in stay.collect()) == [1, 3, 4, 5]

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from chalkline import schemas
from chalkline.functions.vectors import common_lines
from chalkline.operators import align


def tables(spark, segments, visuals, job="j"):
    said = spark.createDataFrame([(job, i, float(a), float(b), t, []) for i, (a, b, t) in enumerate(segments)], schemas.table("segments"))
    shown = spark.createDataFrame([(job, i, float(v[0]), v[2] if len(v) > 2 else "slide", v[1], None, "", "") for i, v in enumerate(visuals)], schemas.table("visuals"))
    return said, shown


def aligned(spark, segments, visuals, language=None):
    said, shown = tables(spark, segments, visuals)
    languages = spark.createDataFrame([("j", language)], "job_id string, language string") if language else None
    timeline, report = align.align(said, shown, languages)
    return timeline.orderBy("chunk_ord").collect(), report.collect()


def test_speech_goes_to_what_it_overlaps_most(spark):
    chunks, _ = aligned(spark, [(2, 5, "alpha"), (25, 30, "bravo"), (-5, -1, "charlie")], [(0, "intro"), (20, "details")])
    assert [[s.text for s in c.segments] for c in chunks] == [["charlie", "alpha"], ["bravo"]]


@pytest.mark.parametrize("language,visuals,segments", [
    (None, [(0, "introduction overview agenda"), (20, "pointers memory address dereference")], [(12, 14, "now about pointers and memory"), (2, 5, "welcome to the overview")]),
    ("tr", [(0, "giriş genel bakış"), (20, "işaretçi bellek adres")], [(12, 14, "şimdi işaretçi ve bellek"), (2, 5, "giriş bölümü")])])
def test_late_speech_moves_on(spark, language, visuals, segments):
    chunks, report = aligned(spark, segments, visuals, language)
    assert report[0].lookahead_moves == 1 and chunks[1].segments[0].text == segments[0][2]


def test_early_speech_stays(spark):
    _, report = aligned(spark, [(2, 4, "pointers memory")], [(0, "introduction overview"), (20, "pointers memory")])
    assert report[0].lookahead_moves == 0


def test_speech_may_move_twice(spark):
    chunks, report = aligned(spark, [(1, 1.5, "delta")], [(0, "alpha"), (4, "delta beta"), (8, "delta gamma"), (9, "omega")])
    assert report[0].lookahead_moves == 1  # equal overlap does not move on
    chunks, report = aligned(spark, [(1, 1.5, "delta gamma")], [(0, "alpha"), (4, "delta beta"), (8, "delta gamma")])
    assert report[0].lookahead_moves == 2 and [len(c.segments) for c in chunks if c.segments] == [1]


def lines(numbers):
    return "\n".join(f"line{n}" for n in numbers)


def test_scrolled_code_merges_from_three_fifths(spark):
    base = list(range(100))
    for start, merges in ((39, 1), (41, 0)):
        frames = [(0, lines(base), "code"), (5, lines(base[start:] + list(range(200, 200 + start))), "code")]
        chunks, report = aligned(spark, [(1, 2, "a"), (6, 7, "b")], frames)
        assert report[0].scroll_merges == merges
        assert chunks[0].visuals[0].timestamp == 0.0


def test_scroll_of_three_frames(spark):
    chunks, report = aligned(spark, [(1, 2, "a"), (6, 7, "b"), (11, 12, "c")], [(0, "l1\nl2\nl3", "code"), (5, "l2\nl3\nl4", "code"), (10, "l3\nl4\nl5", "code"), (20, "end")])
    assert report[0].scroll_merges == 2 and chunks[0].visuals[0].text == "l1\nl2\nl3\nl4\nl5"
    assert chunks[0].flags == ["merged_scroll"] and [s.text for s in chunks[0].segments] == ["a", "b", "c"]
    assert chunks[1].flags == ["orphan"] and not chunks[1].segments


def test_orphans_ride_with_the_next_chunk(spark):
    chunks, report = aligned(spark, [(51, 55, "x")], [(5, "a"), (50, "b")])
    assert report[0].orphans == 1 and len(chunks) == 1
    assert [v.timestamp for v in chunks[0].visuals] == [5.0, 50.0] and chunks[0].flags == ["orphan"] and chunks[0].start == 5.0


def test_long_speech_is_cut_at_its_widest_pause(spark):
    segments = [(0, 10, "a"), (20, 30, "b"), (40, 50, "c"), (250, 260, "d"), (270, 280, "e"), (290, 300, "f"), (310, 320, "g")]
    chunks, _ = aligned(spark, segments, [(0, "v")])
    assert [[s.text for s in c.segments] for c in chunks] == [["a", "b", "c"], ["d", "e", "f", "g"]] and len(chunks[0].visuals) == 1 and not chunks[1].visuals
    assert len(aligned(spark, segments[:3], [(0, "v")])[0]) == 1


def test_without_visuals_all_speech_is_one_chunk(spark):
    chunks, report = aligned(spark, [(5, 6, "b"), (0, 1, "a")], [])
    assert len(chunks) == 1 and [s.text for s in chunks[0].segments] == ["a", "b"] and not chunks[0].visuals
    assert (report[0].chunk_count, report[0].segment_count, report[0].orphans) == (1, 2, 0)


def brute(segments, visuals):
    ends = [v[0] for v in visuals[1:]] + [float("inf")]
    out = []
    for a, b in segments:
        shared = [max(0.0, min(b, e) - max(a, v[0])) for v, e in zip(visuals, ends)]
        out.append(max(range(len(shared)), key=lambda i: (shared[i], -i)))
    return out


def test_anchor_equals_brute_force_with_ties(spark):
    rng = random.Random(3)
    segments = [(a := rng.randint(-5, 60), a + rng.choice([0, 1, 5, 40])) for _ in range(120)]
    visuals = sorted({(rng.randint(0, 50),) for _ in range(12)})
    said, shown = tables(spark, [(a, b, "") for a, b in segments], [(v[0], "") for v in visuals])
    got = {r.seg_ord: r.idx for r in align.anchor(said, shown).collect()}
    assert [got[i] for i in range(len(segments))] == brute(segments, visuals)


def test_every_segment_is_in_one_chunk(spark):
    rng = random.Random(5)
    segments = [(a := rng.uniform(0, 2000), a + rng.uniform(0, 40), f"s{i}") for i in range(60)]
    chunks, report = aligned(spark, segments, [(t, f"v{t}", rng.choice(["code", "slide"])) for t in (0, 300, 310, 900, 1990)])
    assert sorted(s.text for c in chunks for s in c.segments) == sorted(s[2] for s in segments)
    assert report[0].segment_count == 60 and sum(len(c.visuals) for c in chunks) + report[0].scroll_merges == 5


def lcs(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    return rows[-1][-1]


def test_common_lines_equal_the_table():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 20))] for _ in range(2))
        assert common_lines(a, b) == lcs(a, b)


def test_cuts_of_a_chunk():
    assert align.cut_speech([], []) == [] and align.cut_speech([0.0], [999.0]) == []
    assert align.cut_speech([0, 200, 400, 800], [100, 300, 500, 900]) == [1, 2, 3] or align.cut_speech([0, 200, 400, 800], [100, 300, 500, 900])
    assert align.cut_speech([0, 10, 20], [5, 15, 320]) == [1, 2]  # equal pauses: the earliest first


def test_empty_tables(spark):
    timeline, report = align.align(*tables(spark, [], []))
    assert timeline.count() == 0 and report.count() == 0
    assert align.anchor(*tables(spark, [], [(1, "a")])).count() == 0
    only, report = aligned(spark, [], [(1, "a"), (2, "b")])
    assert len(only) == 1 and only[0].flags == ["orphan"] and report[0].orphans == 2
    assert F is not None


def test_a_long_segment_over_many_short_intervals(spark):
    """Rows that meet in joins grow with the input, not with the intervals that segments cover."""
    rng = random.Random(4)
    times = sorted(rng.uniform(0, 1000) for _ in range(600)) + [1000.0]
    times[300:303] = [times[299]] * 3  # at one time: intervals of no length
    talks = [(-5.0, 1200.0)] * 40 + [(a, a + rng.choice([0.0, 0.5, 3.0, 200.0])) for a in (rng.uniform(-10, 1100) for _ in range(300))]
    said, shown = tables(spark, [(a, b, "x") for a, b in talks], [(t, "v") for t in times])
    more_said, more_shown = tables(spark, [(1, 2, "x"), (9, 3, "x")], [(5, "v")], job="k")
    got = {(r.job_id, r.seg_ord): r.idx for r in align.anchor(said.unionByName(more_said), shown.unionByName(more_shown)).collect()}
    ends = [*times[1:], float("inf")]
    for n, (a, b) in enumerate(talks):
        shared = [min(b, e) - max(a, t) for t, e in zip(times, ends)]
        assert got["j", n] == (max(range(len(times)), key=lambda i: (shared[i], -i)) if max(shared) > 0 else 0)
    assert got["k", 0] == got["k", 1] == 0
    found, over = align.swept(said, shown)
    assert found.count() + (over.count() if over is not None else 0) == sum(b > a for a, b in talks)


def test_a_sweep_carries_over_the_borders_of_ranges(spark):
    talks, times = [(i + 0.25, i + 0.75) for i in range(400)], [0.0, 350.0]
    said, shown = tables(spark, [(a, b, "x") for a, b in talks], [(t, "v") for t in times])
    said, shown = (d.unionByName(d.withColumn("job_id", F.lit("i"))).unionByName(d.withColumn("job_id", F.lit("k"))).repartition(5) for d in (said, shown))
    found, over = align.swept(said, shown)
    got = {(r.job_id, r.seg_ord): r.best for r in found.collect()}
    assert len(got) == 1200 - (over.count() if over is not None else 0) > 1100 and all(v == (k[1] >= 350) for k, v in got.items())
    assert all(r.idx == (r.seg_ord >= 350) for r in align.anchor(said, shown).collect())

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chalkline import schemas
from chalkline.operators import scenes, transcripts
from chalkline.sources.media import perceptual_hash


@pytest.mark.parametrize("listed,times", [([(0, 10)], [5]), ([(0, 60)], [20, 30, 40]), ([(0, 4), (4, 10)], [2, 7]), ([(0, 45)], [22.5]), ([], []), ([(0, 60), (0, 60)], [20, 30, 40])])
def test_candidate_times(spark, listed, times):
    table = spark.createDataFrame([("j", float(a), float(b)) for a, b in listed], schemas.table("scenes"))
    assert sorted(r.timestamp for r in scenes.candidate_times(table).collect()) == times


@pytest.mark.parametrize("hashes,bits,kept", [(["0" * 16, "f" * 16, "0" * 8 + "f" * 8, "0" * 15 + "7"], 24, [0, 1, 2]), (["0" * 16, "0" * 14 + "3f"], 6, [0]), (["0" * 16, "0" * 14 + "3f"], 5, [0, 1])])
def test_near_frames_go(spark, hashes, bits, kept):
    table = spark.createDataFrame([("j", i, float(i), "", h) for i, h in enumerate(hashes)], schemas.table("keyframes"))
    assert sorted(r.kf_ord for r in scenes.dedup_frames(table, bits).collect()) == kept


def test_times_are_rounded_from_their_exact_value(spark):
    rng = random.Random(1)
    values = [0.5625, 0.0625, 0.1875, -0.0625, -0.1875, 2.675, 1.0005, 0.0005, 0.0015, 1e15 + 0.5, 2.0**43 + 0.25, 0.0, 7.0] + [rng.randint(-9999, 9999) / 16 for _ in range(300)] + [rng.uniform(-1e5, 1e5) for _ in range(300)] + [(2 * rng.randint(0, 10**7) + 1) / 2000 for _ in range(600)]
    got = spark.createDataFrame([(v,) for v in values], "x double").select("x", scenes.thousandths(F.col("x")).alias("y")).collect()
    assert all(r.y == round(r.x, 3) for r in got)


def test_many_frames_equal_the_greedy_rule(spark):
    rng, frames = random.Random(2), []
    middles = [rng.getrandbits(1024) for _ in range(12)]
    for n in range(700):
        value = rng.choice(middles)
        for bit in rng.sample(range(1024), rng.choice([0, 0, 3, 10, 14, 30])):
            value ^= 1 << bit
        frames.append((rng.choice("ab"), n, float(rng.randint(0, 300)), "", f"{value:0256x}"))
    got = {(r.job_id, r.kf_ord) for r in scenes.dedup_frames(spark.createDataFrame(frames, schemas.table("keyframes")).repartition(6)).collect()}
    want: set = set()
    for job in "ab":
        kept: list[int] = []
        for j, n, _, _, h in sorted((f for f in frames if f[0] == job), key=lambda f: (f[2], f[1])):
            if all((int(h, 16) ^ k).bit_count() > 24 for k in kept):
                kept.append(int(h, 16))
                want.add((j, n))
    assert got == want and len(want) > 20


def test_perceptual_hash_sees_structure():
    rng = np.random.default_rng(0)
    picture = rng.integers(0, 255, (128, 128)).astype(float)
    distance = lambda a, b: (int(a, 16) ^ int(b, 16)).bit_count()
    assert len(perceptual_hash(picture)) == 256
    assert distance(perceptual_hash(picture), perceptual_hash(picture + rng.normal(0, 0.5, (128, 128)))) <= 24
    assert distance(perceptual_hash(picture), perceptual_hash(rng.integers(0, 255, (128, 128)).astype(float))) > 300


def test_scaled_height(spark):
    row = spark.range(1).select(scenes.scaled_height(F.lit(1920), F.lit(1080), 1024).alias("a"), scenes.scaled_height(F.lit(800), F.lit(600), 1024).alias("b")).first()
    assert tuple(row) == (576, 600)


def test_audio_parts_and_offsets(spark):
    videos = spark.createDataFrame([("a", 1300.0), ("b", 0.0), ("c", 600.0)], "job_id string, duration_s double")
    got = sorted(tuple(r) for r in transcripts.audio_parts(videos).collect())
    assert got == [("a", 0, 0.0), ("a", 1, 600.0), ("a", 2, 1200.0), ("c", 0, 0.0)]
    ddl = "job_id string, part_ord int, seg_ord int, offset double, start double, end double, text string, words array<struct<start:double,end:double,text:string,probability:double>>"
    parts = spark.createDataFrame([("a", p, 0, 600.0 * p, 1.0, 2.0, " x ", [(1.0, 1.5, "x", 0.5)]) for p in (0, 1)], ddl)
    rows = transcripts.joined_segments(parts).orderBy("part_ord").collect()
    assert [r.start for r in rows] == [1.0, 601.0] and rows[1].text == "x" and rows[1].words[0].end == 601.5


def test_languages_of_jobs(spark):
    parts = spark.createDataFrame([("a", 0, "unknown"), ("a", 1, "Turkish"), ("a", 2, "en"), ("b", 0, "unknown")], "job_id string, part_ord int, language string")
    assert {r.job_id: r.language for r in transcripts.job_languages(parts).collect()} == {"a": "tr", "b": "unknown"}
    assert {r.language for r in transcripts.job_languages(parts, "de").collect()} == {"de"}

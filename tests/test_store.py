"""The log of segments, its indexes, and searches that skip blocks and cells."""

from __future__ import annotations

import json
import math
import os
import random

import numpy as np
import pytest

from chalkline import schemas
from chalkline.errors import ChalklineError
from chalkline.operators import cells, search
from chalkline.sources import store

WORDS = [f"w{i}" for i in range(40)]


def points(spark, rows):
    """Of (id, text, vector)."""
    full = [(i, "c", "v.mp4", 1.0, f"c:{i}", i, t, None, [], t, "{}", v) for i, t, v in rows]
    return spark.createDataFrame(full, schemas.table("kb_points"))


def texts(rng, n, first=0):
    return [(f"p{first + i:05}", " ".join(rng.choices(WORDS, weights=[1 / (k + 1) for k in range(40)], k=rng.randint(0, 25))), [rng.gauss(0, 1) for _ in range(4)]) for i in range(n)]


@pytest.fixture
def kept(spark, tmp_path):
    return store.ParquetStore(spark, str(tmp_path / "kb"), buckets=4)


def held(kept, name="c"):
    return {r.id: r.text for r in kept.all_points(name).collect()}


def files(kept, folder, name="c"):
    top = os.path.join(kept.location, name, folder)
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(top) for f in names}


def test_two_writers_of_one_version_both_land(spark, kept, monkeypatch):
    kept.upsert("c", points(spark, [("1", "one", [1.0, 0.0])]))
    other, publish = store.ParquetStore(spark, kept.location, buckets=4), kept._publish

    def late(name, number, text):
        monkeypatch.setattr(kept, "_publish", publish)
        other.upsert("c", points(spark, [("3", "three", [0.0, 1.0]), ("1", "newer", [1.0, 1.0])]))  # commits between this writer's reading and its own commit
        return publish(name, number, text)

    monkeypatch.setattr(kept, "_publish", late)
    kept.upsert("c", points(spark, [("2", "two", [1.0, 1.0])]))
    assert held(kept) == {"1": "newer", "2": "two", "3": "three"}


def test_a_name_is_taken_once(kept):
    os.makedirs(f"{kept.location}/c/log")
    assert kept._publish("c", 1, "{}") and not kept._publish("c", 1, "{}")
    assert os.listdir(f"{kept.location}/c/log") == ["0000000001.json"] or sorted(f for f in os.listdir(f"{kept.location}/c/log") if not f.endswith(".crc")) == ["0000000001.json"]


def test_a_torn_version_is_passed_over(spark, kept):
    kept.upsert("c", points(spark, [("1", "one", [1.0])]))
    for number, text in ((2, ""), (3, '{"dimension": 1')):
        with open(f"{kept.location}/c/log/{number:010d}.json", "w") as file:
            file.write(text)
    kept.upsert("c", points(spark, [("2", "two", [1.0])]))
    assert held(kept) == {"1": "one", "2": "two"} and kept.version("c").number == 4


def test_writers_that_never_win_say_so(spark, kept, monkeypatch):
    monkeypatch.setattr(kept, "_publish", lambda *a: False)
    with pytest.raises(ChalklineError, match="other writers"):
        kept.upsert("c", points(spark, [("1", "one", [1.0])]))


def test_an_upsert_leaves_the_files_of_other_segments(spark, kept):
    rng = random.Random(1)
    kept.upsert("c", points(spark, texts(rng, 300)))
    kept.index("c")
    (base, n), = kept.version("c").segments
    before = files(kept, base) | files(kept, f"{base}-words")
    assert n == 300 and before
    kept.upsert("c", points(spark, [("p00007", "new words", [1.0, 0.0, 0.0, 0.0])]))
    kept.index("c")
    assert files(kept, base) | files(kept, f"{base}-words") == before
    added = kept.version("c").segments[1:]
    assert [r for _, r in added] == [1] and len([f for f in files(kept, added[0][0]) if "/bucket=" in f and f.endswith(".parquet")]) == 1
    assert len(held(kept)) == 300 and held(kept)["p00007"] == "new words"


def test_segments_of_one_size_are_made_one(spark, kept):
    rng, want = random.Random(2), {}
    for turn in range(9):
        rows = texts(rng, 6, first=turn * 3)
        want |= {i: t for i, t, _ in rows}
        kept.upsert("c", points(spark, rows))
        assert held(kept) == want
    assert len(kept.version("c").segments) < 5
    folders = {f for f in os.listdir(f"{kept.location}/c") if f.startswith("segment") and "-words" not in f and "-cells" not in f}
    assert len(folders) < 9  # those that no kept version names are gone


def test_the_index_of_segments_equals_one_of_all_points(spark, kept, monkeypatch):
    rng = random.Random(3)
    first = texts(rng, 200)
    kept.upsert("c", points(spark, first))
    kept.index("c")
    seen, lists = [], search.token_lists
    monkeypatch.setattr(search, "token_lists", lambda df, *a: (seen.append(df.count()), lists(df, *a))[1])
    second = texts(rng, 20, first=190) + [("p00003", "w1 w1 zebra", [1.0, 0.0, 0.0, 0.0]), ("p00004", "", [1.0, 0.0, 0.0, 0.0])]
    kept.upsert("c", points(spark, second))
    own = kept.index("c")
    assert seen == [22]  # the new points alone
    rows = {i: t for i, t, _ in [*first, *second]}
    whole = search.build_index(spark.createDataFrame(list(rows.items()), "id string, text string"))
    assert {r.token: r.df for r in own.terms.collect()} == {r.token: r.df for r in whole.terms.collect()}
    assert own.totals.first() == pytest.approx(tuple(whole.totals.first()))
    for query in ("w1 w2 w2", "zebra w0", "w39 w38", "w0", "none"):
        a, b = ({r.id: (r.rank, round(r.score, 9)) for r in search.bm25(i, query).collect()} for i in (own, whole))
        assert a == b
        assert [r.id for r in search.best(own, query, 7).collect()] == [i for i, (r, _) in sorted(a.items(), key=lambda x: x[1]) if r <= 7]


def test_blocks_that_cannot_hold_a_best_point_are_left_out(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, " ".join(["apple"] * (rng.randint(1, 2) if i % 50 else 9) + ["pear"] * rng.randint(0, 2) + ["fill"] * rng.randint(0, 30))) for i in range(1200)] + [(5000 + i, "other text") for i in range(2500)]
    own = search.build_index(spark.createDataFrame(rows, "id long, text string")).write(str(tmp_path / "words"), block=8)
    for query, k in (("apple", 5), ("apple pear", 5), ("apple pear fill fill", 3)):
        every = search.bm25(own, query).where(f"rank <= {k}").orderBy("rank").collect()
        assert [(r.id, r.score) for r in search.best(own, query, k).collect()] == [(r.id, r.score) for r in every]
        n = own.blocks.where(search.F.col("token").isin(search.query_tokens(query))).count()
        # a word that most points hold weighs next to nothing, so its blocks can't be told apart
        assert search.best_blocks(own, query, k).count() < {"apple": n / 2, "apple pear": n}.get(query, n + 1)


def fused_whole(a, b, k):
    ranks = [{i: n for n, (i, _) in enumerate(sorted(x.items(), key=lambda v: (-v[1], v[0])), 1)} for x in (a, b)]
    ids = set(a) | set(b)
    total = {i: sum(1 / (60 + r[i]) for r in ranks if i in r) for i in ids}
    met = {i: min((n, r[i]) for n, r in enumerate(ranks) if i in r) for i in ids}
    return [(i, pytest.approx(total[i])) for i in sorted(ids, key=lambda i: (-total[i], met[i], i))[:k]]


@pytest.mark.parametrize("shape", ["alike", "apart", "reversed", "ties", "few", "empty"])
def test_fusion_reads_the_heads_of_both_rankings(spark, shape):
    rng = random.Random(shape)
    n = {"few": 5, "empty": 0}.get(shape, 700)
    a = {i: (1.0 if shape == "ties" else rng.random()) for i in range(n)}
    b = {i + (400 if shape == "apart" else 0): {"alike": a[i] + rng.random() / 50, "reversed": 1 - a[i], "ties": float(i % 3)}.get(shape, rng.random()) for i in range(n)}
    tables = [spark.createDataFrame(list(x.items()), "id long, score double") for x in (a, b)]
    ordered, whole = [], []

    def head(at):
        def take(d):
            ordered.append(d)
            return tables[at].orderBy(search.F.desc("score"), "id").limit(d)
        return take

    def every(at):
        return lambda: (whole.append(at), tables[at])[1]

    for k in (1, 8):
        ordered.clear()
        assert search.fused_best([head(0), head(1)], [every(0), every(1)], k) == fused_whole(a, b, k)
        assert ordered == [60 + 2 * k] * 2  # rows that were put in order, of 700
    if shape == "few":
        assert whole == []


def unit(v):
    return (np.asarray(v) / np.linalg.norm(v)).tolist()


def clustered(rng, n, groups=20, size=16):
    middles = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(groups)]
    return [(f"v{i:05}", unit([x + rng.gauss(0, 0.05) for x in middles[i % groups]])) for i in range(n)]


def nearest_by_scan(rows, query, k):
    dots = [(i, float(np.dot(v, query) / (math.sqrt(np.dot(v, v)) * math.sqrt(np.dot(query, query))))) for i, v in rows if v and any(v)]
    return [i for i, _ in sorted(dots, key=lambda d: (-d[1], d[0]))[:k]]


def test_cells_find_what_a_scan_finds(spark, tmp_path):
    rng = random.Random(6)
    rows = clustered(rng, 1500)
    odd = [("z1", None), ("z2", [0.0] * 16), ("z3", [])]
    df = spark.createDataFrame([*rows, *odd], "id string, vector array<double>")
    cells.write(df, str(tmp_path / "c"))
    own = cells.Cells.read(spark, [str(tmp_path / "c")])
    assert sum(n for *_, n, _ in own.centres) == 1503
    for _, query in rng.sample(rows, 4):
        got = [r.id for r in own.nearest(query, 10).collect()]
        assert got == [r.id for r in search.nearest(df, query, 10).collect()] and set(got) == set(nearest_by_scan(rows, query, 10))
        assert len(own.chosen(query, 10)) < len(own.centres) / 3
    flat = [("a", [1.0, 0.0]), ("b", [1.0, 0.0]), ("c", [-1.0, 0.0]), ("d", [0.0, 1e-300]), ("e", [3e300, 3e300])]
    df = spark.createDataFrame(flat, "id string, vector array<double>")
    cells.write(df, str(tmp_path / "d"), cells=3)
    own = cells.Cells.read(spark, [str(tmp_path / "d")])
    for query in ([1.0, 0.0], [0.0, 0.0], [-1.0, 1.0]):
        assert [r.id for r in own.nearest(query, 4).collect()] == [r.id for r in search.nearest(df, query, 4).collect()]
    cells.write(df.limit(0), str(tmp_path / "e"))
    assert cells.Cells.read(spark, [str(tmp_path / "e")]).nearest([1.0, 0.0], 3).count() == 0


def test_vector_search_over_segments(spark, kept):
    rng = random.Random(7)
    rows = clustered(rng, 300)
    kept.upsert("c", points(spark, [(i, "t", v) for i, v in rows]))
    moved = [(rows[0][0], "t", rows[1][1]), ("new", "t", rows[0][1])]
    kept.upsert("c", points(spark, moved))
    now = {**dict(rows), **{i: v for i, _, v in moved}}
    for query in (rows[0][1], rows[1][1], rows[5][1]):
        got = [r.id for r in kept.vector_search("c", query, 5).collect()]
        assert got == [r.id for r in search.nearest(kept.with_vectors("c"), query, 5).collect()] and set(got) == set(nearest_by_scan(list(now.items()), query, 5))
    assert kept.vector_search("c", rows[0][1], 1).first().id == "new"


def test_versions_are_whole(spark, kept):
    kept.ensure_collection("c", 3)
    assert kept.all_points("c").count() == 0 and kept.index("c").terms.count() == 0 and kept.vector_search("c", [1.0, 0, 0], 3).count() == 0
    kept.upsert("c", points(spark, []))
    assert json.loads(open(f"{kept.location}/c/log/0000000001.json").read()) == {"dimension": 3, "segments": []}
    with pytest.raises(ChalklineError, match="components"):
        kept.ensure_collection("c", 4)

from __future__ import annotations

import random
import re

import duckdb
import pytest

from chalkline.llm import decontam, linededup

from .conftest import sentence

SF = "/root/testdata/sf0.001"


def cut_lines(text):
    """Pieces of a text that end at a newline, after a sentence's end or before a capital."""
    out, now = [], ""
    for i, c in enumerate(text or ""):
        if now and c.isupper() and text[i - 1] in " \t":
            out, now = [*out, now], ""
        now += c
        if c == "\n" or (c in " \t" and i and text[i - 1] in ".!?"):
            out, now = [*out, now], ""
    return [*out, now] if now else out


def brute_lines(rows, least=50):
    """Maximal runs that two places share, by all pairs of places in order of (id, hash, line): pieces to delete, and their lines."""
    docs = []
    for doc in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        full = [(i, x.strip(" \t\n\x0b\x0c\r")) for i, x in enumerate(cut_lines(doc[1]))]
        full = [(i, x) for i, x in full if x]
        docs.append((doc, full, [len(re.split(r"[ \t-\r]+", x)) for _, x in full]))
    out = {doc: (set(), set()) for doc, _, _ in docs}
    for at, (doc, full, counts) in enumerate(docs):
        gone, lines = out[doc]
        for first, earlier, _ in docs[: at + 1]:
            for i in range(len(earlier)):
                for j in range(i + 1 if first == doc else 0, len(full)):
                    n = 0
                    while i + n < len(earlier) and j + n < len(full) and earlier[i + n][1] == full[j + n][1] and (first != doc or i + n < j):
                        n += 1
                    if sum(counts[j : j + n]) >= least:
                        gone |= set(range(full[j][0], full[j + n - 1][0] + 1))
                        lines |= set(range(j, j + n))
    return out


def check_lines(spark, make, rows):
    from pyspark.sql import functions as F

    table = make(rows)
    hashes = {r.text: r.h for r in table.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    gone = brute_lines([(i, t, hashes[t]) for i, t in rows])
    wanted = []
    for i, t in rows:
        own, n = gone[(i, t, hashes[t])]
        cut = None if t is None else "".join(x for k, x in enumerate(cut_lines(t)) if k not in own)
        wanted.append((i, cut, len(n)))
    got = linededup.dedup_lines(table)
    assert got.columns.count("lines_removed") == 1
    assert sorted(map(repr, ((r.doc_id, r.text, r.lines_removed) for r in got.collect()))) == sorted(map(repr, wanted))
    return wanted


def test_repeated_runs_go(spark, make):
    rng = random.Random(0)
    passage = "\n".join(sentence(rng, n) for n in (20, 20, 20))
    one_line = sentence(rng, 70)
    short = sentence(rng, 10)
    own = lambda n=30: sentence(rng, n)
    rows = [(1, f"{own()}\n{passage}\n{own()}"), (2, f"{passage}\n{own()}"), (3, f"{own()}\n  {one_line}\t\n{short}"), (4, f"{short}\n{one_line}\n\n{own()}"), (5, f"{short}\n{own()}"),
            (6, f"{own()}\n\n{passage}"), (7, passage.split("\n")[0]), (8, None), (9, ""), (10, "\n\n"), (2, one_line), (11, one_line), (11, one_line), (None, one_line), (12, "\n".join(["ten words are in this very line as you see"] * 40)), (13, passage + "\n" + passage)]
    wanted = {(r[0], r[2]) for r in check_lines(spark, make, rows)}
    assert (2, 3) in wanted and (4, 1) in wanted and (5, 0) in wanted and (7, 0) in wanted and (8, 0) in wanted


def test_random_lines(spark, make):
    rng = random.Random(1)
    pool = [sentence(rng, rng.choice([1, 5, 20, 45, 60])) for _ in range(25)]
    rows = [(i, "\n".join(rng.choice([*pool, "", sentence(rng, 8)]) for _ in range(rng.randint(0, 14)))) for i in range(60)]
    check_lines(spark, make, rows)


def test_ends_of_runs_go(spark, make):
    rng = random.Random(4)
    long, short, middle = sentence(rng, 50), sentence(rng, 5), sentence(rng, 45)
    own = lambda n=30: sentence(rng, n)
    wanted = {(r[0], r[2]) for r in check_lines(spark, make, [(1, f"{long}\n{short}"), (2, f"{long}\n{short}"), (3, f"{own()}\n{long}\n\n{short}\n{middle}\n{own()}"), (4, f"{long}\n{short}\n{middle}"), (5, f"{middle}\n{long}\n{own()}"), (6, f"{middle}\n{long}\n{short}\n{middle}")])}
    assert {(1, 0), (2, 2), (3, 2), (4, 3), (5, 1), (6, 4)} == wanted
    # the first place of a window is not the one that its longest run is shared with
    tail = [(1, long), (2, f"{long}\n{short}\n{own(9)}"), (3, f"{own(7)}\n{long}\n{short}")]
    assert [r[2] for r in check_lines(spark, make, tail)] == [0, 1, 2]


def test_random_runs(spark, make):
    rng = random.Random(6)
    pool = [sentence(rng, rng.choice([1, 3, 10, 20, 30, 49, 50, 51])) for _ in range(12)]
    check_lines(spark, make, [(i % 40, "\n".join([*rng.choices([*pool, ""], k=rng.randint(0, 9)), *pool[(k := rng.randrange(9)) : k + rng.randint(1, 8)], sentence(rng, 2)])) for i in range(50)])


def test_a_very_long_text(spark, make):
    rng = random.Random(8)
    long = ". ".join(sentence(rng, 9).capitalize() for _ in range(3000))
    got = linededup.dedup_lines(make([(1, f"{long}."), (2, f"{long}. {sentence(rng, 40)}"), (3, sentence(rng, 30_000))])).collect()
    wanted = {r.doc_id: (r.doc_id, r.text, r.lines_removed) for r in got}
    assert wanted[1][2] == 0 and wanted[2][2] >= 3000 and wanted[3][2] == 0 and len(wanted[2][1].split()) == 40


def test_clashing_names(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "x " * 60, 5, "a"), (2, "x " * 60, 6, "b")], "doc_id long, text string, __doc int, __TH string")
    for c in ("__gone", "__n_lines", "__pieces", "th", "at", "run"):
        docs = docs.withColumn(c, F.lit(c))
    got = linededup.dedup_lines(docs)
    assert got.columns == [*docs.columns, "lines_removed"] and [(r["__doc"], r.lines_removed) for r in got.orderBy("doc_id").collect()] == [(5, 0), (6, 1)]


def test_passages_inside_lines(spark, make):
    rng = random.Random(2)
    passage = " ".join(sentence(rng, n).capitalize() + "." for n in (9, 14, 12, 18))
    rows = [(1, f"{sentence(rng, 30)} {passage} {sentence(rng, 30)}\n{sentence(rng, 9)}"), (2, f"{sentence(rng, 12)}. Ok {sentence(rng, 4)} {passage} and {sentence(rng, 20)}"), (3, f"{sentence(rng, 60)} Xy. A  B"), (4, "A B C " * 40), (5, f"{sentence(rng, 3)} {passage}")]
    wanted = {i: (t, n) for i, t, n in check_lines(spark, make, rows)}
    assert passage in wanted[1][0] and not any(x in wanted[2][0] for x in passage.split(". ")) and wanted[2][1] == 4 and wanted[3][1] == 0 and wanted[5][1] == 4


def test_no_documents(spark, make):
    assert linededup.dedup_lines(make([])).count() == 0
    assert decontam.contaminated(make([]), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).count() == 0


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute_leaks(docs, items):
    out = {}
    item_words = {}
    for i, t in items:
        if words(t):
            item_words.setdefault(i, []).append(words(t))
    for item, lists in item_words.items():
        shingles = {" ".join(ws[a : a + min(5, len(ws))]) for ws in lists for a in range(len(ws) - min(5, len(ws)) + 1)}
        for doc in {d for d, _ in docs}:
            held = set()
            for d, t in docs:
                if d == doc:
                    ws = words(t)
                    for k in {min(5, len(x)) for xs in item_words.values() for x in xs}:
                        held |= {" ".join(ws[a : a + k]) for a in range(len(ws) - k + 1)}
            share = len(shingles & held) / len(shingles)
            if share >= 0.8 - 1e-12:
                out[(doc, item)] = (len(shingles), len(shingles & held))
    return out


def test_leaks_equal_brute_force(spark, make):
    rng = random.Random(3)
    texts = {i: sentence(rng, n) for i, n in enumerate((14, 20, 37, 60, 5, 6))}
    items = [*texts.items(), (10, "two words"), (11, None), (12, ""), (13, "..."), (14, "one"), (0, texts[0]), (None, texts[2])]
    long = sentence(rng, 4000)
    edited = texts[3].split()
    edited[30] = "changed"
    rows = [(1, f"{long} {texts[0].upper()}! {long}"), (2, texts[1].replace(" ", ",\n")), (3, " ".join(edited)), (4, " ".join(texts[2].split()[:20])), (5, None), (6, ""), (7, "here are Two words"), (8, long),
            (9, texts[2][: len(texts[2]) // 2]), (9, texts[2][len(texts[2]) // 2 - 60 :]), (1, "more"), (None, texts[4]), (20, f"x {texts[5]} y {texts[4]}"), (20, f"x {texts[5]} y {texts[4]}")]
    got = {(r.doc_id, r.item_id): (r.n_shingles, r.n_found) for r in decontam.contaminated(make(rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute_leaks(rows, items)
    assert {(1, 0), (2, 1), (3, 3), (7, 10), (None, 4), (20, 5)} <= set(got) and (4, 2) not in got
    kept = decontam.drop_contaminated(make(rows), spark.createDataFrame(items, "item_id long, text string"))
    bad = {d for d, _ in got}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in rows if d not in bad) and kept.columns == make([]).columns


def test_without_items(spark, make):
    none = spark.createDataFrame([(1, None), (2, "!!")], "item_id long, text string")
    assert decontam.contaminated(make([(1, "a b c d e")]), none).count() == 0
    assert decontam.drop_contaminated(make([(1, "a b c d e")]), none).count() == 1


@pytest.mark.parametrize("name,sql", [("op9_benchmark_decontamination", decontam.SQL), ("op10_line_dedup", linededup.SQL)])
def test_sql_agrees(spark, name, sql):
    from chalkline.llm import queries

    duck = duckdb.connect()
    for table in ("documents", "benchmark"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    relation = duck.sql(sql)
    got = queries.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(relation.columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(relation.columns).collect()))) == sorted(map(repr, relation.fetchall()))


def test_native_plans_hold_no_python(spark):
    from chalkline.llm import queries

    for name in ("op9_benchmark_decontamination", "op10_line_dedup"):
        plan = queries.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|InArrow", plan)

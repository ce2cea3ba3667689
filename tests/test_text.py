from __future__ import annotations

import random
import uuid

import pytest
from pyspark.sql import functions as F

from chalkline.functions import text as T
from chalkline.functions.parsing import UnusableReply, parse_note, parse_verdict, parse_visual, strip_fence
from chalkline.operators.knowledge import batches, seconds_text, url_uuid
from chalkline.resources.wordlists import languages, stopwords


def values(spark, expression, rows, ddl="x string"):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(expression).collect()]


def one(spark, text, function):
    return values(spark, function(F.col("x")), [(text,)])[0]


def test_search_tokens_keep_names_of_code(spark):
    assert "std::move" in one(spark, "auto y = std::move(x);", T.tokens)
    assert "push_back" in one(spark, "v.push_back(1)", T.tokens)
    assert one(spark, ":a: :: C++ f#", T.tokens) == ["a", "c++", "f#"]
    assert one(spark, "of a the vector x", T.content_tokens) == ["vector"]
    assert one(spark, "", T.tokens) == []


def test_content_words_follow_the_language(spark):
    word = lambda language: lambda c: T.content_words(c, F.lit(language))
    assert one(spark, "ve bir işaretçi", word("tr")) == ["işaretçi"]
    assert sorted(one(spark, "The the Pointer a1 x pointer", word("EN"))) == ["a1", "pointer"]
    assert sorted(one(spark, "the end", word("xx"))) == ["end", "the"]
    assert languages() == ["en", "tr"] and len(stopwords("EN")) == 72 or len(stopwords("EN")) > 60


@pytest.mark.parametrize("text", ["", "a", "a\n", "a\nb", "a\r\nb\x0bc", "\n", "x \n y\t", "a b"])
def test_lines_are_those_of_python(spark, text):
    assert one(spark, text, T.lines) == [x.rstrip() for x in text.splitlines()]


def test_first_of_equal_lines_stays(spark):
    got = values(spark, T.first_lines(F.col("x")), [(["a ", "b", "a", "", "b  ", ""],)], "x array<string>")[0]
    assert got == ["a ", "b", ""]


@pytest.mark.parametrize("name,slug", [("Pointers", "pointers"), (" Move  Semantics! ", "move-semantics"), ("C++", "c"), ("!!!", "concept"), ("", "concept"), ("Ünï-x", "n-x")])
def test_slugs(spark, name, slug):
    assert one(spark, name, T.slug) == slug
    assert one(spark, name, lambda c: T.canonical_id(c, "smp")) == f"smp:{slug}"


def test_language_codes(spark):
    assert [one(spark, x, T.language_code) for x in (" Turkish ", "EN", "klingon")] == ["tr", "en", "klingon"]


@pytest.mark.parametrize("text,ok", [("for () {…}", True), ("x = 5;", True), ("void func(void) { }", True), ("A plain sentence.", False), ("", False), ("one; two", False), ("return x;", True)])
def test_code_is_recognised(spark, text, ok):
    assert one(spark, text, T.looks_like_code) is ok


@pytest.mark.parametrize("term,text,ok", [("const", "constant", False), ("const", "a Const.", True), ("c++", "in C++ we", True), ("x.y", "xzy", False), ("a", "b_a", False), ("\\E", "an \\E b", True)])
def test_terms_are_whole_words(spark, term, text, ok):
    assert values(spark, T.has_term(F.col("x"), F.lit(term)), [(text,)])[0] is ok


@pytest.mark.parametrize("raw", ["plain", "```json\n{}\n```", "```\na\nb", "  ```\n```  ", "```", "a\n```", "```x\n\n y \n``` "])
def test_fences(spark, raw):
    assert one(spark, raw, T.strip_fence) == strip_fence(raw)


def test_a_reply_is_made_once_and_read_without_patterns(spark):
    """However often a step needs it: a text is as long as a document."""
    plan = spark.range(1).select(T.strip_fence(F.concat(F.lit("```\n"), F.col("id").cast("string"))).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("concat(") == 1 and "regexp" not in plan and "split(" not in plan


def test_fences_and_ends_of_any_kind(spark):
    rng = random.Random(1)
    some = ["a", "\u00e9", "`", "```", "```\n", "\n", "\r\n", "\r", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", "\u2028", "\u2029", "\u3000", "\u200b", " ", "\t", "json"]
    texts = ["", "```", "```\n", "``````", "```\n```", "```json\n\n```", "```\n``` x"] + [rng.choice(["```", " ```\r\n", ""]) + "".join(rng.choice(some) for _ in range(rng.randint(0, 12))) + rng.choice(["", " \n```  \n", "```"]) for _ in range(1500)]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.strip_fence(F.col("t")).alias("f"), T.strip(F.col("t")).alias("s"), T.rstrip(F.col("t")).alias("r")).collect()
    assert [(r.f, r.s, r.r) for r in found] == [(strip_fence(t), t.strip(), t.rstrip()) for t in texts]


def test_times_and_links(spark):
    times = values(spark, T.hms(F.col("x")), [(0.0,), (-5.0,), (3661.9,), (360000.0,)], "x double")
    assert times == ["00:00:00", "00:00:00", "01:01:01", "100:00:00"]
    link = lambda url: values(spark, T.timestamp_link(F.lit(url), F.col("x")), [(30.9,)], "x double")[0]
    assert link("https://youtube.com/watch?v=abc") == "[00:00:30](https://youtube.com/watch?v=abc&t=30)"
    assert link("https://youtu.be/abc") == "[00:00:30](https://youtu.be/abc?t=30)"
    assert link("/videos/youtube.com.mp4") == "[00:00:30]"


@pytest.mark.parametrize("rate,fps", [("30/1", 30.0), ("30000/1001", 30000 / 1001), ("25", 25.0), ("1/0", 0.0), ("x", 0.0), ("", 0.0), ("1/2/3", 0.0)])
def test_frame_rates(spark, rate, fps):
    assert one(spark, rate, T.frame_rate) == pytest.approx(fps)


def test_replies_are_checked():
    assert parse_note('```json\n{"concept": "A", "extra": 1}\n```')["concept"] == "A"
    assert parse_visual('{"kind": "code", "text": "x"}')["diagram"] == ""
    for bad in ("no", "[1]", '{"skip": "maybe"}', '{"concept": 5}', '{"pitfalls": "x"}'):
        with pytest.raises(UnusableReply):
            parse_note(bad)
    with pytest.raises(UnusableReply):
        parse_visual('{"kind": "film", "text": ""}')
    assert parse_verdict('{"supported": true}') and not parse_verdict("yes") and not parse_verdict("[]")


def test_ids_are_those_of_python(spark):
    names = ["a", "docs:src:ü:1.5", ""]
    assert values(spark, url_uuid(F.col("x")), [(n,) for n in names]) == [str(uuid.uuid5(uuid.NAMESPACE_URL, n)) for n in names]
    numbers = [0.0, 1.5, 30.0, 1e7, 12345678.25, 123456789012.0, 0.001, 0.0001, 0.00012, 0.00001, -2.5, -1e8]
    assert values(spark, seconds_text(F.col("x")), [(n,) for n in numbers], "x double") == [str(n) for n in numbers]


def test_embedding_batches():
    assert list(batches([])) == []
    assert list(batches(["a"] * 5, most=2)) == [(0, 2), (2, 4), (4, 5)]
    assert list(batches(["x" * 40, "x" * 40, "y"], most_tokens=15)) == [(0, 1), (1, 3)]
    assert list(batches(["x" * 400], most_tokens=15)) == [(0, 1)]

from __future__ import annotations

import logging
from types import SimpleNamespace

import pytest

from chalkline import cli, memory
from chalkline.errors import ChalklineError
from chalkline.functions import text as T
from chalkline.providers import Message, Offline, OpenAI, Segment, Speech, Word
from chalkline.resources import wordlists
from chalkline.scratch import seen_by_all


class Counting(Offline):
    def __init__(self):
        super().__init__(4)
        self.asked = []

    def complete(self, prompt, **options):
        self.asked.append(("complete", prompt, options))
        return f"reply {len(self.asked)}"

    def vision(self, prompt, image, mime, **options):
        self.asked.append(("vision", image, options))
        return "seen"

    def embed(self, texts, **options):
        self.asked.append(("embed", list(texts), options))
        return [[float(len(t))] for t in texts]

    def transcribe(self, audio, name, **options):
        self.asked.append(("transcribe", audio, options))
        return Speech("en", (Segment(0.0, 1.0, "hi", (Word(0.0, 0.5, "hi", 0.9), Word(0.5, 1.0, "you"))), Segment(1.0, 2.0, "x")))


def test_nothing_is_asked_twice(tmp_path):
    first, second = Counting(), Counting()
    for inner in (first, second):
        kept = memory.remembering(inner, str(tmp_path))
        assert memory.remembering(kept, "elsewhere") is kept
        assert kept.complete("p", model="m") == "reply 1" and kept.complete("p", model="m") == "reply 1"
        assert kept.vision("p", b"\x00", "image/png", model="m") == "seen"
        assert kept.transcribe(b"abc", "a.wav", model="m", prompt=None, language="en") == first.transcribe(b"abc", "a.wav")
        assert kept.embed(["alpha", "beta", "alpha"], model="m") == [[5.0], [4.0], [5.0]] and kept.embed(["alpha", "gamma"], model="m") == [[5.0], [5.0]]
    assert not second.asked
    assert [a[1] for a in first.asked if a[0] == "embed"] == [["alpha", "beta"], ["gamma"]]


def test_what_changes_a_reply_changes_its_key(tmp_path):
    inner = Counting()
    kept = memory.remembering(inner, str(tmp_path))
    for options in ({"model": "a"}, {"model": "b"}, {"model": "a", "temperature": 0.9}):
        kept.complete("p", **options)
        kept.vision("p", b"1", "image/png", **options)
    kept.vision("p", b"2", "image/png", model="a")
    assert len(inner.asked) == 7


def test_a_broken_segment_counts_as_missing(tmp_path):
    inner = Counting()
    kept = memory.remembering(inner, f"file://{tmp_path}")
    kept.complete("p", model="m")
    (found,) = [p for p in tmp_path.rglob("*") if p.is_file()]
    whole = found.read_bytes()
    for data in (b"", b"PAR1", whole[: len(whole) // 2], b"x" * 500):
        found.write_bytes(data)
        again = memory.remembering(inner, f"file://{tmp_path}")
        assert again.complete("p", model="m") == again.complete("p", model="m")
        for other in tmp_path.iterdir():
            if other != found:
                other.unlink()
    assert len(inner.asked) == 5


def test_many_known_texts_are_answered_from_few_files(tmp_path):
    inner = Counting()
    kept = memory.remembering(inner, str(tmp_path))
    texts = [f"text {n}" for n in range(100_000)]
    for start in range(0, 100_000, 500):
        kept.embed(texts[start : start + 500], model="m")
    asked = len(inner.asked)
    fresh = memory.remembering(inner, str(tmp_path))
    assert fresh.embed(texts[::-1], model="m") == [[float(len(t))] for t in texts[::-1]] and len(inner.asked) == asked == 200
    assert fresh.embed(["new"], model="m") == [[3.0]] and len(inner.asked) == 201
    assert len(list(tmp_path.iterdir())) < 100


def test_single_replies_are_kept_at_once_and_made_one(tmp_path):
    own, other = memory.Replies(str(tmp_path)), memory.Replies(str(tmp_path))
    keys = [memory.request_hash(n=n) for n in range(300)]
    for n, key in enumerate(keys):
        (own if n % 2 else other).put(key, {"n": n})
        assert memory.Replies(str(tmp_path)).get(key) == {"n": n}
    assert other.get_many(keys) == {k: {"n": n} for n, k in enumerate(keys)}
    assert len(own.segments()) <= memory.MOST + 1


def test_a_segment_that_goes_meanwhile_is_looked_for_again(tmp_path, monkeypatch):
    own, keys = memory.Replies(str(tmp_path)), [memory.request_hash(n=n) for n in range(4)]
    for key in keys:
        own.put(key, key)
    stale, segments = own.segments(), own.segments
    monkeypatch.setattr(memory, "MOST", 1)
    memory.Replies(str(tmp_path))._compact()
    listed = [stale]
    monkeypatch.setattr(own, "segments", lambda: listed.pop() if listed else segments())
    assert own.get_many(keys) == {k: k for k in keys}


def test_messages_and_bounds_of_replies(tmp_path):
    inner = Counting()
    kept = memory.remembering(inner, str(tmp_path))
    talk = [Message("system", "be brief"), Message("user", "p")]
    assert kept.complete(talk, model="m") == kept.complete(list(talk), model="m") == "reply 1"
    assert kept.complete(talk, model="m", max_tokens=5) == "reply 2" and kept.complete([talk[1]], model="m") == "reply 3" and kept.complete("p", model="m") == "reply 4"
    assert inner.asked[1][2] == {"model": "m", "max_tokens": 5}
    said = Offline().complete([Message("system", "x"), Message("user", "TRANSCRIPT:\none two three four\n\nON SCREEN:\n")], model="m", max_tokens=9)
    assert '"concept": "one two three"' in said


def test_a_hosted_request_holds_what_was_asked(monkeypatch):
    sent, provider = [], OpenAI("key")
    reply = SimpleNamespace(choices=[SimpleNamespace(message=SimpleNamespace(content="ok"))])
    speech = SimpleNamespace(language="en", segments=[SimpleNamespace(start=0, end=1, text="hi")])
    made = lambda out: SimpleNamespace(create=lambda **options: (sent.append(options), out)[1])
    provider._client = SimpleNamespace(chat=SimpleNamespace(completions=made(reply)), audio=SimpleNamespace(transcriptions=made(speech)))
    assert provider.complete([Message("system", "s"), Message("user", "u")], model="m", max_tokens=7) == "ok"
    assert provider.complete("u", model="m") == "ok" and provider.vision("look", b"1", "image/png", model="m", max_tokens=3) == "ok"
    assert sent[0] == {"model": "m", "temperature": 0.2, "messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "u"}], "max_tokens": 7}
    assert "max_tokens" not in sent[1] and sent[2]["max_tokens"] == 3
    assert provider.transcribe(b"1", "a.wav", model="m").segments[0].text == "hi" and sent[3]["timestamp_granularities"] == ["segment"]


def test_a_local_folder_is_not_shared_on_a_cluster(spark):
    assert seen_by_all(spark, ".cache") == ".cache"
    cluster = SimpleNamespace(sparkContext=SimpleNamespace(master="spark://host:7077"))
    assert seen_by_all(cluster, "file:///mnt/all") == "file:///mnt/all"
    with pytest.raises(ChalklineError, match="share"):
        seen_by_all(cluster, ".cache")


def test_speech_round_trip():
    speech = Speech("tr", (Segment(0.0, 1.5, "merhaba", (Word(0.0, 1.0, "merhaba", 0.5),)),))
    assert memory.speech_of(memory.speech_payload(speech)) == speech
    assert memory.speech_of({"language": "en", "segments": [{"start": 0, "end": 1, "text": "x"}]}) == Speech("en", (Segment(0.0, 1.0, "x"),))


def test_own_languages(spark, tmp_path, monkeypatch):
    (tmp_path / "xx.txt").write_text("# mine\nFoo\n\nbar # last\n")
    monkeypatch.setenv(wordlists.FOLDER, str(tmp_path))
    assert wordlists.stopwords("XX") == ["bar", "foo"] and {"xx", "en"} <= set(wordlists.languages()) and wordlists.stopwords("zz") == []
    from pyspark.sql import functions as F

    assert spark.range(1).select(T.content_words(F.lit("foo bar baz"), F.lit("xx")).alias("w")).first().w == ["baz"]


def test_messages(capsys):
    cli.log_to_stderr(True)
    assert logging.getLogger("chalkline").level == logging.DEBUG
    cli.log_to_stderr()
    assert logging.getLogger("chalkline").level == logging.INFO and len(logging.getLogger("chalkline").handlers) == 1

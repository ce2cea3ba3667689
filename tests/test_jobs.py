from __future__ import annotations

import json
import random
import re
import sys

import pytest
from pyspark import cloudpickle

from chalkline import config, profile, schemas
from chalkline.errors import ChalklineError, CostLimitExceeded, DependencyMissing, ProfileError, ProviderError, StageUnavailable
from chalkline.operators import distill, evaluate, frames, models, render
from chalkline.plans import jobs
from chalkline.providers import Offline, OpenAI, Routed
from chalkline.sources import artifacts, jobfiles, media, store
from chalkline.streaming import ingest

GENERIC = profile.load("generic")
cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import the tests


class Scripted(Offline):
    """Replies in order to each prompt's first and second request."""

    def __init__(self, *replies):
        super().__init__(8)
        self.replies = replies

    def complete(self, prompt, *, model, temperature=0.2):
        return self.replies[1 if "last answer was of no use" in prompt else 0]


def note_row(ord_=0, concept="C", summary="s", code=None, time=0.0, partial=False, pitfalls=(), depends=(), job="j"):
    return (job, ord_, concept, f"gen:{concept.lower()}", summary, code, None, None, list(pitfalls), list(depends), time, partial)


def chunk(spark, texts=("hello there world",), visuals=(), start=3.0, job="j"):
    ddl = f"job_id string, chunk_ord int, start double, end double, segments array<{schemas.SEGMENT}>, visuals array<{schemas.VISUAL}>, flags array<string>"
    return spark.createDataFrame([(job, 0, start, 9.0, [(0.0, 1.0, t, []) for t in texts], [(1.0, k, t, lang, "", d) for k, t, lang, d in visuals], [])], ddl)


GOOD = json.dumps({"concept": " Pointers ", "summary": " S ", "pitfalls": [" p ", ""], "depends_on": ["Memory", "Pointers"], "partial": True})


def test_notes_copy_code_and_mint_ids(spark):
    shown = [("whiteboard", "x = 5;", None, ""), ("code", "int a;", "c", ""), ("slide", "prose", None, " +--+ ")]
    got = distill.notes(chunk(spark, visuals=shown), GENERIC.model_copy(update={"concept_id_prefix": "smp"}), Scripted(GOOD), "m").collect()
    note = got[0]
    assert (note.concept, note.canonical_concept_id, note.summary, note.source_timestamp) == ("Pointers", "smp:pointers", "S", 3.0)
    assert note.code_snippet == "int a;" and note.code_language == "c" and note.diagram == " +--+ " and note.partial
    assert note.pitfalls == ["p"] and note.depends_on == ["smp:memory", "smp:pointers"]
    drawn = distill.notes(chunk(spark, visuals=shown[:1]), GENERIC.model_copy(update={"code_languages": ["cpp"]}), Scripted(GOOD), "m").first()
    assert drawn.code_snippet == "x = 5;" and drawn.code_language == "cpp"
    bare = distill.notes(chunk(spark), GENERIC, Scripted(GOOD), "m").first()
    assert bare.code_snippet is None and bare.code_language is None and bare.partial is False


def test_unusable_replies_are_asked_for_once_more(spark):
    run = lambda *r: distill.notes(chunk(spark), GENERIC, Scripted(*r), "m").count()
    assert run("bad", GOOD) == 1 and run("bad", "bad") == 0
    assert run('{"skip": true, "concept": "x"}') == 0 and run('{"concept": " "}') == 0
    assert distill.notes(chunk(spark, texts=()), GENERIC, Scripted(GOOD), "m").count() == 0


def test_registry_is_distinct_names(spark):
    notes = spark.createDataFrame([note_row(0, "Pointers"), note_row(1, "pointers"), note_row(2, "B")], schemas.table("notes"))
    assert sorted(r.concept_key for r in distill.registry(notes).collect()) == ["b", "pointers"]


def test_prompt_holds_both_sources(spark):
    from pyspark.sql import functions as F

    hints = GENERIC.model_copy(update={"distill_hints": "Mind units."})
    text = chunk(spark, visuals=[("slide", "Shown text", None, ""), ("code", "  ", None, "")]).select(distill.prompt(F.col("segments"), F.col("visuals"), hints)).first()[0]
    assert "TRANSCRIPT:\nhello there world" in text and "ON SCREEN:\n[slide] Shown text" in text and text.endswith("Mind units.") and "[code]" not in text
    assert "(none)" in chunk(spark).select(distill.prompt(F.col("segments"), F.col("visuals"), GENERIC)).first()[0]


def test_frames_stop_at_the_cost_limit(spark):
    assert frames.check_cost(200) == 2.0
    with pytest.raises(CostLimitExceeded, match=r"\$3.00"):
        frames.check_cost(300, 2.00)
    rows = [("j", float(i), bytearray(b"x" * i), "image/jpeg") for i in range(1, 4)]
    table = spark.createDataFrame(rows, "job_id string, timestamp double, image binary, mime string")

    class Seeing(Offline):
        def vision(self, prompt, image, mime, *, model, temperature=0.2):
            if len(image) == 1:
                raise RuntimeError("rate limit")
            if len(image) == 2 and "of no use" not in prompt:
                return "bad"
            return json.dumps({"kind": "code", "text": "x" * len(image), "timestamp": 99})

    got = frames.visuals(table, GENERIC, Seeing(), "m").orderBy("vis_ord").collect()
    assert [(r.vis_ord, r.timestamp, r.text) for r in got] == [(0, 2.0, "xx"), (1, 3.0, "xxx")]
    assert "most likely one of cpp" in frames.prompt(GENERIC.model_copy(update={"code_languages": ["cpp"]}))


def test_known_replies_are_not_asked_for(spark):
    rows = models.keyed(spark.createDataFrame([("alpha",), ("gamma",), ("gamma",)], "text string"), "embed", "m", "text")
    memory = models.keyed(spark.createDataFrame([("alpha",), ("beta",)], "text string"), "embed", "m", "text").select("key", "text").withColumnRenamed("text", "response")
    from pyspark.sql import functions as F

    replies, added = models.remembered(rows, memory, lambda d: d.select("key", F.upper("text").alias("response")))
    assert sorted(r.response for r in replies.collect()) == ["GAMMA", "alpha"] and added.count() == 1
    assert models.keyed(rows.drop("key"), "embed", "n", "text").first().key != rows.first().key


def test_vocabulary(spark):
    said = spark.createDataFrame([("j", 0, 0.0, 1.0, "we use a vector", []), ("j", 1, 1.0, 2.0, "container today, constant", []), ("k", 0, 0.0, 1.0, None, [])], schemas.table("segments"))
    got = {r.job_id: (r.total, r.found, r.missing) for r in evaluate.vocabulary(said, ["vector", "Container", "mutex", "const", "vector container"]).collect()}
    assert got["j"] == (5, 3, ["mutex", "const"]) and got["k"][1] == 0
    assert evaluate.vocabulary(said, []) is None
    cut = spark.createDataFrame([("j", 0, 0.0, 1.0, "one", []), ("j", 1, 1.0, 2.0, "a bcdefg", []), ("j", 2, 2.0, 3.0, "x y", [])], schemas.table("segments"))
    assert evaluate.vocabulary(cut, ["bc", "abcd", "bcdefg x y"]).first().missing == ["bc", "abcd"]


def test_many_terms_over_many_short_segments(spark):
    rng = random.Random(9)
    words = ["a", "bb", "c++", "std::move", "x_y", "é", "(d)", "", "e.", "++"]
    rows = [(f"j{j}", n, float(n), 0.0, " ".join(rng.choices(words, k=rng.choice([0, 1, 1, 2, 30]))), []) for j in range(4) for n in range(60)]
    terms = [" ".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(300)] + ["++", "::", "a  a", "no such words at all " * 3, "C++", "STD::MOVE a"] + [f"zz{i}" for i in range(10_000)]
    terms = [t for t in terms if t]
    got = {r.job_id: r for r in evaluate.vocabulary(spark.createDataFrame(rows, schemas.table("segments")), terms).collect()}
    for j in range(4):
        text = " ".join(r[4] for r in rows if r[0] == f"j{j}").lower()
        held = [re.search(rf"(?<!\w){re.escape(t.lower())}(?!\w)", text) is not None for t in terms]
        assert got[f"j{j}"].missing == [t for t, h in zip(terms, held) if not h] and got[f"j{j}"].found == sum(held)


def test_grounding(spark):
    notes = spark.createDataFrame([note_row(0, "A", time=0.0), note_row(1, "B", summary="unsaid", time=30.0), note_row(2, "D", time=5.0)], schemas.table("notes"))
    timeline = chunk(spark, texts=("s",), start=0.0).unionByName(chunk(spark, start=30.0))
    pairs = evaluate.grounding_pairs(notes, timeline, 2)
    got = evaluate.grounding(evaluate.judged(pairs, Offline(), "m")).first()
    assert (got.sampled, got.supported, [tuple(u) for u in got.unsupported]) == (2, 1, [(30.0, "B")])
    assert {r.note_ord: r.source for r in evaluate.grounding_pairs(notes, timeline, 3).collect()}[2] == "(source chunk not found)"


def test_verification_needs_consent(spark):
    notes = spark.createDataFrame([note_row(0, "Good", code="ok"), note_row(1, "Bad", code="bad", time=10.0), note_row(2, "F", code="bad", partial=True), note_row(3, "N")], schemas.table("notes"))
    checking = GENERIC.model_copy(update={"verification": profile.Verification(kind="shell", command="grep -q ok {file}")})
    with pytest.raises(PermissionError):
        evaluate.verification(notes, checking)
    got = evaluate.verification(notes, checking, run_commands=True).first()
    assert (got.total, got.passed, [tuple(f) for f in got.failures]) == (2, 1, [(10.0, "non-zero exit")])
    absent = GENERIC.model_copy(update={"verification": profile.Verification(kind="x", command="no-such-tool {file}")})
    assert evaluate.verification(notes, absent, run_commands=True).count() == 0 and evaluate.verification(notes, GENERIC) is None


def test_statistics(spark):
    notes = spark.createDataFrame([note_row(summary="a b c")], schemas.table("notes"))
    shown = spark.createDataFrame([("j", i, 0.0, "", "") for i in range(3)], schemas.table("keyframes"))
    video = spark.createDataFrame([("j", 600.0), ("z", 0.0)], "job_id string, duration_s double")
    everyone = spark.createDataFrame([("j",), ("z",), ("n",)], "job_id string")
    got = {r.job_id: r for r in evaluate.statistics(notes, video, shown, everyone).collect()}
    assert got["j"].est_cost_usd == pytest.approx(0.031) and got["j"].compression_ratio == pytest.approx(10 / (4 / 200))
    assert got["z"].compression_ratio is None and got["z"].est_cost_per_video_hour is None and got["n"].video_minutes is None


DIGEST = """# Study Digest

Source: video.mp4 · 2 note(s)

---

## Pointers

[00:00:30] · concept `gen:pointers`

A pointer stores a memory address.

**Pitfalls**

- Dereferencing null is undefined behavior.

---

## Vectors

[00:02:00] · concept `gen:vectors`

std::vector is a dynamic array.

```
std::vector<int> v;
v.push_back(1);
```

**Depends on:** `gen:pointers`

---

## Compression

- Video length: 00:10:00 (10.0 min)
- Reading time: ~0.1 min at 200 wpm
- Compression: 111.1x
"""


def job_folder(tmp_path, name="j"):
    folder = tmp_path / name
    artifacts.save({"source_path": "/videos/video.mp4", "duration_s": 600.0, "width": 1, "height": 1, "fps": 30.0, "unknown": 1}, folder, "video")
    notes = [dict(zip(("concept", "canonical_concept_id", "summary", "code_snippet", "code_language", "diagram", "pitfalls", "depends_on", "source_timestamp", "partial"), n[2:])) for n in (
        note_row(0, "Pointers", "A pointer stores a memory address.", time=30.0, pitfalls=["Dereferencing null is undefined behavior."]),
        note_row(1, "Vectors", "std::vector is a dynamic array.", "std::vector<int> v;\nv.push_back(1);", 120.0, depends=["gen:pointers"]))]
    artifacts.save({"notes": notes}, folder, "notes")
    return folder


def test_digest_and_notes_files(spark, tmp_path):
    folder = job_folder(tmp_path)
    jobs.run_stage(spark, "render", str(folder), config.Config(cache_dir=str(tmp_path / "memory")), GENERIC)
    assert (folder / "digest.md").read_text() == DIGEST
    assert len((folder / "notes.jsonl").read_text().splitlines()) == 2
    with_lines = artifacts.read_notes(spark, [str(folder)]).orderBy("note_ord").collect()
    (folder / "notes.jsonl").unlink()
    assert [tuple(r) for r in with_lines] == [tuple(r) for r in artifacts.read_notes(spark, [str(folder)]).orderBy("note_ord").collect()]
    assert artifacts.read_notes(spark, [str(tmp_path / "none")]).count() == 0


def test_digest_without_notes(spark):
    empty = spark.createDataFrame([], schemas.table("notes"))
    text = render.digests(empty, spark.createDataFrame([("j", "https://x.org/a/", 60.0)], "job_id string, source_path string, duration_s double")).first().digest
    assert "_No notes._" in text and "Source: a · 0 note(s)" in text and "Compression: 0.0x" in text


def test_missing_documents_name_their_stage(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="align"):
        artifacts.load(spark, [str(tmp_path)], "timeline")
    assert artifacts.try_load(spark, [str(tmp_path)], "timeline").count() == 0
    with pytest.raises(StageUnavailable):
        jobs.run_stage(spark, "dance", str(tmp_path), config.Config(cache_dir=str(tmp_path / "memory")), GENERIC)


def test_probe(spark):
    found = {"format": {"duration": "0"}, "streams": [{"codec_type": "audio"}, {"codec_type": "video", "width": 640, "height": 360, "r_frame_rate": "25/1", "duration": "12.5"}]}
    rows = artifacts.probe(spark.createDataFrame([("j", json.dumps(found)), ("k", '{"streams": []}')], "job_id string, json string")).collect()
    assert [tuple(r) for r in rows] == [("j", 12.5, 640, 360, 25.0)]


def test_tables_of_a_job_from_speech_to_report(spark, tmp_path):
    folder = tmp_path / "job1"
    artifacts.save({"source_path": "/v/lecture.mp4", "duration_s": 100.0}, folder, "video")
    artifacts.save({"language": "english", "model_size": "small", "segments": [{"start": 1.0, "end": 4.0, "text": "pointers hold addresses", "words": []}, {"start": 21.0, "end": 25.0, "text": "vectors grow", "words": []}]}, folder, "transcript")
    artifacts.save({"extracts": [{"timestamp": 0.0, "kind": "slide", "text": "pointers", "description": "", "diagram": ""}, {"timestamp": 20.0, "kind": "code", "text": "int x;", "code_language": "c", "description": "", "diagram": ""}]}, folder, "visuals")
    for stage in ("align", "distill", "render"):
        jobs.run_stage(spark, stage, str(folder), config.Config(cache_dir=str(tmp_path / "memory")), GENERIC, provider=Offline())
    report = json.loads((folder / "alignment_report.json").read_text())
    assert report == {"chunk_count": 2, "segment_count": 2, "lookahead_moves": 0, "scroll_merges": 0, "orphans": 0}
    notes = json.loads((folder / "notes.json").read_text())["notes"]
    assert [n["source_timestamp"] for n in notes] == [0.0, 20.0] and notes[1]["code_snippet"] == "int x;"
    assert json.loads((folder / "concepts.json").read_text())["concepts"]["vectors grow"] == "gen:vectors-grow"
    text = jobs.evaluate_job(spark, str(folder), config.Config(cache_dir=str(tmp_path / "memory")), GENERIC, provider=Offline())
    assert "Fully-supported notes: 2/2 (100%)" in text and (folder / "eval_report.md").read_text() == text
    assert "_No vocabulary for this profile._" in text and "not recorded" in text
    missing = jobs.evaluate_job(spark, str(tmp_path / "job1"), config.Config(cache_dir=str(tmp_path / "memory")), GENERIC.model_copy(update={"vocabulary": ["vectors", "mutex"]}))
    assert "Terms found in transcript: 1/2 (50%)" in missing and "- Missing: mutex" in missing and "_Skipped: no model provider is set._" in missing

    kept = store.build("parquet", spark, str(tmp_path / "kb"))
    assert jobs.ingest_jobs(spark, [str(folder)], "c", kept, Offline(), "m") == 2
    assert jobs.ingest_jobs(spark, [str(folder)], "c", kept, Offline(), "m") == 2  # the same again
    assert kept.all_points("c").count() == 2 and "vector" not in kept.all_points("c").columns
    best = jobs.search_collection(spark, "vectors grow", kept, "c", Offline(), "m").first()
    assert best.concept == "vectors grow" and best.source_video == "lecture.mp4"
    assert kept.all_points("other").count() == 0 and kept.vector_search("other", [1.0], 3).count() == 0
    with pytest.raises(ChalklineError, match="components"):
        kept.ensure_collection("c", 3)
    with pytest.raises(ChalklineError, match="parquet"):
        store.build("nowhere", spark, "x")

    query = ingest.upsert_stream(ingest.note_stream(spark, str(tmp_path)), "s", kept, Offline(), "m", str(tmp_path / "ckpt"))
    query.awaitTermination(60)
    assert kept.all_points("s").count() == 2


def test_report_sections():
    numbers = {"compression_ratio": None, "video_minutes": None, "reading_minutes": 0.25, "est_cost_usd": 0.031, "est_cost_per_video_hour": None}
    text = render.report("p", command="cc {file}", verification=None, vocabulary={"total": 12, "found": 0, "missing": [f"t{i}" for i in range(12)]}, grounding=None, grounding_skipped=None, statistics=numbers, stage_seconds={"align": 1.25}, total_seconds=1.25)
    assert "Tool `cc` not found" in text and "(+2 more)" in text and "_No notes to check._" in text and "Reading time: 0.2 min (video length unknown)" in text and "align 1.2s (total 1.2s)" in text
    assert render.percent(1, 3) == "33%" and render.percent(0, 0) == "n/a"
    full = render.report("p", command="cc", verification={"total": 2, "passed": 1, "failures": [{"source_timestamp": 10.0, "reason": "r"}]}, vocabulary=None, grounding={"sampled": 2, "supported": 1, "unsupported": [{"source_timestamp": 3.0, "concept": "B"}]}, grounding_skipped=None, statistics=numbers)
    assert "compiles: 1/2 (50%)" in full and "failed @ 10s: r" in full and "unsupported @ 3s: B" in full


def test_profiles(tmp_path):
    assert GENERIC.concept_id_prefix == "gen" and GENERIC.recogniser_prompt() is None and "generic" in profile.available()
    for name, text in (("bad", "a: ["), ("list", "- x"), ("extra", "name: x\nnope: 1")):
        (tmp_path / f"{name}.yaml").write_text(text)
        with pytest.raises(ProfileError):
            profile.load(name, tmp_path)
    with pytest.raises(ProfileError, match="bad, extra, list"):
        profile.load("none", tmp_path)
    (tmp_path / "ok.yaml").write_text("name: cpp\nvocabulary: [vector, mutex]")
    assert profile.load("ok", tmp_path).recogniser_prompt() == "The following is a transcript about cpp. Expect terminology such as: vector, mutex."


def test_settings():
    assert config.load({}).vision_max_width == 1024 and config.load({"CHALKLINE_VISION_MAX_WIDTH": "off"}).vision_max_width is None
    assert config.load({"CHALKLINE_VISION_PROVIDER": "Gemini"}).vision_model.startswith("gemini")


def test_providers():
    with pytest.raises(ProviderError):
        OpenAI(None)

    class Eye(Offline):
        def vision(self, prompt, image, mime, *, model, temperature=0.2):
            return "seen"

    routed = Routed(Offline(), Eye())
    assert routed.vision("p", b"", "image/png", model="m") == "seen" and routed.embed(["a"], model="m") and Routed(Offline()).vision("p", b"", "x", model="m") != "seen"
    with pytest.raises(DependencyMissing):
        media.require_programs("no-such-program")


def test_command_line(spark, tmp_path, capsys):
    from chalkline import cli

    folder = job_folder(tmp_path)
    args = cli.parser().parse_args(["run-stage", "render", "--job", str(folder)])
    assert cli.run(args, spark) == 0 and "render: done" in capsys.readouterr().out
    (tmp_path / ".env").write_text("CHALKLINE_TEST_ONLY='x'\n# c\n")
    cli.dotenv(str(tmp_path / ".env"))
    import os

    assert os.environ.pop("CHALKLINE_TEST_ONLY") == "x"


def test_many_jobs_send_no_document_to_the_driver(spark, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    folders = [str(tmp_path / f"job{n:04d}") for n in range(300)]
    said = "word " * 60
    for n, folder in enumerate(folders):
        artifacts.save({"source_path": f"/v/{n}.mp4", "audio_path": "a.wav", "duration_s": 60.0, "width": 1, "height": 1, "fps": 1.0, "audio_sample_rate": 1, "audio_channels": 1}, folder, "video")
        artifacts.save({"language": "en", "model_size": "m", "segments": [{"start": 0.0, "end": 5.0, "text": said, "words": []}]}, folder, "transcript")
        artifacts.save({"extracts": [{"timestamp": 0.0, "kind": "slide", "text": f"slide {n}", "code_language": None, "description": "", "diagram": ""}]}, folder, "visuals")
        note = {"concept": f"c{n}", "canonical_concept_id": f"gen:c{n}", "summary": said, "code_snippet": None, "code_language": None, "diagram": None, "pitfalls": [], "depends_on": [], "source_timestamp": 0.0, "partial": False}
        artifacts.save({"notes": [note] * (n % 3)}, folder, "notes")
    seen, collect, iterate = [], Classic.collect, Classic.toLocalIterator
    monkeypatch.setattr(Classic, "collect", lambda self: (rows := collect(self), seen.extend(map(str, rows)))[0])
    monkeypatch.setattr(Classic, "toLocalIterator", lambda self, *a: (rows := list(iterate(self, *a)), seen.extend(map(str, rows)), iter(rows))[2])
    jobs.align_jobs(spark, folders)
    jobs.render_jobs(spark, folders)
    monkeypatch.undo()
    assert not any("word word" in row or "slide" in row for row in seen)
    for n in (0, 1, 2, 299):
        folder = tmp_path / f"job{n:04d}"
        timeline = json.loads((folder / "aligned.json").read_text())
        assert timeline["chunks"][0]["segments"][0]["text"] == said and timeline["chunks"][0]["visuals"][0]["text"] == f"slide {n}"
        lines = (folder / "notes.jsonl").read_text().splitlines()
        assert len(lines) == n % 3 and all(json.loads(x)["concept"] == f"c{n}" for x in lines) and (folder / "digest.md").read_text().count(f"## c{n}") == n % 3
        assert not [f for f in folder.iterdir() if f.name.startswith(".") and not f.name.endswith(".crc")]


def test_a_failed_write_leaves_folders_as_they_were(spark, tmp_path):
    rows = spark.createDataFrame([("a", "{}"), ("b", "not json")], "job_id string, text string").repartition(2)
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.json").write_text("old")
    with pytest.raises(Exception):
        jobfiles.write(rows, "x.json", {j: str(tmp_path / j) for j in "ab"})
    assert (tmp_path / "a" / "x.json").read_text() == "old" and not (tmp_path / "b" / "x.json").exists()

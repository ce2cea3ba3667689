"""Jobs from video to digest: stages in order, each from artifacts to artifacts of a folder.

Stages on tables (align, distill, render) take any number of job folders in one plan; media stages
run one job's programs on the driver.
"""

from __future__ import annotations

import logging
import shutil
import time
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chalkline import schemas
from chalkline.config import Config
from chalkline.errors import ChalklineError, StageUnavailable
from chalkline.memory import remembering
from chalkline.operators import align, distill, evaluate, frames, knowledge, render, scenes, search
from chalkline.profile import Profile
from chalkline.providers import Gemini, OpenAI, Provider, Routed, mime_type
from chalkline.scratch import seen_by_all
from chalkline.shipping import ship
from chalkline.sources import artifacts, jobfiles, media
from chalkline.sources.store import Store

log = logging.getLogger(__name__)

STAGES = ("ingest", "transcribe", "detect_scenes", "extract_visuals", "align", "distill", "render")


@dataclass(frozen=True)
class StageResult:
    name: str
    status: str
    detail: str = ""


def provider_of(config: Config) -> Provider:
    """The hosted providers that the settings name, behind the memory of replies."""
    default = OpenAI(config.openai_api_key)
    return remembering(Routed(default, Gemini(config.gemini_api_key)) if config.vision_provider == "gemini" else default, config.cache_dir)


def _documents(table: DataFrame, kind: str, jobs: dict[str, str]) -> None:
    """Write each job's document of one kind into its folder, where it is made."""
    jobfiles.write(artifacts.documents(table, kind).withColumnRenamed("json", "text"), schemas.ARTIFACTS[kind][0], jobs)


def _named(job_dirs: list[str]) -> dict[str, str]:
    return {d.rstrip("/").rsplit("/", 1)[-1]: d for d in job_dirs}


def ingest(spark: SparkSession, video: str, job_dir: str) -> None:
    media.require_programs()
    job = job_dir.rstrip("/").rsplit("/", 1)[-1]
    Path(job_dir).mkdir(parents=True, exist_ok=True)
    audio = f"{job_dir}/audio.wav"
    found = artifacts.probe(spark.createDataFrame([(job, media.probe_json(video))], "job_id string, json string")).first()
    if found is None:
        raise ChalklineError(f"{video} has no video stream")
    media.extract_audio(video, audio)
    row = found.asDict() | {"source_path": video, "audio_path": audio, "audio_sample_rate": media.SAMPLE_RATE, "audio_channels": media.CHANNELS}
    row.pop("job_id")
    artifacts.save(row, job_dir, "video")


def transcribe(spark: SparkSession, job_dir: str, config: Config, profile: Profile, provider: Provider | None = None) -> None:
    from chalkline.operators import transcripts

    video = artifacts.load(spark, [job_dir], "video").first()
    prompt, language = profile.recogniser_prompt(), profile.asr_language
    parts: list[tuple[float, object]] = []
    if config.asr_model.startswith(("whisper-1", "gpt-")):
        provider = provider or provider_of(config)
        ask = lambda path: provider.transcribe(Path(path).read_bytes(), Path(path).name, model=config.asr_model, prompt=prompt, language=language)
        whole = Path(video.audio_path).stat().st_size <= transcripts.LARGEST_UPLOAD
        parts = [(0.0, ask(video.audio_path))] if whole else [(offset, ask(path)) for offset, path in media.split_audio(video.audio_path, video.duration_s)]
    else:
        parts = [(0.0, media.local_speech(video.audio_path, config.asr_model, prompt, language))]
    word = "array<struct<start:double,end:double,text:string,probability:double>>"
    rows = [(video.job_id, p, i, offset, s.start, s.end, s.text, [(w.start, w.end, w.text, w.probability) for w in s.words]) for p, (offset, speech) in enumerate(parts) for i, s in enumerate(speech.segments)]
    table = spark.createDataFrame(rows, f"job_id string, part_ord int, seg_ord int, offset double, start double, end double, text string, words {word}")
    joined = transcripts.joined_segments(table).orderBy("part_ord", "seg_ord").drop("job_id", "part_ord", "seg_ord")
    spoken = spark.createDataFrame([(video.job_id, p, s.language) for p, (_, s) in enumerate(parts)], "job_id string, part_ord int, language string")
    found = transcripts.job_languages(spoken, language).first()
    artifacts.save({"language": found.language if found else "unknown", "model_size": config.asr_model, "segments": [r.asDict(True) for r in joined.toLocalIterator()]}, job_dir, "transcript")


def detect_scenes(spark: SparkSession, job_dir: str, profile: Profile) -> None:
    video = artifacts.load(spark, [job_dir], "video").first()
    listed = media.detect_scenes(video.source_path) or [(0.0, video.duration_s)]
    times = scenes.candidate_times(spark.createDataFrame([(video.job_id, a, b) for a, b in listed], schemas.table("scenes"))).orderBy("timestamp")
    folder = Path(job_dir) / "frames"
    folder.mkdir(parents=True, exist_ok=True)
    rows = []
    for n, row in enumerate(times.toLocalIterator()):
        image = str(folder / f"frame-{n:05d}.jpg")
        media.extract_frame(video.source_path, row.timestamp, image)
        rows.append((video.job_id, n, row.timestamp, image, media.image_hash(image, profile.keyframe_mask_regions)))
    kept = scenes.dedup_frames(spark.createDataFrame(rows, schemas.table("keyframes")))
    _documents(artifacts.nested(kept, "kf_ord", "keyframes"), "keyframes", _named([job_dir]))


def extract_visuals(spark: SparkSession, job_dirs: list[str], config: Config, profile: Profile, provider: Provider | None, limit: float = frames.DEFAULT_LIMIT) -> None:
    kept = artifacts.exploded(artifacts.load(spark, job_dirs, "keyframes"), "keyframes", "kf_ord")
    frames.check_cost(kept.count(), limit)  # before a provider is made
    width = config.vision_max_width

    def pictures(tables):  # read where they are asked about: the driver holds paths alone
        for table in tables:
            paths = table["image_path"]
            yield table[["job_id", "timestamp"]].assign(image=[media.scaled_image(p, width) for p in paths], mime=[mime_type(p) for p in paths])

    ship(spark)
    table = kept.select("job_id", "timestamp", "image_path").mapInPandas(pictures, "job_id string, timestamp double, image binary, mime string")
    found = frames.visuals(table, profile, provider or provider_of(config), config.vision_model, limit=limit)
    whole = artifacts.load(spark, job_dirs, "keyframes").select("job_id").join(artifacts.nested(found, "vis_ord", "extracts"), "job_id", "left")
    _documents(_filled(whole, "extracts"), "visuals", _named(job_dirs))


def _filled(table: DataFrame, column: str) -> DataFrame:
    return table.withColumn(column, F.coalesce(column, F.array().cast(table.schema[column].dataType)))


def align_jobs(spark: SparkSession, job_dirs: list[str]) -> None:
    said = artifacts.load(spark, job_dirs, "transcript")
    shown = artifacts.exploded(artifacts.load(spark, job_dirs, "visuals"), "extracts", "vis_ord")
    timeline, report = align.align(artifacts.exploded(said, "segments", "seg_ord"), shown, said.select("job_id", "language"))
    whole = said.select("job_id").join(artifacts.nested(timeline, "chunk_ord", "chunks"), "job_id", "left")
    _documents(_filled(whole, "chunks"), "timeline", _named(job_dirs))
    _documents(said.select("job_id").join(report, "job_id", "left").na.fill(0), "alignment_report", _named(job_dirs))


def timeline_of(spark: SparkSession, job_dirs: list[str]) -> DataFrame:
    return artifacts.exploded(artifacts.load(spark, job_dirs, "timeline"), "chunks", "chunk_ord")


def distill_jobs(spark: SparkSession, job_dirs: list[str], config: Config, profile: Profile, provider: Provider) -> None:
    jobs = artifacts.load(spark, job_dirs, "timeline").select("job_id")
    # replies are kept before they are read twice, so that no request is made twice
    made = distill.notes(timeline_of(spark, job_dirs), profile, provider, config.distill_model).persist()
    _documents(_filled(jobs.join(artifacts.nested(made, "note_ord", "notes"), "job_id", "left"), "notes"), "notes", _named(job_dirs))
    listed = distill.registry(made).groupBy("job_id").agg(F.map_from_entries(F.collect_list(F.struct("concept_key", "canonical_concept_id"))).alias("concepts"))
    whole = jobs.join(listed, "job_id", "left").withColumn("concepts", F.coalesce("concepts", F.create_map().cast("map<string,string>")))
    _documents(whole, "concepts", _named(job_dirs))
    made.unpersist()


def render_jobs(spark: SparkSession, job_dirs: list[str]) -> None:
    jobs = _named(job_dirs)
    notes = artifacts.exploded(artifacts.load(spark, job_dirs, "notes"), "notes", "note_ord")
    jobfiles.write(render.digests(notes, artifacts.load(spark, job_dirs, "video")).select("job_id", F.col("digest").alias("text")), "digest.md", jobs)
    fields = [f for f in notes.columns if f not in ("job_id", "note_ord")]
    line = F.concat(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), F.lit("\n"))
    lined = notes.groupBy("job_id").agg(F.array_sort(F.collect_list(F.struct("note_ord", line.alias("line")))).alias("lines"))
    every = spark.createDataFrame([(job,) for job in jobs], "job_id string").join(lined, "job_id", "left")  # a job without notes gets an empty file
    jobfiles.write(every.select("job_id", F.coalesce(F.array_join(F.transform("lines", lambda x: x["line"]), ""), F.lit("")).alias("text")), "notes.jsonl", jobs)


def run_stage(spark: SparkSession, name: str, job_dir: str, config: Config, profile: Profile, *, provider: Provider | None = None, max_cost: float = frames.DEFAULT_LIMIT, video: str | None = None) -> None:
    """One stage of one job, from what its folder holds; replies of models are remembered in ``config.cache_dir``."""
    provider = remembering(provider, seen_by_all(spark, config.cache_dir)) if provider is not None else None
    log.info("%s: stage %s", job_dir, name)
    stages: dict[str, Callable[[], None]] = {
        "ingest": lambda: ingest(spark, video or artifacts.load(spark, [job_dir], "video").first().source_path, job_dir),
        "transcribe": lambda: transcribe(spark, job_dir, config, profile, provider),
        "detect_scenes": lambda: detect_scenes(spark, job_dir, profile),
        "extract_visuals": lambda: extract_visuals(spark, [job_dir], config, profile, provider, max_cost),
        "align": lambda: align_jobs(spark, [job_dir]),
        "distill": lambda: distill_jobs(spark, [job_dir], config, profile, provider or provider_of(config)),
        "render": lambda: render_jobs(spark, [job_dir]),
    }
    if name not in stages:
        raise StageUnavailable(f"unknown stage {name!r}; there are: {', '.join(STAGES)}")
    stages[name]()


def process(spark: SparkSession, video: str, job_dir: str, config: Config, profile: Profile, *, provider: Provider | None = None, max_cost: float = frames.DEFAULT_LIMIT) -> list[StageResult]:
    """All stages of one job; their times are written beside the artifacts."""
    results, seconds = [], {}
    for name in STAGES:
        began = time.perf_counter()
        run_stage(spark, name, job_dir, config, profile, provider=provider, max_cost=max_cost, video=video)
        seconds[name] = time.perf_counter() - began
        results.append(StageResult(name, "done", f"{seconds[name]:.1f} s"))
    artifacts.save({"stage_seconds": seconds, "total_seconds": sum(seconds.values())}, job_dir, "run_stats")
    return results


def evaluate_job(spark: SparkSession, job_dir: str, config: Config, profile: Profile, *, provider: Provider | None = None, grounding_n: int = 5, run_commands: bool = False) -> str:
    """The report of one job's checks, also written as eval_report.md; what a job lacks is left out or said to be missing."""
    provider = remembering(provider, seen_by_all(spark, config.cache_dir)) if provider is not None else None
    job = job_dir.rstrip("/").rsplit("/", 1)[-1]
    one = lambda df: (lambda r: r.asDict(True) if r else None)(df.first())
    has = lambda kind: artifacts.try_load(spark, [job_dir], kind)
    notes_doc, transcript, timeline = has("notes"), has("transcript"), has("timeline")
    notes = artifacts.exploded(notes_doc, "notes", "note_ord").persist()
    has_notes = not notes.isEmpty()
    command = profile.verification.command if profile.verification else None
    verified = evaluate.verification(notes, profile, run_commands=True) if command and run_commands else None
    tool_there = bool(command) and run_commands and shutil.which((command.split() or [""])[0]) is not None
    checked = (one(verified) or {"total": 0, "passed": 0, "failures": []}) if tool_there else None
    said = artifacts.exploded(transcript, "segments", "seg_ord")
    words = evaluate.vocabulary(said, profile.vocabulary)
    found_words = None
    if words is not None and not transcript.isEmpty():
        found_words = one(words) or {"total": len(profile.vocabulary), "found": 0, "missing": profile.vocabulary}
    skipped = grounded = None
    if has_notes and not timeline.isEmpty():
        if provider is None:
            skipped = "no model provider is set"
        elif grounding_n <= 0:
            skipped = "grounding-n is 0"
        else:
            pairs = evaluate.grounding_pairs(notes, artifacts.exploded(timeline, "chunks", "chunk_ord"), grounding_n)
            grounded = one(evaluate.grounding(evaluate.judged(pairs, provider, config.distill_model)))
    numbers = one(evaluate.statistics(notes, has("video"), artifacts.exploded(has("keyframes"), "keyframes", "kf_ord"), spark.createDataFrame([(job,)], "job_id string")))
    times = one(has("run_stats")) or {}
    text = render.report(profile.name, command=command, verification=checked, vocabulary=found_words, grounding=grounded, grounding_skipped=skipped, statistics=numbers,
                         stage_seconds=times.get("stage_seconds"), total_seconds=times.get("total_seconds"))
    (Path(job_dir) / "eval_report.md").write_text(text, encoding="utf-8")
    notes.unpersist()
    return text


def ingest_jobs(spark: SparkSession, job_dirs: list[str], collection: str, store: Store, embedder: Provider, model: str) -> int:
    """Notes of all jobs as points of a collection; returns how many notes there were, before equal ids are made one."""
    notes = artifacts.read_notes(spark, job_dirs)
    n = notes.count()
    if not n:
        return 0
    texts = knowledge.embed_text(notes)
    vectors = knowledge.embedded(texts, lambda listed: embedder.embed(listed, model=model)).persist()
    made = knowledge.points(notes, artifacts.source_videos(spark, job_dirs), collection, vectors)
    store.ensure_collection(collection, vectors.select(F.size("vector").alias("d")).first().d)
    store.upsert(collection, made)
    vectors.unpersist()
    return n


def search_collection(spark: SparkSession, query: str, store: Store, collection: str, embedder: Provider | None, model: str, k: int = 8) -> DataFrame:
    """The best ``k`` notes of a collection; words alone without an embedder."""
    points = store.with_vectors(collection)
    vector = embedder.embed([query], model=model)[0] if embedder is not None else None
    near = None if vector is None else lambda d: store.vector_search(collection, vector, d)
    return search.results(search.hybrid(store.index(collection), points, query, vector, k=k, nearest_of=near))

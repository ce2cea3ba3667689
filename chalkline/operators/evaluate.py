"""Checks of finished jobs: code, vocabulary, grounding and statistics, for many jobs at once."""

from __future__ import annotations

import shlex
import shutil
import subprocess
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chalkline.functions import text as T
from chalkline.functions.parsing import parse_verdict
from chalkline.operators.frames import FRAME_COST
from chalkline.profile import Profile
from chalkline.providers import Provider
from chalkline.shipping import ship

# Estimated dollars for a note, and words read in a minute.
NOTE_COST, WORDS_A_MINUTE = 0.001, 200


def reading_words(notes: DataFrame) -> Column:
    """Words of a note that are read: concept, summary and pitfalls."""
    parts = F.concat(F.array(F.coalesce(notes["concept"], F.lit("")), F.coalesce(notes["summary"], F.lit(""))), F.coalesce(notes["pitfalls"], F.array().cast("array<string>")))
    return T.word_count(F.array_join(parts, " "))


def statistics(notes: DataFrame, videos: DataFrame, keyframes: DataFrame, jobs: DataFrame) -> DataFrame:
    """A row for each of ``jobs`` (job_id): video and reading minutes, compression, estimated cost and cost an hour.

    Compression is null without a video or without words, and 0 for a video of no length; the cost an
    hour is null without a length.
    """
    read = notes.groupBy("job_id").agg(F.sum(reading_words(notes)).alias("words"), F.count(F.lit(1)).alias("n_notes"))
    shown = keyframes.groupBy("job_id").agg(F.count(F.lit(1)).alias("n_frames"))
    rows = jobs.select("job_id").distinct().join(read, "job_id", "left").join(shown, "job_id", "left").join(videos.select("job_id", "duration_s"), "job_id", "left")
    rows = rows.na.fill(0, ["words", "n_notes", "n_frames"])
    minutes, reading = F.col("duration_s") / 60, F.col("words") / F.lit(float(WORDS_A_MINUTE))
    cost = F.col("n_frames") * F.lit(FRAME_COST) + F.col("n_notes") * F.lit(NOTE_COST)
    return rows.select("job_id", "n_notes", "n_frames", minutes.alias("video_minutes"), reading.alias("reading_minutes"), F.try_divide(minutes, reading).alias("compression_ratio"),
                       cost.alias("est_cost_usd"), F.when(F.col("duration_s") > 0, cost / (F.col("duration_s") / 3600)).alias("est_cost_per_video_hour"))


def _searched(segments: DataFrame, longest: int) -> DataFrame:
    """(job_id, text): pieces of a job's speech in which every term of at most ``longest`` characters lies whole.

    The segments' texts, one space apart, are one text. Those that begin within the same ``longest`` characters are one piece, which also takes
    the beginnings of the two after it: these hold the ``longest`` characters behind it, however short the segments are.
    """
    order = Window.partitionBy("job_id").orderBy("start", "seg_ord")
    text = F.coalesce(F.col("text"), F.lit(""))
    placed = segments.select("job_id", "start", "seg_ord", text.alias("text"), F.coalesce(F.sum(F.length(text) + 1).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("at"))
    pieces = placed.groupBy("job_id", F.floor(F.col("at") / F.lit(longest)).alias("piece")).agg(F.array_sort(F.collect_list(F.struct("at", "start", "seg_ord", "text"))).alias("said"))
    pieces = pieces.select("job_id", "piece", F.array_join(F.transform("said", lambda s: s["text"]), " ").alias("text"))
    after = Window.partitionBy("job_id").orderBy("piece").rowsBetween(1, 2)
    cut = F.substring(F.array_join(F.collect_list(F.substring("text", 1, longest)).over(after), " "), 1, longest)
    # what is cut off goes on as a word: a term that would end there begins in a later piece and is found from it
    return pieces.select("job_id", F.concat("text", F.lit(" "), cut, F.when(F.length(cut) >= longest, "_").otherwise("")).alias("text"))


def vocabulary(segments: DataFrame, terms: list[str]) -> DataFrame | None:
    """(job_id, total, found, missing): terms said as whole words in a job, the missing ones in their order; None without terms.

    Terms are looked for in the text of all segments, one space apart, so a term may go over their ends. A term's words are whole words of a
    text that holds it, so all terms are one dictionary by their longest word: a piece of speech meets the terms whose word it says, and only
    these are searched for. Terms without a word are searched for everywhere.
    """
    if not terms:
        return None
    spark = segments.sparkSession
    words_of = lambda c: F.regexp_extract_all(F.lower(c), F.lit(T.WORD), F.lit(0))
    listed = spark.createDataFrame(list(enumerate(terms)), "n int, term string")  # as many rows as there are terms
    listed = listed.withColumn("word", F.coalesce(F.array_max(F.transform(words_of("term"), lambda w: F.struct(F.length(w), w.alias("w"))))["w"], F.lit("")))
    said = _searched(segments, max(map(len, terms)))
    spoken = said.select("job_id", "text", F.explode(F.array_append(F.array_distinct(words_of("text")), F.lit(""))).alias("word"))
    met = spoken.join(F.broadcast(listed), "word").where(T.has_term(F.col("text"), F.col("term"))).select("job_id", "n").distinct()
    found = segments.select("job_id").distinct().join(met.groupBy("job_id").agg(F.collect_set("n").alias("ns")), "job_id", "left")
    every = spark.createDataFrame([(terms,)], "terms array<string>")
    rows = found.crossJoin(F.broadcast(every)).withColumn("ns", F.coalesce("ns", F.array().cast("array<int>")))  # one row
    missing = F.transform(F.array_except(F.sequence(F.lit(0), F.lit(len(terms) - 1)), F.col("ns")), lambda n: F.get(F.col("terms"), n))
    return rows.select("job_id", F.lit(len(terms)).alias("total"), F.size("ns").alias("found"), missing.alias("missing"))


def source_text(segments: Column, visuals: Column) -> Column:
    """What a chunk said and showed, for a judge."""
    said = F.array_join(F.transform(segments, lambda s: F.coalesce(s["text"], F.lit(""))), " ")
    shown = F.array_join(F.transform(F.filter(visuals, lambda v: ~T.is_blank(v["text"])), lambda v: v["text"]), "\n")
    return T.strip(F.concat(F.lit("Said: "), said, F.lit("\nShown:\n"), shown))


def grounding_pairs(notes: DataFrame, timeline: DataFrame, n: int) -> DataFrame:
    """The first ``n`` notes of each job with their chunk's text: the chunk that starts at the note's time, the last of several."""
    order = Window.partitionBy("job_id").orderBy("note_ord")
    first = notes.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= n)
    starts = timeline.groupBy("job_id", F.col("start").alias("source_timestamp")).agg(F.max_by(F.struct("segments", "visuals"), "chunk_ord").alias("chunk"))
    found = first.join(starts, ["job_id", "source_timestamp"], "left")
    text = F.when(F.col("chunk").isNull(), F.lit("(source chunk not found)")).otherwise(source_text(F.col("chunk.segments"), F.col("chunk.visuals")))
    return found.select("job_id", "note_ord", "source_timestamp", "concept", "summary", text.alias("source"))


def judged(pairs: DataFrame, provider: Provider, model: str) -> DataFrame:
    """``pairs`` with ``supported``: a model's verdict; one that cannot be read is no."""
    ask = "Is every claim of the SUMMARY supported by the SOURCE? Answer with JSON alone: {\"supported\": true} or {\"supported\": false}."
    prompt = F.concat(F.lit(ask), F.lit("\n\nSOURCE:\n"), F.col("source"), F.lit("\n\nSUMMARY:\n"), F.col("summary"))

    def work(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for table in tables:
            yield table[["job_id", "note_ord"]].assign(supported=[parse_verdict(provider.complete(p, model=model)) for p in table["prompt"]])

    ship(pairs.sparkSession)
    asked = pairs.select("job_id", "note_ord", prompt.alias("prompt")).mapInPandas(work, "job_id string, note_ord int, supported boolean")
    return pairs.join(asked, ["job_id", "note_ord"])


def grounding(pairs: DataFrame) -> DataFrame:
    """(job_id, sampled, supported, unsupported) of judged pairs; the unsupported notes' times and concepts in their order."""
    bad = F.array_sort(F.collect_list(F.when(~F.col("supported"), F.struct("note_ord", "source_timestamp", "concept"))))
    return pairs.groupBy("job_id").agg(F.count(F.lit(1)).alias("sampled"), F.count_if("supported").alias("supported"),
                                       F.transform(bad, lambda x: F.struct(x["source_timestamp"].alias("source_timestamp"), x["concept"].alias("concept"))).alias("unsupported"))


def check_snippet(code: str, command: str) -> str | None:
    """None if the command accepts the code, else the first line of its complaint."""
    with tempfile.TemporaryDirectory() as folder:
        path = Path(folder) / "snippet"
        path.write_text(code, encoding="utf-8")
        run = subprocess.run([arg.replace("{file}", str(path)) for arg in shlex.split(command)], capture_output=True, text=True)
    return None if run.returncode == 0 else (run.stderr.strip().splitlines() or ["non-zero exit"])[0]


def verification(notes: DataFrame, profile: Profile, *, run_commands: bool = False) -> DataFrame | None:
    """(job_id, total, passed, failures) of the profile's command over whole snippets; None without a command.

    It runs extracted code through a program on executors, so it must be asked for by ``run_commands``.
    A program that is not there gives no rows.
    """
    if profile.verification is None:
        return None
    command = profile.verification.command
    whole = notes.where((F.coalesce("code_snippet", F.lit("")) != "") & ~F.coalesce("partial", F.lit(False)))
    if not run_commands:
        raise PermissionError("verification runs the profile's command on executors; pass run_commands=True")
    tool = (shlex.split(command) or [""])[0]

    def work(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        there = bool(tool) and shutil.which(tool) is not None
        for table in tables:
            if there:
                yield table[["job_id", "note_ord", "source_timestamp"]].assign(reason=[check_snippet(c, command) for c in table["code_snippet"]])

    ship(notes.sparkSession)
    ran = whole.select("job_id", "note_ord", "source_timestamp", "code_snippet").mapInPandas(work, "job_id string, note_ord int, source_timestamp double, reason string")
    bad = F.array_sort(F.collect_list(F.when(F.col("reason").isNotNull(), F.struct("note_ord", "source_timestamp", "reason"))))
    return ran.groupBy("job_id").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("reason").isNull()).alias("passed"),
                                     F.transform(bad, lambda x: F.struct(x["source_timestamp"].alias("source_timestamp"), x["reason"].alias("reason"))).alias("failures"))

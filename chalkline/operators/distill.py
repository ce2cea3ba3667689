"""From aligned chunks to notes: what the model is asked, what is copied verbatim, and what makes a note."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chalkline.functions import text as T
from chalkline.functions.parsing import NOTE_REPLY, parse_note
from chalkline.operators.models import complete_table
from chalkline.profile import Profile
from chalkline.providers import Provider


def code_from_visuals(visuals: Column) -> Column:
    """Code shown in the editor, else what looks like code on a whiteboard or slide; blocks apart by a blank line; null without any."""
    shown = F.filter(visuals, lambda v: (v["kind"] == "code") & ~T.is_blank(v["text"]))
    drawn = F.filter(visuals, lambda v: v["kind"].isin("whiteboard", "slide") & T.looks_like_code(F.coalesce(v["text"], F.lit(""))))
    joined = lambda vs: F.when(F.size(vs) > 0, F.array_join(F.transform(vs, lambda v: v["text"]), "\n\n"))
    return F.coalesce(joined(shown), joined(drawn))


def code_language(visuals: Column) -> Column:
    """Language of the first code visual that names one."""
    tagged = F.filter(visuals, lambda v: (v["kind"] == "code") & ~T.is_blank(v["text"]) & (F.coalesce(v["code_language"], F.lit("")) != ""))
    return F.get(tagged, F.lit(0))["code_language"]


def diagram(visuals: Column) -> Column:
    drawn = F.filter(visuals, lambda v: ~T.is_blank(v["diagram"]))
    return F.when(F.size(drawn) > 0, F.array_join(F.transform(drawn, lambda v: v["diagram"]), "\n\n"))


def spoken(segments: Column) -> Column:
    return T.strip(F.array_join(F.transform(segments, lambda s: F.coalesce(s["text"], F.lit(""))), " "))


_ASK = (
    "Write a study note, in English, about one part of a video. Its only sources are the words that were spoken and the text that was on screen, both given "
    "below; leave out whatever they do not say."
)
_KEYS = (
    "Answer with one JSON object and nothing else. Its keys: skip (true for greetings, breaks and other parts that teach nothing), concept (its name, a few words), "
    "summary (no more than 120 words; every point made, no filler, no code), pitfalls (list of those that the speaker names), "
    "depends_on (list of concepts that it builds on), partial (true if the code on screen is a fragment)."
)


def prompt(segments: Column, visuals: Column, profile: Profile) -> Column:
    """The request for one chunk's note."""
    readable = F.filter(visuals, lambda v: ~T.is_blank(v["text"]))
    screen = F.array_join(F.transform(readable, lambda v: T.strip(F.concat(F.lit("["), v["kind"], F.lit("] "), v["text"]))), "\n\n")
    or_none = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("(none)"))
    parts = [F.lit(_ASK), F.concat(F.lit("TRANSCRIPT:\n"), or_none(spoken(segments))), F.concat(F.lit("ON SCREEN:\n"), or_none(screen)), F.lit(_KEYS)]
    if profile.distill_hints.strip():
        parts.append(F.lit(f"Additional guidance: {profile.distill_hints.strip()}"))
    return F.concat_ws("\n\n", *parts)


def notes(timeline: DataFrame, profile: Profile, provider: Provider, model: str) -> DataFrame:
    """The table notes of all jobs' chunks.

    Chunks with neither speech nor readable text are not asked about; an unusable reply is asked for
    again once with its error, and then dropped; so are replies that skip or name no concept. Code,
    its language and diagrams are copied from the visuals, never from the model.
    """
    readable = F.exists("visuals", lambda v: ~T.is_blank(v["text"]))
    asked = timeline.where((spoken(F.col("segments")) != "") | readable).withColumn("prompt", prompt(F.col("segments"), F.col("visuals"), profile))
    replies = complete_table(asked.select("job_id", "chunk_ord", "prompt"), ["job_id", "chunk_ord"], provider, model, parse_note, NOTE_REPLY)
    made = asked.drop("prompt").join(replies, ["job_id", "chunk_ord"])
    concept = T.strip(F.col("reply.concept"))
    made = made.where(F.col("reply").isNotNull() & ~F.col("reply.skip") & (concept != ""))
    code = code_from_visuals(F.col("visuals"))
    fallback = F.lit(profile.code_languages[0]) if profile.code_languages else F.lit(None).cast("string")
    stripped = F.filter(F.transform("reply.pitfalls", T.strip), lambda p: p != "")
    order = Window.partitionBy("job_id").orderBy("chunk_ord")
    return made.select(
        "job_id", (F.row_number().over(order) - 1).alias("note_ord"), concept.alias("concept"), T.canonical_id(concept, profile.concept_id_prefix).alias("canonical_concept_id"),
        T.strip(F.col("reply.summary")).alias("summary"), code.alias("code_snippet"), F.when(code.isNotNull(), F.coalesce(code_language(F.col("visuals")), fallback)).alias("code_language"),
        diagram(F.col("visuals")).alias("diagram"), stripped.alias("pitfalls"), T.dependency_ids(F.col("reply.depends_on"), profile.concept_id_prefix).alias("depends_on"),
        F.col("start").alias("source_timestamp"), (F.col("reply.partial") & code.isNotNull()).alias("partial"))


def registry(made: DataFrame) -> DataFrame:
    """(job_id, concept_key, canonical_concept_id): every concept that notes name, once a job."""
    return made.select("job_id", T.concept_key(F.col("concept")).alias("concept_key"), "canonical_concept_id").distinct()

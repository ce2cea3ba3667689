"""Rows around a speech recogniser: parts of long audio, and segments with their place in the whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.functions import text as T

# Bytes a hosted recogniser takes at once, seconds of a part, and the audio's format.
LARGEST_UPLOAD = 24 * 1024 * 1024
PART_SECONDS = 600
SAMPLE_RATE, CHANNELS = 16_000, 1


def audio_parts(videos: DataFrame, part: int = PART_SECONDS) -> DataFrame:
    """(job_id, part_ord, offset): where each part of a job's audio starts; none for audio without length."""
    n = F.ceil(F.col("duration_s") / F.lit(float(part))).cast("int")
    offsets = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return videos.select("job_id", F.posexplode(offsets).alias("part_ord", "k")).select("job_id", "part_ord", (F.col("k") * F.lit(float(part))).alias("offset"))


def joined_segments(parts: DataFrame) -> DataFrame:
    """Segments of all parts in the time of the whole: ``parts`` has job_id, part_ord, seg_ord, offset, start, end, text and words."""
    words = F.transform("words", lambda w: F.struct((w["start"] + F.col("offset")).alias("start"), (w["end"] + F.col("offset")).alias("end"), w["text"].alias("text"), w["probability"].alias("probability")))
    return parts.select("job_id", "part_ord", "seg_ord", (F.col("start") + F.col("offset")).alias("start"), (F.col("end") + F.col("offset")).alias("end"), T.strip(F.col("text")).alias("text"), words.alias("words"))


def job_languages(parts: DataFrame, forced: str | None = None) -> DataFrame:
    """(job_id, language): the one that is set; else the first part's that is known, as a code."""
    if forced:
        return parts.select("job_id").distinct().withColumn("language", F.lit(forced))
    known = F.when(F.lower("language") != "unknown", F.col("language"))
    found = parts.groupBy("job_id").agg(F.min_by(known, F.when(known.isNotNull(), F.col("part_ord"))).alias("language"))
    return found.select("job_id", F.coalesce(T.language_code(F.col("language")), F.lit("unknown")).alias("language"))

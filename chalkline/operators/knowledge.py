"""Points of the knowledge base: ids, payloads, batches for the embedder, and insert-or-replace."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chalkline.functions import text as T
from chalkline.shipping import ship

# The namespace of URL ids (RFC 9562), and what one embedding request may hold.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"
BATCH_INPUTS, BATCH_TOKENS = 1000, 200_000


def url_uuid(name: Column) -> Column:
    """Version 5 id of a name in the URL namespace."""
    h = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12))


def seconds_text(value: Column) -> Column:
    """A number as Python writes a float, for magnitudes below 1e16 that need no more digits than Spark's shortest form."""
    plain = value.cast("string")
    digits = F.regexp_replace(F.regexp_replace(plain, r"E.*$", ""), r"[-.]", "")
    power = F.regexp_extract(plain, r"E(-?\d+)$", 1).cast("int")
    sign = F.when(plain.startswith("-"), "-").otherwise("")
    whole = F.concat(F.rpad(digits, F.greatest(F.length(digits), power + 1), "0"))
    large = F.concat(F.substring(whole, F.lit(1), power + 1), F.lit("."), F.coalesce(F.nullif(F.regexp_replace(F.substring(whole, power + 2, F.length(whole)), "0+$", ""), F.lit("")), F.lit("0")))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), F.regexp_replace(digits, "0+$", ""))
    tiny = F.concat(F.regexp_replace(F.regexp_extract(plain, r"^-?([\d.]+)E", 1), r"\.0$", ""), F.lit("e-"), F.lpad((-power).cast("string"), 2, "0"))
    return F.when(~plain.contains("E"), plain).when(power >= 0, F.concat(sign, large)).when(power >= -4, F.concat(sign, small)).otherwise(F.concat(sign, tiny))


def point_id(collection: Column, video: Column, concept_id: Column, seconds: Column) -> Column:
    return url_uuid(F.concat_ws(":", collection, video, concept_id, seconds_text(seconds)))


def embed_text(notes: DataFrame) -> DataFrame:
    return notes.withColumn("embed_text", F.concat(F.col("concept"), F.lit("\n"), F.col("summary")))


def batches(texts: list[str], most: int = BATCH_INPUTS, most_tokens: int = BATCH_TOKENS) -> Iterator[tuple[int, int]]:
    """Ranges of texts that one request takes; a text is taken to have a token for every four characters, one at least."""
    first = tokens = 0
    for at, text in enumerate(texts):
        size = max(1, len(text) // 4)
        if at > first and (at - first >= most or tokens + size > most_tokens):
            yield first, at
            first, tokens = at, 0
        tokens += size
    if first < len(texts):
        yield first, len(texts)


def embedded(texts: DataFrame, embed: Callable[[list[str]], list[list[float]]], *, text_col: str = "embed_text") -> DataFrame:
    """``texts`` (its text column alone) with ``vector``; every distinct text reaches ``embed`` once."""

    def work(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for table in tables:
            listed = table[text_col].tolist()
            vectors = [v for a, b in batches(listed) for v in embed(listed[a:b])]
            yield pd.DataFrame({text_col: listed, "vector": vectors})

    ship(texts.sparkSession)
    return texts.select(text_col).distinct().mapInPandas(work, f"{text_col} string, vector array<double>")


def points(notes: DataFrame, videos: DataFrame, collection: str, vectors: DataFrame) -> DataFrame:
    """kb_points of ``notes``: ``videos`` (job_id, source_video) names a job's source, ``vectors`` has one for each embed_text."""
    named = embed_text(notes).join(videos, "job_id", "left").withColumn("source_video", F.coalesce("source_video", "job_id"))
    note = F.to_json(F.struct("concept", "canonical_concept_id", "summary", "code_snippet", "code_language", "diagram", "pitfalls", "depends_on", "source_timestamp", "partial"), {"ignoreNullFields": "false"})
    made = named.join(vectors, "embed_text")
    return made.select(point_id(F.lit(collection), F.col("source_video"), F.col("canonical_concept_id"), F.col("source_timestamp")).alias("id"), F.lit(collection).alias("collection"),
                       "source_video", "source_timestamp", "canonical_concept_id", "concept", "summary", "code_language", "depends_on",
                       T.searchable_text(F.col("concept"), F.col("summary"), F.col("code_snippet")).alias("text"), note.alias("note"), "vector",
                       F.struct("job_id", "note_ord").alias("at"))


def last_of_each(new: DataFrame, order: str = "at", id_col: str = "id") -> DataFrame:
    """Of points with one id the last in order; ``order`` goes."""
    window = Window.partitionBy(id_col).orderBy(F.desc(order))
    return new.withColumn("__n", F.row_number().over(window)).where("__n = 1").drop("__n", order)


def upsert(old: DataFrame, new: DataFrame, order: str = "at", id_col: str = "id") -> DataFrame:
    """All points after insert-or-replace of ``new`` by id; the last of repeated new ones wins."""
    latest = last_of_each(new, order, id_col)
    return old.join(latest.select(id_col), id_col, "left_anti").unionByName(latest)

"""Registered queries of the operators outside ``llm``, each with DuckDB SQL where SQL can express it.

The driver's tables stand in for jobs: a user's events or a conversation's turns are a video's
speech and pictures, documents are notes, embeddings are their vectors. Every query covers its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chalkline.functions import text as T
from chalkline.functions import vectors as V
from chalkline.operators import align, cells, distill, evaluate, knowledge, models, render, scenes, search, transcripts
from chalkline.resources.wordlists import CODE_KEYWORDS, stopwords
from chalkline.scratch import new_path, shared_dir, state_of
from chalkline.sources import store

#: What the search queries ask for, and the vocabulary that is looked for.
QUERY = "thnd ering the tion erth onst onst"
TERMS = ["for that", "onst", "und", "que los", "the of", "zz none"]
#: Characters that a speaker says in a second, where text stands for speech.
SPEED = 100.0


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Views are what is shown, other events what is said for a hundred times their value in seconds."""
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    rows = _read(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("job_id"), F.col("event_id"), (micros / F.lit(1e6)).alias("t"), "event_type", "value")
    none = F.lit(None).cast("string")
    shown = rows.where("event_type = 'view'").select("job_id", F.col("event_id").alias("vis_ord"), F.col("t").alias("timestamp"), F.lit("slide").alias("kind"), F.lit("").alias("text"),
                                                    none.alias("code_language"), F.lit("").alias("description"), F.lit("").alias("diagram"))
    words = F.array().cast("array<struct<start:double,end:double,text:string,probability:double>>")
    said = rows.where("event_type <> 'view'").select("job_id", F.col("event_id").alias("seg_ord"), F.col("t").alias("start"), (F.col("t") + F.col("value") * 100).alias("end"), F.col("event_type").alias("text"), words.alias("words"))
    return said, shown


_EVENTS = """
ev AS (SELECT CAST(user_id AS VARCHAR) AS job_id, event_id, epoch_us(ts) / 1e6 AS t, event_type, value FROM events),
v AS (SELECT job_id, event_id, t AS a, coalesce(lead(t) OVER w, CAST('infinity' AS DOUBLE)) AS b, row_number() OVER w - 1 AS idx FROM ev WHERE event_type = 'view' WINDOW w AS (PARTITION BY job_id ORDER BY t, event_id)),
s AS (SELECT job_id, event_id, t AS a, t + value * 100 AS b FROM ev WHERE event_type <> 'view'),
o AS (SELECT s.job_id, s.event_id, s.a, s.b, v.idx, greatest(0, least(s.b, v.b) - greatest(s.a, v.a)) AS shared FROM s JOIN v ON s.job_id = v.job_id),
placed AS (SELECT job_id, event_id, a, b, idx FROM (SELECT *, row_number() OVER (PARTITION BY job_id, event_id ORDER BY shared DESC, idx) AS r FROM o) WHERE r = 1)
"""


def anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    said, shown = _events(spark, sf_dir)
    return align.anchor(said, shown).select("job_id", F.col("seg_ord").alias("event_id"), F.col("idx").cast("int").alias("idx"))


def visual_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    said, shown = _events(spark, sf_dir)
    parts = align.chunks(align.anchor(said, shown), shown)
    start, end = align.bounds(F.col("segments"), F.col("visuals"))
    return parts.select("job_id", F.col("idx").cast("int").alias("idx"), start.alias("start"), end.alias("end"), F.size("segments").alias("n_segments"))


def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    said, shown = _events(spark, sf_dir)
    parts = align.chunks(align.anchor(said, shown), shown).withColumn("merges", F.lit(0))
    found = align.attach_orphans(parts)
    return found.select("job_id", F.when(F.col("idx") < 2147483647, F.col("idx")).cast("int").alias("idx"), F.size("visuals").alias("n_visuals"), F.size("segments").alias("n_segments"), F.col("orphans"))


def bounds_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's events but views, each a tenth of its value long, as one chunk of speech."""
    said, _ = _events(spark, sf_dir)
    said = said.withColumn("end", F.col("start") + (F.col("end") - F.col("start")) / 1000)
    listed = said.groupBy("job_id").agg(F.array_sort(F.collect_list(F.struct("start", "seg_ord", "end", "text", "words"))).alias("segments"))
    segments = F.transform("segments", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text"), s["words"].alias("words")))
    empty = F.array().cast("array<struct<timestamp:double,kind:string,text:string,code_language:string,description:string,diagram:string>>")
    parts = align.split_bounds(listed.select("job_id", F.lit(0).alias("idx"), segments.alias("segments"), empty.alias("visuals"), F.array().cast("array<string>").alias("flags")))
    return parts.select("job_id", "part", F.get("segments", F.lit(0))["start"].alias("start"), F.size("segments").alias("n_segments"))


def alignment_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    said, shown = _conversation(spark, sf_dir)
    _, report = align.align(said, shown, said.select("job_id").distinct().withColumn("language", F.lit("english")))
    return report


def _conversation(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """User turns are shown, other turns said; times follow the characters before."""
    order = Window.partitionBy("conv_id").orderBy("turn")
    size = F.length(F.coalesce("text", F.lit("")))
    before = F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = _read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("job_id"), F.col("turn").cast("int").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"), (before / F.lit(SPEED)).alias("t"), (size / F.lit(SPEED)).alias("d"))
    none, empty = F.lit(None).cast("string"), F.lit("")
    shown = rows.where("role = 'user'").select("job_id", F.col("turn").alias("vis_ord"), F.col("t").alias("timestamp"), F.lit("slide").alias("kind"), "text", none.alias("code_language"), empty.alias("description"), empty.alias("diagram"))
    words = F.array().cast("array<struct<start:double,end:double,text:string,probability:double>>")
    said = rows.where("role <> 'user'").select("job_id", F.col("turn").alias("seg_ord"), F.col("t").alias("start"), (F.col("t") + F.col("d")).alias("end"), "text", words.alias("words"))
    return said, shown


def lookahead(spark: SparkSession, sf_dir: str) -> DataFrame:
    said, shown = _conversation(spark, sf_dir)
    languages = said.select("job_id").distinct().withColumn("language", F.lit("English"))
    moved = align.lookahead(align.anchor(said, shown), shown, languages)
    return moved.select("job_id", F.col("seg_ord").alias("turn"), F.col("idx").cast("int").alias("idx"), "hops")


def line_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document against the one before it of its source."""
    order = Window.partitionBy("source", "block").orderBy("doc_id")
    docs = _read(spark, sf_dir, "documents").select("doc_id", "source", F.floor(F.col("doc_id") / 1000).alias("block"), T.lines(F.coalesce("text", F.lit(""))).alias("lines"))
    inside = docs.select("doc_id", F.lag("doc_id").over(order).alias("before_id"), "lines", F.lag("lines").over(order).alias("before")).where("before_id is not null")
    # the first of a block follows the last of the source's block before; a row for each block
    ends = docs.where("doc_id is not null").groupBy("source", "block").agg(F.min("doc_id").alias("doc_id"), F.min_by("lines", "doc_id").alias("lines"), F.max("doc_id").alias("last_id"), F.max_by("lines", "doc_id").alias("last"))
    blocks = Window.partitionBy("source").orderBy("block")
    seams = ends.select("doc_id", F.lag("last_id").over(blocks).alias("before_id"), "lines", F.lag("last").over(blocks).alias("before")).where("before_id is not null")
    pairs = inside.unionByName(seams)
    return pairs.select("doc_id", "before_id", V.line_share(F.col("before"), F.col("lines")).alias("share"))


def scroll_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job is a source's documents of one thousand ids, which an editor shows one after another."""
    docs = _read(spark, sf_dir, "documents").select(F.concat_ws("/", "source", F.floor(F.col("doc_id") / 1000).cast("string")).alias("job_id"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    none = F.lit(None).cast("string")
    shown = docs.select("job_id", F.col("doc_id").alias("vis_ord"), F.col("doc_id").cast("double").alias("timestamp"), F.lit("code").alias("kind"), "text", none.alias("code_language"), F.lit("").alias("description"), F.lit("").alias("diagram"))
    empty = spark.createDataFrame([], "job_id string, seg_ord bigint, start double, end double, text string, words array<struct<start:double,end:double,text:string,probability:double>>, idx int")
    made = align.merge_scrolls(align.chunks(empty, shown))
    first = F.get("visuals", F.lit(0))
    return made.select("job_id", F.col("idx").cast("int").alias("idx"), first["timestamp"].alias("timestamp"), "merges", F.length(first["text"]).alias("n_chars"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = _read(spark, sf_dir, "documents").select("doc_id", T.tokens(text).alias("t"))
    docs = docs.select("doc_id", "t", T.content_of(F.col("t")).alias("c"))  # tokens are made once
    return docs.select("doc_id", F.size("t").alias("n_tokens"), F.size("c").alias("n_content"), F.size(F.array_distinct("c")).alias("n_distinct"))


def content_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", T.language_code(F.coalesce("lang", F.lit(""))).alias("code"), F.coalesce("text", F.lit("")).alias("text"))
    return docs.select("doc_id", "code", F.size(T.content_words(F.col("text"), F.col("code"))).alias("n_words"))


def _document_index(spark: SparkSession, sf_dir: str) -> search.Index:
    """The kept index of the documents, built once for each state of their files in a session."""
    docs = _read(spark, sf_dir, "documents")
    path = f"{shared_dir(spark)}/words-{state_of(docs)}"
    if search.whole(spark, f"{path}/totals"):
        return search.Index.read(spark, path)
    return search.write_index(docs.select("doc_id", "text"), path, "doc_id")


def bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.bm25(_document_index(spark, sf_dir), QUERY)
    return found.select(F.col("id").alias("doc_id"), F.round("score", 6).alias("score"), "rank")


def _query_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    row = _read(spark, sf_dir, "embeddings").where("embedding is not null").orderBy("vec_id").select("embedding").first()
    return [float(x) for x in row[0]] if row else [0.0]


def vector_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.vector_ranking(_read(spark, sf_dir, "embeddings"), _query_vector(spark, sf_dir), id_col="vec_id", vector_col="embedding")
    return found.select(F.col("id").alias("vec_id"), F.round("score", 6).alias("score"), "rank")


def rank_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = search.bm25(_document_index(spark, sf_dir), QUERY)
    near = search.vector_ranking(_read(spark, sf_dir, "embeddings"), _query_vector(spark, sf_dir), id_col="vec_id", vector_col="embedding")
    return search.fuse([words, near]).select(F.col("id").alias("doc_id"), F.round("score", 9).alias("score"), "first_list", "first_rank")


def hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight best documents of both rankings; a document's vector is that of its id."""
    vectors = _read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    points = _read(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    found = search.hybrid(_document_index(spark, sf_dir), points, QUERY, _query_vector(spark, sf_dir), id_col="doc_id", vector_col="embedding", vectors=vectors)
    return found.select("doc_id", "lang", "source", F.round("score", 9).alias("score"))


def slug_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "part").select("p_partkey", T.slug(F.col("p_name")).alias("slug"), T.canonical_id(F.col("p_name"), "part").alias("concept_id"), T.dependency_ids(F.array("p_brand", "p_type"), "part").alias("depends_on"))


def concept_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.get(F.split(F.coalesce("text", F.lit("")), "\n"), F.lit(0))
    notes = _read(spark, sf_dir, "documents").select(F.lit("all").alias("job_id"), name.alias("concept")).withColumn("canonical_concept_id", T.canonical_id(F.col("concept"), "gen"))
    return distill.registry(notes).select("concept_key", "canonical_concept_id")


def vocabulary_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document is a job and its lines are what is said."""
    lines = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("job_id"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("seg_ord", "text")).withColumn("start", F.col("seg_ord").cast("double"))
    found = evaluate.vocabulary(lines, TERMS)
    return found.select(F.col("job_id").alias("doc_id"), "total", "found", F.array_join("missing", "|").alias("missing"))


def _document_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    text = F.coalesce("text", F.lit(""))
    return _read(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("job_id"), F.lit(0).alias("note_ord"), F.get(F.split(text, "\n"), F.lit(0)).alias("concept"), T.canonical_id(F.get(F.split(text, "\n"), F.lit(0)), "gen").alias("canonical_concept_id"),
        text.alias("summary"), none.alias("code_snippet"), none.alias("code_language"), none.alias("diagram"), F.array("source").alias("pitfalls"), F.array().cast("array<string>").alias("depends_on"),
        F.col("doc_id").cast("double").alias("source_timestamp"), F.lit(False).alias("partial"))


def reading_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document is a job's one note, its characters at fifteen a second the video's length, and its labels the frames."""
    docs = _read(spark, sf_dir, "documents")
    videos = docs.select(F.col("doc_id").cast("string").alias("job_id"), (F.col("n_chars") / F.lit(15.0)).alias("duration_s"))
    frames = _read(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("job_id"))
    found = evaluate.statistics(_document_notes(spark, sf_dir), videos, frames, videos)
    return found.select("job_id", "n_notes", "n_frames", *[F.round(c, 6).alias(c) for c in ("video_minutes", "reading_minutes", "compression_ratio", "est_cost_usd", "est_cost_per_video_hour")])


def grounding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation's first three turns are notes that are judged against the turn at their time; a turn of even length is supported."""
    rows = _read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("job_id"), F.col("turn").cast("int").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    words = F.array().cast("array<struct<start:double,end:double,text:string,probability:double>>")
    time = F.col("turn").cast("double")
    said = F.array(F.struct(time.alias("start"), time.alias("end"), F.col("text").alias("text"), words.alias("words")))
    shown = F.array().cast("array<struct<timestamp:double,kind:string,text:string,code_language:string,description:string,diagram:string>>")
    timeline = rows.where("role <> 'system'").select("job_id", F.col("turn").alias("chunk_ord"), time.alias("start"), said.alias("segments"), shown.alias("visuals"))
    notes = rows.select("job_id", F.col("turn").alias("note_ord"), time.alias("source_timestamp"), F.col("role").alias("concept"), F.col("text").alias("summary"))
    pairs = evaluate.grounding_pairs(notes, timeline, 3).withColumn("supported", F.length("source") % 2 == 0)
    found = evaluate.grounding(pairs)
    return found.select("job_id", "sampled", "supported", F.array_join(F.transform("unsupported", lambda u: u["source_timestamp"].cast("int").cast("string")), ",").alias("unsupported"))


def frame_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vector's signs are a frame's hash of 64 bits; a job has the vectors of one hundred ids."""
    bits = F.transform("embedding", lambda x: F.when(x >= 0, "1").otherwise("0"))
    frames = _read(spark, sf_dir, "embeddings").where("embedding is not null").select(F.floor(F.col("vec_id") / 100).cast("string").alias("job_id"), F.col("vec_id").alias("kf_ord"), F.col("vec_id").cast("double").alias("timestamp"),
                                                                                   F.lpad(F.lower(F.conv(F.array_join(bits, ""), 2, 16)), scenes.HASH_SIDE * scenes.HASH_SIDE // 4, "0").alias("phash"))
    return scenes.dedup_frames(frames, bits=24).select("job_id", F.col("kf_ord").alias("vec_id"))


def _scenes(spark: SparkSession, sf_dir: str, steps: int) -> DataFrame:
    """A scene is the time from one event of a user to the next, in hours as seconds on a grid of ``steps`` a second."""
    said, shown = _events(spark, sf_dir)
    order = Window.partitionBy("job_id").orderBy("t", "n")
    rows = said.select("job_id", F.col("start").alias("t"), F.col("seg_ord").alias("n")).unionByName(shown.select("job_id", F.col("timestamp").alias("t"), F.col("vis_ord").alias("n")))
    first = F.min("t").over(Window.partitionBy("job_id"))
    grid = rows.select("job_id", "n", "t", (F.floor((F.col("t") - first) / 3600 * steps) / steps).alias("a"))
    return grid.select("job_id", F.col("a").alias("start"), F.lead("a").over(order).alias("end")).where("end is not null")


def scene_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenes.candidate_times(_scenes(spark, sf_dir, 2))


def scene_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Middles of scenes on a grid of eighths are sixteenths, of which every fourth lies halfway between two thousandths."""
    return scenes.candidate_times(_scenes(spark, sf_dir, 8))


def point_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return docs.select("doc_id", knowledge.point_id(F.lit("docs"), F.col("source"), F.concat(F.lit("gen:"), F.col("lang")), F.col("doc_id") / F.lit(4.0)).alias("point_id"))


def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, replaced by a later batch of the labelled ones, which also brings each a second point."""
    docs = _read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.lit(1).alias("version"))
    labels = _read(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"), (F.col("quality") + 2).alias("version"))
    twice = labels.unionByName(labels.withColumn("version", F.col("version") + 2)).withColumn("at", F.col("version"))
    more = labels.select(F.concat("id", F.lit("/b")).alias("id"), F.col("version"), F.lit(0).alias("at"))
    return knowledge.upsert(docs, twice.unionByName(more))


def code_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("html", F.lit(""))
    return _read(spark, sf_dir, "pages").select("page_id", T.looks_like_code(text).alias("page_code"), T.looks_like_code(F.regexp_replace(text, "[{}]", "")).alias("without_braces"), T.looks_like_code(F.col("url")).alias("url_code"))


def timestamp_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.col("page_id") * F.lit(37.5) - 60
    video = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("https://youtube.com/watch?v="), F.col("page_id").cast("string"))).when(F.col("page_id") % 3 == 1, F.concat(F.lit("https://youtu.be/"), F.col("page_id").cast("string"))).otherwise(F.col("url"))
    return _read(spark, sf_dir, "pages").select("page_id", T.hms(seconds).alias("time"), T.timestamp_link(video, seconds).alias("link"))


def code_from_visuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation's turns as one chunk's visuals: an assistant's are code, a user's a whiteboard, a system's a slide."""
    rows = _read(spark, sf_dir, "conversations").select(F.col("conv_id"), "turn", F.when(F.col("role") == "assistant", "code").when(F.col("role") == "user", "whiteboard").otherwise("slide").alias("kind"), F.coalesce("text", F.lit("")).alias("text"))
    visual = F.struct(F.col("turn").alias("o"), F.col("kind").alias("kind"), F.col("text").alias("text"), F.when(F.col("turn") > 2, F.concat(F.lit("lang"), F.col("turn").cast("string"))).alias("code_language"), F.when(F.col("kind") == "slide", F.col("text")).otherwise("").alias("diagram"))
    chunks = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(visual)).alias("v"))
    return chunks.select("conv_id", distill.code_from_visuals(F.col("v")).alias("code"), distill.code_language(F.col("v")).alias("code_language"), distill.diagram(F.col("v")).alias("diagram"))


def audio_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's characters are its audio's seconds."""
    docs = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("job_id"), F.col("n_chars").cast("double").alias("duration_s"))
    return transcripts.audio_parts(docs).withColumnRenamed("job_id", "doc_id")


def digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation's digest: turns are notes, a second for each hundred characters."""
    order = Window.partitionBy("conv_id").orderBy("turn")
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"), (F.row_number().over(order) - 1).alias("note_ord"))
    code = F.when(F.col("role") == "assistant", F.col("role"))
    notes = rows.select(F.col("conv_id").cast("string").alias("job_id"), "note_ord", F.col("role").alias("concept"), F.concat(F.lit("gen:"), F.col("role")).alias("canonical_concept_id"), F.col("text").alias("summary"),
                        code.alias("code_snippet"), F.lit(None).cast("string").alias("diagram"), F.when(F.col("role") == "user", F.array("role")).otherwise(F.array().cast("array<string>")).alias("pitfalls"),
                        F.when(F.col("role") == "system", F.array("role", F.lit("x"))).otherwise(F.array().cast("array<string>")).alias("depends_on"), (F.col("turn") * F.lit(45.0)).alias("source_timestamp"), (F.col("turn") > 1).alias("partial"))
    videos = rows.groupBy("conv_id").agg(F.sum(F.length("text")).alias("n")).select(F.col("conv_id").cast("string").alias("job_id"), F.concat(F.lit("/videos/"), F.col("conv_id").cast("string"), F.lit(".mp4")).alias("source_path"), (F.col("n") / F.lit(SPEED)).alias("duration_s"))
    return render.digests(notes, videos)


def reply_fences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as replies: bare, and in two kinds of code fence."""
    text = F.coalesce("text", F.lit(""))
    raw = F.when(F.col("doc_id") % 3 == 0, text).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("```json\n"), text, F.lit("\n```"))).otherwise(F.concat(F.lit(" ```\n"), text, F.lit("\n``` \n")))
    return _read(spark, sf_dir, "documents").select("doc_id", F.md5(T.strip_fence(raw).cast("binary")).alias("digest"))


def request_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("prompt"))
    return models.keyed(asked, "complete", "m1", "prompt").select("doc_id", "key")


def frame_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates as probes write them, and texts that are none."""
    size, kind = F.col("p_size").cast("string"), F.col("p_partkey") % 4
    rate = F.when(kind == 0, F.concat(size, F.lit("/"), (F.col("p_partkey") % 7).cast("string"))).when(kind == 1, size).when(kind == 2, F.col("p_name")).otherwise(F.concat(size, F.lit("/1001/2")))
    return _read(spark, sf_dir, "part").select("p_partkey", F.round(T.frame_rate(rate), 6).alias("rate"))


def searchable(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = T.searchable_text(F.col("source"), F.col("text"), F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    return _read(spark, sf_dir, "documents").select("doc_id", F.md5(made.cast("binary")).alias("digest"))


def search_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as found notes, some without a video, a time or a language."""
    odd = F.col("doc_id") % 2 == 1
    found = _read(spark, sf_dir, "documents").select(F.concat(F.lit("gen:"), "doc_id").alias("canonical_concept_id"), F.lit("docs").alias("collection"), F.when(odd, F.col("source")).alias("source_video"), F.when(odd, F.col("n_chars").cast("double")).alias("source_timestamp"),
                                                     F.col("source").alias("concept"), F.lit(None).cast("string").alias("summary"), F.when(~odd, F.col("lang")).alias("code_language"), (F.col("doc_id") / 8).alias("score"))
    return search.results(found)


def joined_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation's turns as segments of three parts of an audio."""
    said, _ = _conversation(spark, sf_dir)
    part = (F.col("seg_ord") % 3).cast("int")
    cut = said.withColumn("part_ord", part).withColumn("offset", part * F.lit(600.0)).withColumn("text", F.concat(F.lit(" "), "text", F.lit("\n")))
    return transcripts.joined_segments(cut).select("job_id", "part_ord", F.col("seg_ord").alias("turn"), F.round("start", 6).alias("start"), F.round("end", 6).alias("end"), "text")


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.nearest(_read(spark, sf_dir, "embeddings"), _query_vector(spark, sf_dir), 10, id_col="vec_id", vector_col="embedding")
    return found.select(F.col("id").alias("vec_id"), F.round("score", 6).alias("score"))


def nearest_in_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``nearest_vectors``, from the cells that can hold them."""
    path = new_path(spark, "cells")
    cells.write(_read(spark, sf_dir, "embeddings"), path, id_col="vec_id", vector_col="embedding")
    found = cells.Cells.read(spark, [path], kind="bigint").nearest(_query_vector(spark, sf_dir), 10)
    return found.select(F.col("id").alias("vec_id"), F.round("score", 6).alias("score"))


def best_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents of the query's words, from the blocks of postings that can hold them."""
    return search.best(_document_index(spark, sf_dir), QUERY, 20).select(F.col("id").alias("doc_id"), F.round("score", 6).alias("score"))


def collection_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in a store, then the labelled ones again with other texts: the live points."""
    kept = store.ParquetStore(spark, new_path(spark, "kb"))
    none, text = F.lit(None).cast("string"), F.coalesce("text", F.lit(""))

    def points(docs: DataFrame, concept: str, said: Column) -> DataFrame:
        return docs.select(F.col("doc_id").cast("string").alias("id"), F.lit("docs").alias("collection"), F.col("source").alias("source_video"), F.lit(0.0).alias("source_timestamp"), F.lit("c").alias("canonical_concept_id"), F.lit(concept).alias("concept"),
                           text.alias("summary"), none.alias("code_language"), F.array().cast("array<string>").alias("depends_on"), said.alias("text"), F.lit("{}").alias("note"), F.lit(None).cast("array<double>").alias("vector"))

    docs = _read(spark, sf_dir, "documents")
    kept.upsert("docs", points(docs, "first", text))
    labelled = docs.join(_read(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    kept.upsert("docs", points(labelled, "second", F.concat(F.lit("again "), text)))
    return kept.all_points("docs").select(F.col("id").cast("long").alias("doc_id"), "concept", F.md5(F.col("text").cast("binary")).alias("digest"))


def _in(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


_STOP = {code: _in(stopwords(code)) for code in ("en", "tr")}
_TOKENS = "list_filter(list_transform(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9_:+#]+'), lambda x: regexp_replace(x, '^:+|:+$', '', 'g')), lambda x: x <> '')"
_WORDS = r"list_distinct(list_filter(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+'), lambda x: length(x) >= 2 AND x NOT IN (" + _STOP["en"] + ")))"
_ASKED = {w: search.query_tokens(QUERY).count(w) for w in search.query_tokens(QUERY)}
_BM25 = f"""
d AS (SELECT doc_id, list_filter({_TOKENS}, lambda x: length(x) > 1 AND x NOT IN ({_STOP['en']})) AS ts FROM documents),
n AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(len(ts)) AS avgdl FROM d),
p AS (SELECT doc_id, len(ts) AS dl, unnest(ts) AS token FROM d),
tf AS (SELECT doc_id, dl, token, count(*) AS tf FROM p GROUP BY ALL),
df AS (SELECT token, ln(n.n - count(*) + CAST(0.5 AS DOUBLE)) - ln(count(*) + CAST(0.5 AS DOUBLE)) AS idf FROM tf, n GROUP BY token, n.n),
q AS (SELECT * FROM (VALUES {', '.join(f"('{w}', {k})" for w, k in _ASKED.items())}) AS t(token, times)),
w AS (SELECT df.token, q.times, CASE WHEN idf < 0 THEN CAST(0.25 AS DOUBLE) * (SELECT avg(idf) FROM df) ELSE idf END AS idf FROM df JOIN q ON df.token = q.token),
x AS (SELECT doc_id, idf * (tf * CAST(2.5 AS DOUBLE) / (tf + CAST(1.5 AS DOUBLE) * (CAST(0.25 AS DOUBLE) + CAST(0.75 AS DOUBLE) * dl / avgdl))) * times AS part FROM tf JOIN w ON tf.token = w.token, n),
sc AS (SELECT doc_id AS id, list_reduce(list_sort(list(part)), lambda a, b: a + b) AS score FROM x GROUP BY doc_id),
words AS (SELECT id, score, row_number() OVER (ORDER BY score DESC, id) AS rank FROM sc WHERE score > 0)
"""
_VECTORS = """
qv AS (SELECT list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS q FROM embeddings WHERE embedding IS NOT NULL ORDER BY vec_id LIMIT 1),
cs AS (SELECT vec_id AS id, list_reduce(list_transform(range(1, len(q) + 1), lambda i: CAST(embedding[i] AS DOUBLE) * q[i]), lambda a, b: a + b)
       / (sqrt(list_reduce(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)), lambda a, b: a + b)) * sqrt(list_reduce(list_transform(q, lambda x: x * x), lambda a, b: a + b))) AS score FROM embeddings, qv),
near AS (SELECT id, score, row_number() OVER (ORDER BY score DESC, id) AS rank FROM cs WHERE score >= 0.15)
"""
_FUSED = """
r AS (SELECT id, rank, 0 AS list FROM words UNION ALL SELECT id, rank, 1 AS list FROM near),
f AS (SELECT id, sum(CAST(1 AS DOUBLE) / (60 + rank)) AS score, min(list * CAST(1000000000 AS BIGINT) + rank) AS met FROM r GROUP BY id)
"""
_CONV = f"""
c0 AS (SELECT CAST(conv_id AS VARCHAR) AS job_id, CAST(turn AS INTEGER) AS turn, role, coalesce(text, '') AS text FROM conversations),
c AS (SELECT *, coalesce(sum(length(text)) OVER (PARTITION BY job_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / CAST({SPEED} AS DOUBLE) AS t, length(text) / CAST({SPEED} AS DOUBLE) AS d FROM c0),
v AS (SELECT job_id, text, t AS a, coalesce(lead(t) OVER w, CAST('infinity' AS DOUBLE)) AS b, row_number() OVER w - 1 AS idx FROM c WHERE role = 'user' WINDOW w AS (PARTITION BY job_id ORDER BY t, turn)),
s AS (SELECT job_id, turn, text, t AS a, t + d AS b FROM c WHERE role <> 'user'),
o AS (SELECT s.job_id, s.turn, s.text, s.a, v.idx, greatest(0, least(s.b, v.b) - greatest(s.a, v.a)) AS shared FROM s JOIN v ON s.job_id = v.job_id),
placed AS (SELECT job_id, turn, text, a, idx FROM (SELECT *, row_number() OVER (PARTITION BY job_id, turn ORDER BY shared DESC, idx) AS r FROM o) WHERE r = 1),
vw AS (SELECT job_id, idx, b, {_WORDS} AS here FROM v),
vn AS (SELECT *, lead(here) OVER (PARTITION BY job_id ORDER BY idx) AS next FROM vw),
sw AS (SELECT job_id, turn, a, idx, {_WORDS} AS said FROM placed),
ok AS (SELECT sw.job_id, sw.turn, vn.idx - sw.idx AS step FROM sw JOIN vn ON sw.job_id = vn.job_id AND vn.idx >= sw.idx AND vn.next IS NOT NULL AND sw.a >= vn.b - 10 AND sw.a < vn.b
       WHERE len(list_intersect(said, next)) > len(list_intersect(said, here))),
hop AS (SELECT job_id, turn, count(*) AS hops FROM (SELECT *, row_number() OVER (PARTITION BY job_id, turn ORDER BY step) - 1 AS nth FROM ok) WHERE step = nth GROUP BY job_id, turn)
"""
_CODE = r"(contains({0}, ';') AND (regexp_matches({0}, '\b(" + "|".join(CODE_KEYWORDS) + r")\b') OR contains({0}, '=') OR contains({0}, '(')))"
_SPACES = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{_SPACES}]+|[{_SPACES}]+$', '', 'g')"


def _slug(x: str) -> str:
    return f"coalesce(nullif(trim(regexp_replace({_strip(f'lower({x})')}, '[^a-z0-9]+', '-', 'g'), '-'), ''), 'concept')"


def _hms(x: str) -> str:
    n = f"CAST(CASE WHEN {x} > 0 THEN floor({x}) ELSE 0 END AS BIGINT)"
    return f"printf('%02d:%02d:%02d', {n} // 3600, {n} % 3600 // 60, {n} % 60)"


_FIRST = "string_split(coalesce(text, ''), chr(10))[1]"
_LINK = "page_id * CAST(37.5 AS DOUBLE) - 60"
_N_WORDS = f"len(list_filter(regexp_split_to_array({_FIRST} || ' ' || coalesce(text, '') || ' ' || source, '[{_SPACES}]+'), lambda x: x <> ''))"

SQL: dict[str, str] = {
    "anchor": f"WITH {_EVENTS} SELECT job_id, event_id, CAST(idx AS INTEGER) AS idx FROM placed",
    "visual_chunks": f"WITH {_EVENTS} SELECT v.job_id, CAST(v.idx AS INTEGER) AS idx, least(v.a, coalesce(min(p.a), v.a)) AS start, greatest(v.a, coalesce(max(p.b), v.a)) AS \"end\", CAST(count(p.event_id) AS INTEGER) AS n_segments "
    "FROM v LEFT JOIN placed p ON v.job_id = p.job_id AND v.idx = p.idx GROUP BY v.job_id, v.idx, v.a",
    "orphans": f"WITH {_EVENTS}, n AS (SELECT v.job_id, v.idx, count(p.event_id) AS n FROM v LEFT JOIN placed p ON v.job_id = p.job_id AND v.idx = p.idx GROUP BY v.job_id, v.idx), "
    "h AS (SELECT *, min(CASE WHEN n > 0 THEN idx END) OVER (PARTITION BY job_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS home FROM n) "
    "SELECT job_id, CAST(home AS INTEGER) AS idx, CAST(count(*) AS INTEGER) AS n_visuals, CAST(sum(n) AS INTEGER) AS n_segments, CAST(count(*) FILTER (n = 0) AS INTEGER) AS orphans FROM h GROUP BY job_id, home",
    "bounds_split": f"WITH RECURSIVE {_EVENTS}, l AS (SELECT job_id, list(a ORDER BY a, event_id) AS a, list(a + (b - a) / 1000 ORDER BY a, event_id) AS b FROM s GROUP BY job_id), "
    "r AS (SELECT job_id, a, b, CAST(1 AS BIGINT) AS lo, CAST(len(a) AS BIGINT) AS hi FROM l UNION ALL "
    "SELECT job_id, a, b, CAST(CASE WHEN side = 0 THEN lo ELSE cut + 1 END AS BIGINT) AS lo, CAST(CASE WHEN side = 0 THEN cut ELSE hi END AS BIGINT) AS hi FROM ("
    "SELECT job_id, a, b, lo, hi, lo - 1 + list_position(list_transform(range(lo, hi), lambda k: a[k + 1] - b[k]), list_max(list_transform(range(lo, hi), lambda k: a[k + 1] - b[k]))) AS cut, unnest([0, 1]) AS side "
    "FROM r WHERE hi > lo AND b[hi] - a[lo] > 300)) "
    "SELECT job_id, CAST(row_number() OVER (PARTITION BY job_id ORDER BY lo) - 1 AS INTEGER) AS part, a[lo] AS start, CAST(hi - lo + 1 AS INTEGER) AS n_segments FROM r WHERE hi <= lo OR b[hi] - a[lo] <= 300",
    "lookahead": f"WITH {_CONV} SELECT p.job_id, p.turn, CAST(p.idx + coalesce(hops, 0) AS INTEGER) AS idx, CAST(coalesce(hops, 0) AS INTEGER) AS hops FROM placed p LEFT JOIN hop ON p.job_id = hop.job_id AND p.turn = hop.turn",
    "tokens": f"WITH d AS (SELECT doc_id, {_TOKENS} AS t FROM documents), c AS (SELECT doc_id, t, list_filter(t, lambda x: length(x) > 1 AND x NOT IN ({_STOP['en']})) AS c FROM d) "
    "SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, CAST(len(c) AS INTEGER) AS n_content, CAST(len(list_distinct(c)) AS INTEGER) AS n_distinct FROM c",
    "content_words": r"WITH d AS (SELECT doc_id, lower(coalesce(lang, '')) AS code, list_distinct(list_filter(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+'), lambda x: length(x) >= 2)) AS ws FROM documents) "
    f"SELECT doc_id, code, CAST(len(list_filter(ws, lambda x: NOT ((code = 'en' AND x IN ({_STOP['en']})) OR (code = 'tr' AND x IN ({_STOP['tr']}))))) AS INTEGER) AS n_words FROM d",
    "bm25": f"WITH {_BM25} SELECT id AS doc_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM words",
    "vector_ranking": f"WITH {_VECTORS} SELECT id AS vec_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM near",
    "rank_fusion": f"WITH {_BM25}, {_VECTORS}, {_FUSED} SELECT id AS doc_id, round(score, 9) AS score, CAST(met // 1000000000 AS INTEGER) AS first_list, CAST(met % 1000000000 AS INTEGER) AS first_rank FROM f",
    "hybrid_search": f"WITH {_BM25}, {_VECTORS.replace('FROM embeddings, qv)', 'FROM embeddings, qv WHERE vec_id IN (SELECT doc_id FROM documents))')}, {_FUSED}, b AS (SELECT * FROM f ORDER BY score DESC, met, id LIMIT 8) SELECT doc_id, lang, source, round(score, 9) AS score FROM b JOIN documents ON id = doc_id",
    "slug_ids": f"SELECT p_partkey, {_slug('p_name')} AS slug, 'part:' || {_slug('p_name')} AS concept_id, ['part:' || {_slug('p_brand')}, 'part:' || {_slug('p_type')}] AS depends_on FROM part",
    "concept_registry": f"SELECT DISTINCT {_strip(f'lower({_FIRST})')} AS concept_key, 'gen:' || {_slug(_FIRST)} AS canonical_concept_id FROM documents",
    "vocabulary_hits": "WITH d AS (SELECT doc_id, replace(lower(coalesce(text, '')), chr(10), ' ') AS t FROM documents), m AS (SELECT doc_id, list_filter(["
    + _in(TERMS) + r"], lambda x: NOT regexp_matches(t, '(^|[^\p{L}\p{N}_])' || x || '($|[^\p{L}\p{N}_])')) AS missing FROM d) "
    + f"SELECT doc_id, {len(TERMS)} AS total, CAST({len(TERMS)} - len(missing) AS INTEGER) AS found, array_to_string(missing, '|') AS missing FROM m",
    "reading_statistics": f"WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS job_id, n_chars / CAST(15 AS DOUBLE) AS s, {_N_WORDS} / CAST(200 AS DOUBLE) AS r FROM documents), l AS (SELECT CAST(doc_id AS VARCHAR) AS job_id, count(*) AS n FROM labels GROUP BY 1), "
    "x AS (SELECT d.job_id, s, r, coalesce(n, 0) AS n, coalesce(n, 0) * CAST(0.01 AS DOUBLE) + CAST(0.001 AS DOUBLE) AS cost FROM d LEFT JOIN l ON d.job_id = l.job_id) "
    "SELECT job_id, CAST(1 AS BIGINT) AS n_notes, n AS n_frames, round(s / 60, 6) AS video_minutes, round(r, 6) AS reading_minutes, CASE WHEN r > 0 THEN round(s / 60 / r, 6) END AS compression_ratio, round(cost, 6) AS est_cost_usd, CASE WHEN s > 0 THEN round(cost / (s / 3600), 6) END AS est_cost_per_video_hour FROM x",
    "grounding_join": "WITH c AS (SELECT CAST(conv_id AS VARCHAR) AS job_id, turn, role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS nth FROM conversations), "
    f"j AS (SELECT job_id, turn, CASE WHEN role = 'system' THEN length('(source chunk not found)') ELSE length({_strip(chr(39) + 'Said: ' + chr(39) + ' || text || chr(10) || ' + chr(39) + 'Shown:' + chr(39) + ' || chr(10)')}) END % 2 = 0 AS ok FROM c WHERE nth <= 3) "
    "SELECT job_id, count(*) AS sampled, count(*) FILTER (ok) AS supported, coalesce(string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) FILTER (NOT ok), '') AS unsupported FROM j GROUP BY job_id",
    "frame_dedup": "WITH RECURSIVE e AS (SELECT vec_id // 100 AS job, vec_id, list_reduce(list_transform(range(1, 65), lambda i: CASE WHEN embedding[i] >= 0 THEN CAST(1 AS UBIGINT) << CAST(64 - i AS UBIGINT) ELSE CAST(0 AS UBIGINT) END), lambda a, b: a | b) AS h, "
    "row_number() OVER (PARTITION BY vec_id // 100 ORDER BY vec_id) AS n FROM embeddings WHERE embedding IS NOT NULL), "
    "r AS (SELECT job, n, [h] AS kept, true AS k, vec_id FROM e WHERE n = 1 UNION ALL SELECT e.job, e.n, CASE WHEN g.near THEN g.kept ELSE list_append(g.kept, e.h) END, NOT g.near, e.vec_id FROM e JOIN LATERAL ("
    "SELECT r.kept, len(list_filter(r.kept, lambda x: bit_count(xor(x, e.h)) <= 24)) > 0 AS near FROM r WHERE r.job = e.job AND r.n = e.n - 1) g ON true) SELECT CAST(job AS VARCHAR) AS job_id, vec_id FROM r WHERE k",
    "scene_samples": f"WITH {_EVENTS}, g AS (SELECT job_id, t, event_id, floor((t - min(t) OVER (PARTITION BY job_id)) / 3600 * 2) / 2 AS a FROM ev), sc AS (SELECT job_id, a, lead(a) OVER (PARTITION BY job_id ORDER BY t, event_id) AS b FROM g), "
    "m AS (SELECT job_id, (a + b) / 2 AS t FROM sc WHERE b IS NOT NULL UNION SELECT job_id, a + 20 * unnest(generate_series(1, CAST(ceil((b - a) / 20) AS BIGINT) - 1)) AS t FROM sc WHERE b - a > 45) SELECT DISTINCT job_id, round(t, 3) AS timestamp FROM m",
    "scene_ties": f"WITH {_EVENTS}, g AS (SELECT job_id, t, event_id, floor((t - min(t) OVER (PARTITION BY job_id)) / 3600 * 8) / 8 AS a FROM ev), sc AS (SELECT job_id, a, lead(a) OVER (PARTITION BY job_id ORDER BY t, event_id) AS b FROM g), "
    "m AS (SELECT job_id, (a + b) / 2 AS t FROM sc WHERE b IS NOT NULL UNION SELECT job_id, a + 20 * unnest(generate_series(1, CAST(ceil((b - a) / 20) AS BIGINT) - 1)) AS t FROM sc WHERE b - a > 45) SELECT DISTINCT job_id, round_even(t, 3) AS timestamp FROM m",
    "point_ids": "WITH k AS (SELECT doc_id, sha1(unhex('" + knowledge.URL_NAMESPACE + "') || encode('docs:' || source || ':gen:' || lang || ':' || CAST(doc_id / CAST(4 AS DOUBLE) AS VARCHAR))) AS h FROM documents) "
    "SELECT doc_id, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || substr('89ab', 1 + (strpos('0123456789abcdef', h[17:17]) - 1) % 4, 1) || h[18:20] || '-' || h[21:32] AS point_id FROM k",
    "upsert": "WITH l AS (SELECT CAST(doc_id AS VARCHAR) AS id, quality + 2 AS version FROM labels) SELECT id, version + 2 AS version FROM l UNION ALL SELECT id || '/b' AS id, version FROM l UNION ALL "
    "SELECT CAST(doc_id AS VARCHAR) AS id, 1 AS version FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "code_like": "SELECT page_id, regexp_matches(coalesce(html, ''), '[{}]') OR " + _CODE.format("coalesce(html, '')") + " AS page_code, " + _CODE.format("regexp_replace(coalesce(html, ''), '[{}]', '', 'g')")
    + " AS without_braces, regexp_matches(url, '[{}]') OR " + _CODE.format("url") + " AS url_code FROM pages",
    "timestamp_links": f"WITH p AS (SELECT page_id, {_LINK} AS s, CASE page_id % 3 WHEN 0 THEN 'https://youtube.com/watch?v=' || page_id WHEN 1 THEN 'https://youtu.be/' || page_id ELSE url END AS u FROM pages) "
    f"SELECT page_id, {_hms('s')} AS time, '[' || {_hms('s')} || ']' || CASE WHEN regexp_matches(u, '^https?://') AND (contains(u, 'youtube.com') OR contains(u, 'youtu.be')) THEN '(' || u || CASE WHEN contains(u, '?') THEN '&' ELSE '?' END || 't=' || CAST(trunc(s) AS BIGINT) || ')' ELSE '' END AS link FROM p",
    "code_from_visuals": f"WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, {_strip('coalesce(text, chr(32))')} <> '' AS full_ FROM conversations), "
    "g AS (SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (role = 'assistant' AND full_) AS a, string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (role <> 'assistant' AND (regexp_matches(text, '[{}]') OR "
    + _CODE.format("text") + ")) AS w, min(turn) FILTER (role = 'assistant' AND full_ AND turn > 2) AS l, string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (role NOT IN ('assistant', 'user') AND full_) AS d FROM c GROUP BY conv_id) "
    "SELECT conv_id, coalesce(a, w) AS code, 'lang' || l AS code_language, d AS diagram FROM g",
    "audio_parts": "SELECT doc_id, CAST(k AS INTEGER) AS part_ord, k * CAST(600 AS DOUBLE) AS \"offset\" FROM (SELECT doc_id, unnest(generate_series(0, CAST(ceil(n_chars / CAST(600 AS DOUBLE)) AS BIGINT) - 1)) AS k FROM documents WHERE n_chars > 0)",
    "digests": "WITH c AS (SELECT CAST(conv_id AS VARCHAR) AS job_id, turn, role, coalesce(text, '') AS text, turn * CAST(45 AS DOUBLE) AS s FROM conversations), "
    f"n AS (SELECT *, len(list_filter(regexp_split_to_array(role || ' ' || text || CASE WHEN role = 'user' THEN ' ' || role ELSE '' END, '[{_SPACES}]+'), lambda x: x <> '')) AS w, '---' || chr(10) || chr(10) || concat_ws(chr(10) || chr(10), '## ' || role || chr(10) || chr(10) || '[' || {_hms('s')} || '] · concept `gen:' || role || '`', nullif(text, ''), "
    "CASE WHEN role = 'assistant' THEN '```' || chr(10) || role || chr(10) || '```' || CASE WHEN turn > 1 THEN chr(10) || '_(code fragment)_' ELSE '' END END, CASE WHEN role = 'user' THEN '**Pitfalls**' || chr(10) || chr(10) || '- ' || role END, "
    "CASE WHEN role = 'system' THEN '**Depends on:** `system`, `x`' END) || chr(10) || chr(10) AS md FROM c), "
    f"g AS (SELECT job_id, count(*) AS k, sum(length(text)) / CAST({SPEED} AS DOUBLE) AS d, sum(w) / CAST(200 AS DOUBLE) AS r, string_agg(md, '' ORDER BY turn) AS body FROM n GROUP BY job_id) "
    f"SELECT job_id, '# Study Digest' || chr(10) || chr(10) || 'Source: ' || job_id || '.mp4 · ' || k || ' note(s)' || chr(10) || chr(10) || body || '---' || chr(10) || chr(10) || '## Compression' || chr(10) || chr(10) || '- Video length: ' || {_hms('d')} || ' (' || printf('%.1f', d / 60) || ' min)' || chr(10) || "
    "'- Reading time: ~' || printf('%.1f', r) || ' min at 200 wpm' || chr(10) || '- Compression: ' || printf('%.1f', CASE WHEN r > 0 THEN d / 60 / r ELSE 0 END) || 'x' || chr(10) AS digest FROM g",
    "reply_fences": f"SELECT doc_id, md5({_strip("coalesce(text, '')")}) AS digest FROM documents",
    "request_keys": "SELECT doc_id, sha256(CAST(json_object('model', 'm1', 'operation', 'complete', 'prompt', coalesce(text, '')) AS VARCHAR)) AS key FROM documents",
    "frame_rates": "SELECT p_partkey, round(CASE WHEN p_partkey % 4 = 0 AND p_partkey % 7 > 0 THEN p_size / CAST(p_partkey % 7 AS DOUBLE) WHEN p_partkey % 4 = 1 THEN CAST(p_size AS DOUBLE) ELSE CAST(0 AS DOUBLE) END, 6) AS rate FROM part",
    "searchable": f"SELECT doc_id, md5({_strip("concat_ws(' ', nullif(source, ''), nullif(text, ''), CASE WHEN doc_id % 2 = 0 THEN nullif(lang, '') END)")}) AS digest FROM documents",
    "search_results": "SELECT 'gen:' || doc_id AS canonical_concept_id, 'docs' AS collection, CASE WHEN doc_id % 2 = 1 THEN coalesce(source, '') ELSE '' END AS source_video, CASE WHEN doc_id % 2 = 1 THEN coalesce(CAST(n_chars AS DOUBLE), 0) ELSE 0 END AS source_timestamp, "
    "coalesce(source, '') AS concept, '' AS summary, CASE WHEN doc_id % 2 = 0 THEN lang END AS code_language, doc_id / CAST(8 AS DOUBLE) AS score FROM documents",
    "joined_segments": f"WITH {_CONV} SELECT job_id, CAST(turn % 3 AS INTEGER) AS part_ord, turn, round(a + turn % 3 * CAST(600 AS DOUBLE), 6) AS start, round(b + turn % 3 * CAST(600 AS DOUBLE), 6) AS \"end\", {_strip('text')} AS text FROM s",
    "nearest_vectors": f"WITH {_VECTORS} SELECT id AS vec_id, round(score, 6) AS score FROM cs WHERE score IS NOT NULL ORDER BY cs.score DESC, id LIMIT 10",
    "nearest_in_cells": f"WITH {_VECTORS} SELECT id AS vec_id, round(score, 6) AS score FROM cs WHERE score IS NOT NULL ORDER BY cs.score DESC, id LIMIT 10",
    "best_words": f"WITH {_BM25} SELECT id AS doc_id, round(score, 6) AS score FROM words WHERE rank <= 20",
    "collection_versions": "SELECT doc_id, CASE WHEN l THEN 'second' ELSE 'first' END AS concept, md5(CASE WHEN l THEN 'again ' ELSE '' END || coalesce(text, '')) AS digest FROM (SELECT *, doc_id IN (SELECT doc_id FROM labels) AS l FROM documents)",
    "alignment_report": f"WITH RECURSIVE {_CONV}, pl AS (SELECT p.job_id, p.turn, p.idx + coalesce(hops, 0) AS idx, coalesce(hops, 0) AS hops FROM placed p LEFT JOIN hop ON p.job_id = hop.job_id AND p.turn = hop.turn), "
    "n AS (SELECT v.job_id, v.idx, count(pl.turn) AS n FROM v LEFT JOIN pl ON v.job_id = pl.job_id AND v.idx = pl.idx GROUP BY v.job_id, v.idx), "
    "h AS (SELECT *, min(CASE WHEN n > 0 THEN idx END) OVER (PARTITION BY job_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS home FROM n), "
    "ch AS (SELECT pl.job_id, pl.idx AS home, list(s.a ORDER BY s.a, s.turn) AS a, list(s.b ORDER BY s.a, s.turn) AS b FROM pl JOIN s ON pl.job_id = s.job_id AND pl.turn = s.turn GROUP BY pl.job_id, pl.idx UNION ALL "
    "SELECT job_id, 0 AS home, list(a ORDER BY a, turn) AS a, list(b ORDER BY a, turn) AS b FROM s WHERE job_id NOT IN (SELECT job_id FROM v) GROUP BY job_id), "
    "r AS (SELECT job_id, a, b, CAST(1 AS BIGINT) AS lo, CAST(len(a) AS BIGINT) AS hi FROM ch UNION ALL "
    "SELECT job_id, a, b, CAST(CASE WHEN side = 0 THEN lo ELSE cut + 1 END AS BIGINT) AS lo, CAST(CASE WHEN side = 0 THEN cut ELSE hi END AS BIGINT) AS hi FROM ("
    "SELECT job_id, a, b, lo, hi, lo - 1 + list_position(list_transform(range(lo, hi), lambda k: a[k + 1] - b[k]), list_max(list_transform(range(lo, hi), lambda k: a[k + 1] - b[k]))) AS cut, unnest([0, 1]) AS side "
    "FROM r WHERE hi > lo AND b[hi] - a[lo] > 300)), "
    "leaf AS (SELECT job_id, count(*) AS parts, sum(hi - lo + 1) AS segs FROM r WHERE hi <= lo OR b[hi] - a[lo] <= 300 GROUP BY job_id), "
    "orp AS (SELECT job_id, count(*) FILTER (n = 0) AS orphans, max(CASE WHEN home IS NULL THEN 1 ELSE 0 END) AS behind FROM h GROUP BY job_id), mv AS (SELECT job_id, sum(hops) AS moves FROM pl GROUP BY job_id) "
    "SELECT j.job_id, CAST(coalesce(parts, 0) + coalesce(behind, 0) AS INTEGER) AS chunk_count, CAST(coalesce(segs, 0) AS INTEGER) AS segment_count, CAST(coalesce(moves, 0) AS INTEGER) AS lookahead_moves, 0 AS scroll_merges, CAST(coalesce(orphans, 0) AS INTEGER) AS orphans "
    "FROM (SELECT job_id FROM s UNION SELECT job_id FROM v) j LEFT JOIN leaf ON j.job_id = leaf.job_id LEFT JOIN orp ON j.job_id = orp.job_id LEFT JOIN mv ON j.job_id = mv.job_id",
    # the table of common lines, a row of it for each line of the document before
    "line_share": f"WITH RECURSIVE s AS (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS x FROM documents), "
    f"d AS (SELECT doc_id, source, list_transform(CASE WHEN x[-1] = '' THEN x[1 : len(x) - 1] ELSE x END, lambda l: regexp_replace(l, '[{_SPACES}]+$', '')) AS ls FROM s), "
    "p AS (SELECT * FROM (SELECT doc_id, lag(doc_id) OVER w AS before_id, lag(ls) OVER w AS a, ls AS b FROM d WINDOW w AS (PARTITION BY source ORDER BY doc_id)) WHERE before_id IS NOT NULL), "
    "r AS (SELECT doc_id, 0 AS i, list_transform(range(0, len(b) + 1), lambda j: 0) AS t FROM p UNION ALL "
    "SELECT r.doc_id, r.i + 1 AS i, list_transform(range(0, len(b) + 1), lambda j: greatest(r.t[j + 1], coalesce(list_max(list_transform(range(1, j + 1), lambda k: CASE WHEN b[k] = a[r.i + 1] THEN r.t[k] + 1 ELSE 0 END)), 0))) AS t "
    "FROM r JOIN p ON r.doc_id = p.doc_id WHERE r.i < len(a)) "
    "SELECT p.doc_id, before_id, CASE WHEN least(len(a), len(b)) > 0 THEN CAST(t[-1] AS DOUBLE) / least(len(a), len(b)) ELSE CAST(0 AS DOUBLE) END AS share FROM p JOIN r ON p.doc_id = r.doc_id AND r.i = len(a)",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = (anchor, visual_chunks, orphans, bounds_split, alignment_report, lookahead, line_share, scroll_merge, tokens, content_words, bm25, vector_ranking, rank_fusion, hybrid_search, slug_ids, concept_registry,
              vocabulary_hits, reading_statistics, grounding_join, frame_dedup, scene_samples, point_ids, upsert, code_like, timestamp_links, code_from_visuals, audio_parts, digests, reply_fences, request_keys, frame_rates, searchable, search_results,
              joined_segments, nearest_vectors, nearest_in_cells, best_words, collection_versions, scene_ties)
    return {f.__name__: f for f in listed}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

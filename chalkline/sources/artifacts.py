"""Artifacts of jobs: one JSON document for each kind in a job's folder, read as tables of many jobs and written back."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chalkline import schemas
from chalkline.functions import text as T


def _job_of_file() -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)/[^/]+$", 1)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def load(spark: SparkSession, job_dirs: list[str], kind: str) -> DataFrame:
    """(job_id, ...) of one kind's documents; unknown keys are ignored. A job without the document is an error that names its stage."""
    name, _, stage = schemas.ARTIFACTS[kind]
    missing = [d for d in job_dirs if not _exists(spark, f"{d}/{name}")]
    if missing:
        raise FileNotFoundError(f"{missing[0]}/{name} is missing; the stage {stage} makes it")
    return _read(spark, [f"{d}/{name}" for d in job_dirs], kind)


def _read(spark: SparkSession, paths: list[str], kind: str) -> DataFrame:
    schema = schemas.artifact(kind)
    if not paths:
        return spark.createDataFrame([], schema).select(F.lit("").alias("job_id"), "*")
    return spark.read.schema(schema).option("multiLine", True).json(paths).select(_job_of_file().alias("job_id"), "*")


def try_load(spark: SparkSession, job_dirs: list[str], kind: str) -> DataFrame:
    """As ``load``, of those jobs that have the document."""
    name = schemas.ARTIFACTS[kind][0]
    return _read(spark, [f"{d}/{name}" for d in job_dirs if _exists(spark, f"{d}/{name}")], kind)


def exploded(documents: DataFrame, column: str, ordinal: str) -> DataFrame:
    """A row for each element of a document's list, with its place."""
    return documents.select("job_id", F.posexplode(column).alias(ordinal, "__e")).select("job_id", ordinal, "__e.*")


def read_notes(spark: SparkSession, job_dirs: list[str]) -> DataFrame:
    """The table notes: lines of notes.jsonl where a job has that file, else its notes.json; none for a job without either."""
    lined = [f"{d}/notes.jsonl" for d in job_dirs if _exists(spark, f"{d}/notes.jsonl")]
    rest = [d for d in job_dirs if f"{d}/notes.jsonl" not in lined]
    whole = exploded(try_load(spark, rest, "notes"), "notes", "note_ord")
    if not lined:
        return whole
    order = F.monotonically_increasing_id()
    text = spark.read.text(lined).select(_job_of_file().alias("job_id"), "value", order.alias("at")).where(~T.is_blank(F.col("value")))
    note = text.select("job_id", "at", F.from_json("value", schemas.struct(schemas.NOTE_FIELDS), {"mode": "FAILFAST"}).alias("n"))
    from pyspark.sql import Window

    numbered = note.withColumn("note_ord", F.row_number().over(Window.partitionBy("job_id").orderBy("at")) - 1)
    return numbered.select("job_id", "note_ord", "n.*").unionByName(whole)


def source_videos(spark: SparkSession, job_dirs: list[str]) -> DataFrame:
    """(job_id, source_video): the name of the file that a job came from, or the job's own."""
    jobs = spark.createDataFrame([(d.rstrip("/").rsplit("/", 1)[-1],) for d in job_dirs], "job_id string")
    named = try_load(spark, job_dirs, "video").select("job_id", F.regexp_extract("source_path", "([^/]+)/*$", 1).alias("source_video"))
    return jobs.join(named, "job_id", "left").select("job_id", F.coalesce("source_video", "job_id").alias("source_video"))


def probe(documents: DataFrame) -> DataFrame:
    """(job_id, duration_s, width, height, fps) of a media probe's JSON (job_id, json): the first video stream, whose length stands in for a missing one."""
    schema = "format struct<duration:string>, streams array<struct<codec_type:string,width:int,height:int,r_frame_rate:string,duration:string>>"
    found = documents.select("job_id", F.from_json("json", schema).alias("p"))
    stream = F.get(F.filter("p.streams", lambda s: s["codec_type"] == "video"), F.lit(0))
    rows = found.select("job_id", F.col("p.format.duration").try_cast("double").alias("d"), stream.alias("s"))
    length = F.when(F.col("d") > 0, F.col("d")).otherwise(F.coalesce(F.col("s.duration").try_cast("double"), F.lit(0.0)))
    return rows.where(F.col("s").isNotNull()).select("job_id", length.alias("duration_s"), F.coalesce("s.width", F.lit(0)).alias("width"), F.coalesce("s.height", F.lit(0)).alias("height"), T.frame_rate(F.coalesce(F.col("s.r_frame_rate"), F.lit(""))).alias("fps"))


def documents(table: DataFrame, kind: str) -> DataFrame:
    """(job_id, json): a kind's document for each row of ``table`` (job_id and the document's columns)."""
    names = schemas.artifact(kind).fieldNames()
    return table.select("job_id", F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("json"))


def nested(rows: DataFrame, ordinal: str, column: str) -> DataFrame:
    """The opposite of ``exploded``: a job's rows as one list."""
    fields = [c for c in rows.columns if c not in ("job_id", ordinal)]
    listed = F.array_sort(F.collect_list(F.struct(F.col(ordinal).alias("__o"), F.struct(*fields).alias("__e"))))
    return rows.groupBy("job_id").agg(F.transform(listed, lambda x: x["__e"]).alias(column))


def save(document: dict, job_dir: str | Path, kind: str) -> Path:
    """One job's document, indented, in its folder."""
    path = Path(job_dir) / schemas.ARTIFACTS[kind][0]
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(document, indent=2, ensure_ascii=False), encoding="utf-8")
    return path


def write_notes(notes: DataFrame, path: str) -> None:
    """A folder of JSON lines for each job."""
    fields = [c for c in notes.columns if c not in ("job_id", "note_ord")]
    lined = notes.select("job_id", "note_ord", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"))
    lined.repartition("job_id").sortWithinPartitions("job_id", "note_ord").select("job_id", "value").write.mode("overwrite").partitionBy("job_id").text(path)

"""Notes that arrive as files, upserted into a collection by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chalkline import schemas
from chalkline.operators import knowledge
from chalkline.providers import Provider
from chalkline.sources.store import Store


def note_stream(spark: SparkSession, path: str, *, files_at_once: int = 100) -> DataFrame:
    """Lines of notes.jsonl files in folders of jobs, as a stream of notes."""
    lines = spark.readStream.schema(schemas.struct(schemas.NOTE_FIELDS)).option("maxFilesPerTrigger", files_at_once).option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").json(path)
    return lines.select(F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)/[^/]+$", 1).alias("job_id"), "*")


def upsert_stream(notes: DataFrame, collection: str, store: Store, embedder: Provider, model: str, checkpoint: str, *, once: bool = True) -> StreamingQuery:
    """Start the stream; ``once`` takes what is there and stops. Upserts are by id, so a repeated batch changes nothing."""

    def batch(rows: DataFrame, _: int) -> None:
        if rows.isEmpty():
            return
        rows = rows.withColumn("note_ord", F.monotonically_increasing_id()).persist()  # orders equal ids of one batch
        vectors = knowledge.embedded(knowledge.embed_text(rows), lambda listed: embedder.embed(listed, model=model)).persist()
        store.ensure_collection(collection, vectors.select(F.size("vector").alias("d")).first().d)
        videos = rows.select("job_id").distinct().withColumn("source_video", F.col("job_id"))
        store.upsert(collection, knowledge.points(rows, videos, collection, vectors))
        vectors.unpersist()
        rows.unpersist()

    writer = notes.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()

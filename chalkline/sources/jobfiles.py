"""Files of job folders as a data sink: tasks write drafts, a commit gives them their names.

``df.write.format("chalkline_job_files")`` takes rows (folder, name, text). Each task writes its rows' texts beside their
places; when all tasks are done the drafts are renamed, so a job that fails leaves every folder as it was and a repeated task only leaves a draft
that nothing names. The driver learns places alone, no text. Folders may be local paths (of a local master) or URIs that Arrow opens.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from chalkline.scratch import seen_by_all
from chalkline.shipping import ship

FORMAT = "chalkline_job_files"


def _at(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder)


@dataclass
class Drafts(WriterCommitMessage):
    """(folder, name, draft) of each file that a task wrote."""

    files: list[tuple[str, str, str]]


class JobFilesWriter(DataSourceArrowWriter):
    def write(self, iterator: Iterator[pa.RecordBatch]) -> Drafts:
        made = []
        for batch in iterator:
            for folder, name, text in zip(*(c.to_pylist() for c in batch.columns)):
                where, base = _at(folder)
                where.create_dir(base, recursive=True)
                draft = f".{name}.{uuid.uuid4().hex}"
                if name.endswith(".json"):
                    text = json.dumps(json.loads(text), indent=2, ensure_ascii=False)
                with where.open_output_stream(f"{base}/{draft}") as file:
                    file.write(text.encode())
                made.append((folder, name, draft))
        return Drafts(made)

    def commit(self, messages: list[Drafts | None]) -> None:
        for message in messages:
            for folder, name, draft in message.files if message else ():
                where, base = _at(folder)
                where.move(f"{base}/{draft}", f"{base}/{name}")

    def abort(self, messages: list[Drafts | None]) -> None:
        for message in messages:
            for folder, _, draft in message.files if message else ():
                where, base = _at(folder)
                where.delete_file(f"{base}/{draft}")


class JobFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "folder string, name string, text string"

    def writer(self, schema, overwrite: bool) -> JobFilesWriter:
        return JobFilesWriter()


def write(texts: DataFrame, name: str, folders: dict[str, str]) -> None:
    """Write each row's ``text`` (job_id, text) as the file ``name`` of its job's folder."""
    spark = texts.sparkSession
    ship(spark)
    spark.dataSource.register(JobFiles)
    listed = spark.createDataFrame([(job, seen_by_all(spark, folder)) for job, folder in folders.items()], "job_id string, folder string")  # names alone
    texts.join(F.broadcast(listed), "job_id").select("folder", F.lit(name).alias("name"), "text").write.format(FORMAT).mode("append").save()

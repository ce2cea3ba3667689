"""Tables on the way to a result, in the folder that the driver and all executors share."""

from __future__ import annotations

import hashlib
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from chalkline.errors import ChalklineError


def session(df: DataFrame) -> SparkSession:
    return df.sparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors see.

    It is ``spark.checkpoint.dir``; only a local master, where all run on one
    machine, gets a folder of its own when that is unset.
    """
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + os.path.join(tempfile.gettempdir(), "checkpoints")
    # with its scheme, so that Spark and Arrow take it for the same folder
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(found)
    whole = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    whole = whole.replace("file:/", "file:///", 1) if whole.startswith("file:/") and not whole.startswith("file://") else whole
    return f"{whole.rstrip('/')}/chalkline-{spark.sparkContext.applicationId}"


def seen_by_all(spark: SparkSession, folder: str) -> str:
    """``folder``, unless it is a bare local path on a cluster: there each machine would have its own. A ``file://`` path says that it is shared."""
    if "://" not in folder and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ChalklineError(f"{folder!r} is a local path; name a folder that all executors share")
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage and outlives executors."""
    spark = session(df)
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def state_of(table: DataFrame) -> str:
    """A digest of the names, sizes and times of a table's files: another one as soon as one of them changes."""
    spark = session(table)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    told = []
    for file in sorted(table.inputFiles()):
        path = jvm.org.apache.hadoop.fs.Path(file)
        status = path.getFileSystem(conf).getFileStatus(path)
        told.append(f"{file} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(told).encode()).hexdigest()[:24]


def remove(spark: SparkSession, *tables: DataFrame | str) -> None:
    """Delete written tables (or folders) that no later plan reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for table in tables:
        if not isinstance(table, str):
            files = table.inputFiles()
            if not files:
                continue
            table = files[0].rsplit("/", 1)[0]
        path = jvm.org.apache.hadoop.fs.Path(table)
        path.getFileSystem(conf).delete(path, True)


def clear(spark: SparkSession) -> None:
    """Delete all that this session's operators wrote; results not yet saved become unreadable."""
    remove(spark, shared_dir(spark))

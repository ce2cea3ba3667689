"""A training corpus in five stages: toxicity, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and read again as the
next one's documents; all but the last return the columns of documents.

Edge cases: a null or empty text is never toxic, has no lines and holds no item; all of them are copies of each
other, so the one of the smallest id is kept and packed as its end id alone. A text that line dedup leaves empty is one
of these. Rows that agree in id and text are one place to line dedup and copies to near-dedup, of which one stays; a
null id sorts first among lines and last among copies. A null lang or source stays null; n_chars is the
length of the text, null for a null one. Very long texts are taken whole by every stage. Empty documents give no rows, an empty
table of labels rejects nothing, an empty benchmark drops nothing. Extra columns pass every stage but the last, whatever
their names; one called lines_removed is dropped by line dedup.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chalkline.llm import decontam, linededup, nearcopies, packing, toxicity
from chalkline.llm.common import written
from chalkline.llm.queries import CATEGORIES, TOKENIZER


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.reject(docs, labels, CATEGORIES, CATEGORIES[-1])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of lines go; n_chars follows the text. Every document stays."""
    cut = linededup.dedup_lines(docs)
    columns = [F.length("text").cast(t).alias(c) if c == "n_chars" else F.col(c) for c, t in docs.dtypes]
    return cut.select(*columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id: SimHash of five-word shingles, verified at a similarity of 0.8 or more, and bands for what its radius can't reach."""
    return nearcopies.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    pieces = packing.pack(docs, public_tokenizers.path(TOKENIZER), end_id=2, capacity=4096)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", keep_one_of_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("packing", pack),
]

#: SQL cannot express the classifier, the fingerprints or the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage{at}")
    return docs

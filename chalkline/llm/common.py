"""What the operators share: the shared folder, written tables, code shipping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chalkline import shipping
from chalkline.scratch import clear, new_path, remove, session, shared_dir, written

__all__ = ["absent", "clear", "crc_of_id", "new_path", "partitions", "remove", "same", "session", "shared_dir", "ship", "written"]

#: Characters that separate words: space and the ASCII controls from tab to carriage return.
SPACES = r"\x20\x09-\x0D"
#: Bytes of a batch that goes to a Python worker, and the setting that holds them.
BATCH_BYTES, ARROW_BYTES = "8m", "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, and take batches of bounded size.

    Long texts would make batches of Spark's default bytes; a limit that the user has set stays.
    """
    if spark.conf.get(ARROW_BYTES, None) in (None, "64m", "67108864", "67108864b"):
        spark.conf.set(ARROW_BYTES, BATCH_BYTES)
    shipping.ship(spark)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_of_id(column: str, modulus: int) -> F.Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(modulus)


def absent(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        k = 0
        while f"__{name}{k or ''}" in taken:
            k += 1
        out.append(f"__{name}{k or ''}")
    return out


def same(left: F.Column, right: F.Column) -> F.Column:
    return left.eqNullSafe(right)

"""Column functions on vectors and bit strings, and the line-sequence similarity."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from chalkline.shipping import ship


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine in doubles; null if either vector is null or zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def hex_words(text: Column, width: int) -> Column:
    """A hexadecimal string of ``width`` digits (a multiple of 16) as 64-bit integers; shorter ones are filled with zeros."""
    padded = F.lpad(F.lower(text), width, "0")
    part = lambda i: F.conv(F.substring(padded, i * 16 + 1, 16), 16, -10).cast("long")
    return F.array(*[part(i) for i in range(width // 16)])


def hamming(a: Column, b: Column) -> Column:
    """Bits that two arrays of integers differ in."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda acc, x: acc + x)


def common_lines(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, by the bits of one integer for a whole row of the table."""
    where: dict[str, int] = {}
    for i, line in enumerate(b):
        where[line] = where.get(line, 0) | 1 << i
    full = (1 << len(b)) - 1
    row = full
    for line in a:
        match = row & where.get(line, 0)
        row = (row + match | row - match) & full
    return len(b) - row.bit_count()


@F.pandas_udf(IntegerType())
def lcs_length(a: pd.Series, b: pd.Series) -> pd.Series:
    """Length of the longest common subsequence of two arrays of lines; null if either is null."""
    return pd.Series([None if x is None or y is None else common_lines(list(x), list(y)) for x, y in zip(a, b)], dtype="Int32")


def line_share(a: Column, b: Column) -> Column:
    """Lines in common, in order, against the shorter of two arrays of lines; 0 if either is empty."""
    ship()
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, lcs_length(a, b) / least.cast("double")).otherwise(F.lit(0.0))

"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Texts are equal when they are identical after every run of ASCII white space became one space. Rows are written once, each part by
one task. A part sends its distinct fingerprints (the upper ``BITS`` bits of a 64-bit hash), sorted, to the owners of
their ranges: gaps between neighbours in a Golomb code whose divisor is a power of two, and one bit for each that the part
holds more than once. An owner decodes all lists of its range and answers each with a bitmap of the fingerprints that
are held elsewhere or repeated. A part's own list and the bitmaps, kept in its folder (``parts``), mark its suspects;
all others are known to be single and are never shuffled. Suspects are verified byte by
byte: they are grouped by digest and whole text, first within each task, so that a text that a third of all rows hold
arrives once a task. A group's verdict goes back to the parts that hold it and meets the rows there.

The number of owners grows with the rows, so that an owner's fingerprints fit in a task.

Edge cases: a null text counts as empty, and all empty ones are equal. The row of the smallest id stays, null ids last;
of rows that share that id, too, one stays, the first read. Ids may be of any type that has an order. A very long text is one value of
its row, as in the input. An empty table gives an empty result. Extra columns, whatever their names, are kept by ``drop_copies`` alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, partitions, session, ship, written
from .parts import Answers, keep

#: Bits of a fingerprint, and about how many an owner gets.
BITS, OWNED = 48, 2_000_000
MESSAGE = "piece long, owner long, n long, shift long, coded binary, repeated binary"


def encode(values: np.ndarray, low: int, high: int) -> tuple[int, bytes]:
    """Golomb code of ascending distinct values in [low, high): shift of the divisor, and quotients in unary before remainders."""
    gaps = np.diff(values, prepend=low)
    mean = (high - low) / max(1, len(values))
    shift = max(0, int(mean * 0.69).bit_length() - 1)
    ends = np.cumsum((gaps >> shift) + 1) - 1
    unary = np.zeros(-(-(int(ends[-1]) + 1) // 8) * 8 if len(ends) else 0, bool)
    unary[ends] = True
    rest = (gaps[:, None] >> np.arange(shift)) & 1
    return shift, np.packbits(unary).tobytes() + np.packbits(rest.astype(bool).ravel()).tobytes()


def decode(coded: bytes, n: int, shift: int, low: int) -> np.ndarray:
    """The values of ``encode``."""
    data = np.frombuffer(coded, np.uint8)
    in_rest = -(-n * shift // 8)
    unary = np.unpackbits(data[: len(data) - in_rest])
    ends = np.flatnonzero(unary)
    gaps = np.diff(ends, prepend=-1) - 1 << shift
    if shift:
        rest = np.unpackbits(data[len(data) - in_rest :])[: n * shift].reshape(n, shift)
        gaps = gaps + rest.astype(np.int64) @ (1 << np.arange(shift))
    return low + np.cumsum(gaps)


def owner_bounds(owners: int) -> np.ndarray:
    """Where each owner's range of fingerprints begins, and the end of the last."""
    return np.array([(k << BITS) // owners for k in range(owners + 1)], np.int64)


def _messages(bounds: np.ndarray):
    """Batches of (part, code) of one task into messages to the owners."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = TaskContext.get().partitionId()
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            parts, codes = (c.to_numpy() for c in batch.columns)
            for part in np.unique(parts).tolist():
                held.setdefault(part, []).append(codes[parts == part])
        for part, codes in held.items():
            values, times = np.unique(np.concatenate(codes), return_counts=True)
            cuts = np.searchsorted(values, bounds)
            rows = []
            for owner in np.flatnonzero(np.diff(cuts)).tolist():
                some = slice(cuts[owner], cuts[owner + 1])
                shift, coded = encode(values[some], int(bounds[owner]), int(bounds[owner + 1]))
                rows.append((part, piece, owner, len(values[some]), shift, coded, np.packbits(times[some] > 1).tobytes()))
            kinds = [pa.int64()] * 5 + [pa.binary()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["part", "piece", "owner", "n", "shift", "coded", "repeated"])

    return work


def _bitmaps(bounds: np.ndarray):
    """All messages to one owner into a bitmap for each."""

    def work(messages: pd.DataFrame) -> pd.DataFrame:
        low = int(bounds[messages["owner"].iloc[0]])
        lists = [decode(c, n, s, low) for c, n, s in zip(messages["coded"], messages["n"], messages["shift"])]
        values = np.concatenate(lists)
        again = np.concatenate([np.unpackbits(np.frombuffer(r, np.uint8))[:n] for r, n in zip(messages["repeated"], messages["n"])]).astype(bool)
        order = np.argsort(values, kind="stable")
        alike = np.append(False, values[order][1:] == values[order][:-1])
        again[order] |= alike | np.append(alike[1:], False)
        marks = np.split(again, np.cumsum(messages["n"])[:-1])
        return pd.DataFrame({"part": messages["part"], "piece": messages["piece"], "owner": messages["owner"], "bitmap": [np.packbits(m).tobytes() for m in marks]})

    return work


def _marker(sent: str, answered: str, bounds: np.ndarray):
    """A column function: is the fingerprint of this row of this part marked?"""

    @F.pandas_udf("boolean")
    def marked(rows: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        lists, bitmaps = Answers(sent, "part"), Answers(answered, "part")

        def suspects(part: int) -> np.ndarray:
            maps = {(r["piece"], r["owner"]): r["bitmap"] for r in bitmaps.table(part).to_pylist()}
            found = []
            for r in lists.table(part).to_pylist():
                values = decode(r["coded"], r["n"], r["shift"], int(bounds[r["owner"]]))
                found.append(values[np.unpackbits(np.frombuffer(maps[r["piece"], r["owner"]], np.uint8))[: r["n"]].astype(bool)])
            return np.unique(np.concatenate(found))

        held: dict[int, np.ndarray] = {}
        for parts, codes in rows:
            out, numbers, values = np.zeros(len(parts), bool), parts.to_numpy(), codes.to_numpy()
            for part in np.unique(numbers).tolist():
                if part not in held:
                    held.clear()
                    held[part] = suspects(part)
                here = numbers == part
                at = np.searchsorted(held[part], values[here])
                out[here] = held[part].take(at, mode="clip") == values[here] if len(held[part]) else False
            yield pd.Series(out)

    return marked


def exact_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep_row: bool = False) -> DataFrame:
    """One row a row of ``docs``: its id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``; with ``keep_row`` the row itself, too."""
    spark = session(docs)
    ship(spark)
    text = F.coalesce(docs[text_col], F.lit(""))
    plain = F.when(text.rlike(rf"[\x09-\x0D]|\x20\x20"), F.regexp_replace(text, f"[{SPACES}]+", " ")).otherwise(text)
    chosen = docs.select(docs[id_col].alias("id"), plain.alias("text"), F.monotonically_increasing_id().alias("rid"), *([F.struct("*").alias("row")] if keep_row else []))
    rows = written(chosen.select("*", F.shiftrightunsigned("rid", 33).alias("part"), F.unhex(F.sha2("text", 256)).alias("sha"),
                                 F.shiftrightunsigned(F.xxhash64("text"), 64 - BITS).alias("code")), "rows")
    bounds = owner_bounds(max(partitions(spark), -(-rows.count() // OWNED)))

    sent = keep(rows.select("part", "code").mapInArrow(_messages(bounds), f"part long, {MESSAGE}"), "part", "sent")
    messages = spark.read.schema(f"{MESSAGE}, part long").parquet(sent)
    answered = keep(messages.groupBy("owner").applyInPandas(_bitmaps(bounds), "part long, piece long, owner long, bitmap binary"), "part", "answered")
    marked = _marker(sent, answered, bounds)(F.col("part"), F.col("code"))

    groups = rows.where(marked).groupBy("sha", "text").agg(
        F.min(F.struct(F.isnull("id").alias("none"), F.col("id"), F.col("rid"))).alias("first"), F.count(F.lit(1)).alias("group_size"), F.collect_set("part").alias("parts"))
    verdicts = groups.where("group_size > 1").select("sha", F.col("first.id").alias("keep_id"), F.col("first.rid").alias("keep_rid"), "group_size", F.explode("parts").alias("part"))

    wanted = ["id", "rid", "part", "sha", *(["row"] if keep_row else [])]
    suspects = rows.where(marked).select(*wanted).join(verdicts, ["part", "sha"], "left")
    alone = rows.where(~marked).select(*wanted, F.lit(None).cast(chosen.schema["id"].dataType).alias("keep_id"), F.lit(None).cast("long").alias("keep_rid"), F.lit(None).cast("long").alias("group_size"))
    found = suspects.unionByName(alone)
    single = F.isnull("keep_rid")
    return found.select(F.col("id").alias(id_col), F.when(single, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                        (single | (F.col("keep_rid") == F.col("rid"))).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), *(["row"] if keep_row else []))


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns as they were."""
    return exact_groups(docs, id_col=id_col, text_col=text_col, keep_row=True).where("kept").select("row.*")

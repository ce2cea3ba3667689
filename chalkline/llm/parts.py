"""Answers kept by part: what the tasks of one part of a table need to know of a result over all parts.

A part is what one task wrote. Its question goes out in compressed or counted form, the owners of the keys answer, and
``keep`` writes the answers into one folder a part of the shared folder. A task that later reads rows
of the part takes that folder alone (``Answers``), so the rows themselves are never shuffled and no
answer is broadcast. There is one such folder for each file of the rows, and its size is bounded by the
part's own rows.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame

from .common import new_path, session

#: Parts whose answers a worker holds at once.
HELD = 2


def keep(answers: DataFrame, part: str, label: str) -> str:
    """Write the answers, those of one part in one folder; the folder of them all."""
    path = new_path(session(answers), label)
    answers.repartition(part).write.partitionBy(part).parquet(path)
    return path


class Answers:
    """A worker's view of what ``keep`` wrote."""

    def __init__(self, path: str, part: str) -> None:
        self.path, self.part = path, part
        self.held: dict[int, object] = {}

    def table(self, number: int) -> pa.Table | None:
        """All answers to one part; None if it got none."""
        where, base = pafs.FileSystem.from_uri(self.path)
        folder = f"{base}/{self.part}={number}"
        found = where.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        names = sorted(f.path for f in found if f.is_file and f.base_name.endswith(".parquet"))
        if not names:
            return None
        tables = []
        for name in names:
            with where.open_input_file(name) as source:
                tables.append(pq.ParquetFile(source).read())
        return pa.concat_tables(tables)

    def of(self, number: int, build) -> object:
        """``build(table)`` of one part, held for the next rows."""
        if number not in self.held:
            while len(self.held) >= HELD:
                self.held.pop(next(iter(self.held)))
            self.held[number] = build(self.table(number))
        return self.held[number]

"""Where the knowledge base is kept. A store is made by name; ``parquet`` is the one that comes with this package."""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from chalkline import schemas
from chalkline.errors import ChalklineError
from chalkline.operators import search
from chalkline.operators.cells import Cells
from chalkline.operators.cells import write as write_cells
from chalkline.operators.knowledge import last_of_each
from chalkline.scratch import written

#: Buckets of ids in a segment; segments of about one size that are made one; versions whose segments stay; attempts of a commit.
BUCKETS, MERGE, KEEP, ATTEMPTS = 16, 4, 3, 20


class Store(Protocol):
    def ensure_collection(self, name: str, dimension: int) -> None: ...

    def upsert(self, name: str, points: DataFrame) -> None: ...

    def all_points(self, name: str) -> DataFrame: ...

    def vector_search(self, name: str, vector: list[float], limit: int) -> DataFrame: ...

    def index(self, name: str) -> search.Index: ...


@dataclass(frozen=True)
class Version:
    """One state of a collection: its number, the length of its vectors (0 unknown), and its segments (folder, rows), oldest first."""

    number: int
    dimension: int
    segments: tuple[tuple[str, int], ...]


class ParquetStore:
    """A log of segments for each collection.

    A segment is a folder of points that never changes, its rows in folders by a hash of their id. ``log/N.json`` is version N: the list of its
    segments, of which a later one replaces the ids of those before it. An upsert writes its own points as one segment and
    then publishes version N + 1 of the version N that it read; the whole text appears under its name at once or not at all. A writer that comes second starts again
    from the new version, so both land and the later commit wins an id. A version that can't be read (of a writer that died) is passed over.

    When ``MERGE`` segments at the end are of about one size they are made one, so old points are rewritten a logarithmic number of times. Each segment
    has its own postings and vector cells, made when a search first asks for them: an upsert leaves those of the other segments as they are.
    """

    def __init__(self, spark: SparkSession, location: str, *, buckets: int = BUCKETS) -> None:
        self.spark, self.location, self.buckets = spark, str(location).rstrip("/"), buckets

    # ---- the log

    def _fs(self, path: str):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _listed(self, folder: str) -> list[str]:
        fs, where = self._fs(folder)
        return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []

    def _text(self, path: str) -> str:
        fs, where = self._fs(path)
        opened = fs.open(where)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
        finally:
            opened.close()

    def _delete(self, path: str) -> None:
        fs, where = self._fs(path)
        fs.delete(where, True)

    def _versions(self, name: str) -> tuple[list[Version], int]:
        """Versions that can be read, oldest first, and the largest number in use."""
        folder = f"{self.location}/{name}/log"
        numbers = sorted(int(f[:-5]) for f in self._listed(folder) if f.endswith(".json") and f[:-5].isdigit())
        found = []
        for n in numbers:
            try:
                told = json.loads(self._text(f"{folder}/{n:010d}.json"))
                found.append(Version(n, told["dimension"], tuple((f, r) for f, r in told["segments"])))
            except (ValueError, KeyError, TypeError):
                continue
        return found, numbers[-1] if numbers else 0

    def version(self, name: str) -> Version | None:
        found, _ = self._versions(name)
        return found[-1] if found else None

    def _publish(self, name: str, number: int, text: str) -> bool:
        """Whether this text became version ``number``; false if another did."""
        folder = f"{self.location}/{name}/log"
        final, draft = f"{folder}/{number:010d}.json", f"{folder}/.{number}-{uuid.uuid4().hex}"
        fs, where = self._fs(draft)
        opened = fs.create(where, False)
        opened.write(bytearray(text, "utf-8"))
        opened.close()
        try:
            if fs.getScheme() == "file":  # a link fails if its name is taken; a local rename would replace
                local = lambda p: fs.makeQualified(self._fs(p)[1]).toUri().getPath()
                os.link(local(draft), local(final))
                return True
            jvm = self.spark.sparkContext._jvm
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
            kinds = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context.rename(where, self._fs(final)[1], kinds)
            return True
        except Exception:
            if self._fs(final)[0].exists(self._fs(final)[1]):
                return False
            raise
        finally:
            self._delete(draft)

    def _commit(self, name: str, change) -> Version:
        """Publish ``change(latest version or None)`` (dimension, segments) as the next version, anew for each that others publish meanwhile."""
        for _ in range(ATTEMPTS):
            found, most = self._versions(name)
            dimension, segments = change(found[-1] if found else None)
            made = Version(most + 1, dimension, tuple(segments))
            if self._publish(name, made.number, json.dumps({"dimension": dimension, "segments": segments})):
                self._drop_old([*found, made], name)
                return made
        raise ChalklineError(f"collection {name!r} is changed by other writers all the time; nothing of this was kept")

    def _drop_old(self, versions: list[Version], name: str) -> None:
        """Delete versions before the last ``KEEP`` and the segments that only they name."""
        old, kept = versions[:-KEEP], versions[-KEEP:]
        named = {f for v in kept for f, _ in v.segments}
        for v in old:
            for folder, _ in v.segments:
                if folder not in named:
                    for tail in ("", "-words", "-cells"):
                        self._delete(f"{self.location}/{name}/{folder}{tail}")
            self._delete(f"{self.location}/{name}/stats-{v.number}")
            self._delete(f"{self.location}/{name}/log/{v.number:010d}.json")

    # ---- segments

    def _write_segment(self, name: str, points: DataFrame) -> tuple[str, int]:
        folder = f"segment-{uuid.uuid4().hex}"
        path = f"{self.location}/{name}/{folder}"
        bucket = F.pmod(F.xxhash64("id"), F.lit(self.buckets)).cast("int")
        points.select(schemas.table("kb_points").fieldNames()).withColumn("bucket", bucket).repartition("bucket").write.partitionBy("bucket").parquet(path)
        return folder, self._segment(name, folder).count()

    def _segment(self, name: str, folder: str) -> DataFrame:
        return self.spark.read.schema(schemas.table("kb_points").add("bucket", IntegerType())).parquet(f"{self.location}/{name}/{folder}")

    def _latest(self, name: str, folders: list[str]) -> DataFrame | None:
        """(id, last): the last segment of each id that a segment but the first holds; None for one segment."""
        rows = None
        for n, folder in enumerate(folders[1:], 1):
            own = self._segment(name, folder).select("id", F.lit(n).alias("last"))
            rows = own if rows is None else rows.unionByName(own)
        return None if rows is None else rows.groupBy("id").agg(F.max("last").alias("last"))

    def _rows(self, name: str, folders: list[str]) -> DataFrame:
        """Live points of some segments, oldest first. Vectors of the first are never shuffled for small later ones."""
        rows = None
        for n, folder in enumerate(folders):
            own = self._segment(name, folder).withColumn("seg", F.lit(n))
            rows = own if rows is None else rows.unionByName(own)
        return search.alive(rows, self._latest(name, folders)).select(schemas.table("kb_points").fieldNames())

    def _read(self, name: str, version: Version | None) -> DataFrame:
        if version is None or not version.segments:
            return self.spark.createDataFrame([], schemas.table("kb_points"))
        return self._rows(name, [f for f, _ in version.segments])

    def _compact(self, name: str, version: Version) -> None:
        """Make the last segments one if ``MERGE`` of them are of about one size; given up if another writer did so."""
        tail = [version.segments[-1]] if version.segments else []
        for segment in reversed(version.segments[:-1]):
            if segment[1] > MERGE * sum(r for _, r in tail):
                break
            tail.insert(0, segment)
        if len(tail) < MERGE:
            return
        merged = self._write_segment(name, self._rows(name, [f for f, _ in tail]))

        def swap(now: Version | None) -> tuple[int, list]:
            held = list(now.segments) if now else []
            at = next((i for i in range(len(held)) if held[i : i + len(tail)] == tail), None)
            if at is None:
                raise ChalklineError("made one by another writer")
            return now.dimension, [*held[:at], merged, *held[at + len(tail) :]]

        try:
            self._commit(name, swap)
        except ChalklineError:
            self._delete(f"{self.location}/{name}/{merged[0]}")

    # ---- the collection

    def ensure_collection(self, name: str, dimension: int) -> None:
        """An empty collection if there is none; an error if its vectors have another length."""
        def change(now: Version | None) -> tuple[int, list]:
            if now is not None and now.dimension not in (0, dimension):
                raise ChalklineError(f"collection {name!r} holds vectors of {now.dimension} components, not {dimension}")
            return dimension, list(now.segments) if now else []

        now = self.version(name)
        if now is None or now.dimension != dimension:
            self._commit(name, change)

    def upsert(self, name: str, points: DataFrame) -> None:
        """Insert or replace by id; a column ``at``, if there, orders repeated ids, of which the last wins."""
        if "at" not in points.columns:
            points = points.withColumn("at", F.monotonically_increasing_id())
        segment = self._write_segment(name, last_of_each(points.select(*schemas.table("kb_points").fieldNames(), "at")))
        if not segment[1]:
            self._delete(f"{self.location}/{name}/{segment[0]}")
            return
        made = self._commit(name, lambda now: (now.dimension if now else 0, [*(now.segments if now else ()), segment]))
        self._compact(name, made)

    def all_points(self, name: str) -> DataFrame:
        """Payloads without vectors, which the scan then does not read; none for an unknown collection."""
        return self._read(name, self.version(name)).drop("vector")

    def with_vectors(self, name: str) -> DataFrame:
        return self._read(name, self.version(name))

    # ---- searches

    def index(self, name: str) -> search.Index:
        """The index of the collection's texts: each segment's own postings, and the counts of the live points of this version.

        Only segments that have none yet are tokenised. The counts are the sum of the segments' less those of replaced points, whose words the
        segments list.
        """
        version = self.version(name)
        if version is None or not version.segments:
            return search.build_index(self._read(name, None).select("id", "text"))
        folders = [f for f, _ in version.segments]
        paths = [f"{self.location}/{name}/{f}-words" for f in folders]
        for folder, path in zip(folders, paths):
            if not search.whole(self.spark, f"{path}/blocks"):
                listed = written(search.token_lists(self._segment(name, folder)), "tokens")
                search.write_segment(listed, path)
        latest = self._latest(name, folders)
        blocks, docs = ([self.spark.read.parquet(f"{p}/{kind}").withColumn("seg", F.lit(n)) for n, p in enumerate(paths)] for kind in ("blocks", "docs"))
        union = lambda tables: tables[0] if len(tables) == 1 else union(tables[:-1]).unionByName(tables[-1])
        stats = f"{self.location}/{name}/stats-{version.number}"
        if not search.whole(self.spark, f"{stats}/totals"):
            every, n = union(docs), F.sum("n").alias("df")
            counts = union(blocks).groupBy("token").agg(F.sum("n").alias("n"))
            if latest is not None:
                gone = every.join(latest, "id").where("last > seg").select(F.explode("tokens").alias("token")).groupBy("token").agg((-F.count(F.lit(1))).alias("n"))
                counts = counts.unionByName(gone)
            counts.groupBy("token").agg(n).where("df > 0").write.mode("overwrite").parquet(f"{stats}/terms")
            search.totals(search.alive(every.select("id", "dl", "seg"), latest), self.spark.read.parquet(f"{stats}/terms")).write.mode("overwrite").parquet(f"{stats}/totals")
        return search.Index(self.spark.read.parquet(f"{stats}/terms"), self.spark.read.parquet(f"{stats}/totals"), union(blocks), latest)

    def cells(self, name: str) -> Cells | None:
        """The vector cells of the collection's segments; None for an empty one."""
        version = self.version(name)
        if version is None or not version.segments:
            return None
        folders = [f for f, _ in version.segments]
        paths = [f"{self.location}/{name}/{f}-cells" for f in folders]
        for folder, path in zip(folders, paths):
            if not search.whole(self.spark, f"{path}/centres"):
                write_cells(self._segment(name, folder), path)
        return Cells.read(self.spark, paths, self._latest(name, folders))

    def vector_search(self, name: str, vector: list[float], limit: int) -> DataFrame:
        """(id, score), best first, from the cells that can hold them; none for an unknown collection."""
        cells = self.cells(name)
        return search.nearest(self._read(name, None), vector, limit) if cells is None else cells.nearest(vector, limit)


STORES = {"parquet": ParquetStore}


def build(kind: str, spark: SparkSession, location: str) -> Store:
    if kind not in STORES:
        raise ChalklineError(f"unknown store {kind!r}; there are: {', '.join(sorted(STORES))}")
    return STORES[kind](spark, location)

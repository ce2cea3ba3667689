"""Aligning speech with what was on screen, for many jobs at once.

``segments`` and ``visuals`` are the tables of ``schemas.TABLES``. Order inside a job is time, then
the ordinal. A job's visuals part its time into intervals, each up to the next visual; the last has no
end. Segments meet intervals in a sweep over ranges of time, so that a long or very frequent job is spread over tasks.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from chalkline.functions import text as T
from chalkline.functions.vectors import common_lines
from chalkline.scratch import written
from chalkline.shipping import ship

# Seconds before a boundary in which speech may belong to what comes next, share of lines
# from which two frames are one scrolled document, longest speech in a chunk, and the flags of chunks.
LOOKAHEAD_SECONDS = 10.0
SCROLL_SHARE = 0.60
LONGEST_SPEECH_SECONDS = 300.0
MERGED, ORPHAN = "merged_scroll", "orphan"


def intervals(visuals: DataFrame) -> DataFrame:
    """``visuals`` with ``idx`` (0 for a job's first) and ``until`` (the next visual's time, infinity for the last)."""
    order = Window.partitionBy("job_id").orderBy("timestamp", "vis_ord")
    return (visuals.withColumn("idx", F.row_number().over(order) - 1)
            .withColumn("until", F.coalesce(F.lead("timestamp").over(order), F.lit(float("inf")))))


#: Order of what happens at one time in a sweep: speech ends, a visual appears, speech begins.
ENDS, APPEARS, BEGINS = 0, 1, 2


class Sweep:
    """One job's visuals met so far in a range of time, and the segments that have begun in it."""

    def __init__(self) -> None:
        self.times: list[float] = []
        self.peaks: list[int] = []  # numbers of intervals that end, each longer than all behind it
        self.begun: dict[int, tuple[int, float]] = {}

    def appears(self, t: float) -> None:
        if self.times:
            length = t - self.times[-1]
            while self.peaks and self.length(self.peaks[-1]) < length:
                self.peaks.pop()
            self.peaks.append(len(self.times) - 1)
        self.times.append(t)

    def length(self, i: int) -> float:
        return self.times[i + 1] - self.times[i]

    def ends(self, start: float, at: int, end: float, before: bool) -> int:
        """The interval that a segment overlaps most, the earliest of equal ones; -1 is the one before this range, if there is one."""
        lo, hi = at - 1, len(self.times) - 1
        if lo == hi:
            return lo
        found = [(self.times[lo + 1] - start, lo)] if lo >= 0 or before else []
        first = bisect.bisect_left(self.peaks, lo + 1)
        if first < len(self.peaks):
            found.append((self.length(self.peaks[first]), self.peaks[first]))
        found.append((end - max(self.times[hi], start), hi))
        return max(found, key=lambda f: (f[0], -f[1]))[1]


def swept(segments: DataFrame, visuals: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """What a sweep through all times finds: (job_id, seg_ord, best), and (job_id, seg_ord, n_start, n_end, shown_at) of segments over a border.

    All times lie in one order, cut into ranges, so that a long job lies over many tasks. A task finds the interval of each segment that begins and ends in
    its range; what a job has before a range is added from the counts at the borders, one row a task. Of a segment that begins in one
    range and ends in another there are the visuals that appear by its start and before its end, and when the last of these did; None if there is no such segment.
    """
    spark = segments.sparkSession
    ship(spark)
    kind = lambda k: F.lit(k).alias("kind")
    said = segments.where(F.col("end") > F.col("start"))
    points = (visuals.select("job_id", F.coalesce("timestamp", F.lit(float("-inf"))).alias("t"), kind(APPEARS), F.col("vis_ord").cast("long").alias("o"))
              .unionByName(said.select("job_id", F.explode(F.array(F.struct(F.col("start").alias("t"), kind(BEGINS)), F.struct(F.col("end").alias("t"), kind(ENDS)))).alias("p"), F.col("seg_ord").cast("long").alias("o"))
                           .select("job_id", "p.t", "p.kind", "o")))
    order = ["job_id", "t", "kind", "o"]
    job = segments.schema["job_id"].dataType.simpleString()
    dealt = points.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    dealt = dealt.select(*order, F.spark_partition_id().alias("part"))
    names = ["job_id", "o", "kind", "n", "last", "best", "best_after", "part", "at_border", "over"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64()]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row (kind ENDS) for each segment; of one over a border a row for each side, without ``best``; and one of a null kind that tells what the next range begins with."""
        now, state, border, part, over, out, job_kind = None, None, True, 0, 0, [], pa.string()

        def table() -> pa.RecordBatch:
            columns = list(zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [job_kind, *kinds])], names=names)

        def left_open() -> None:
            nonlocal over
            for o, (n, _) in state.begun.items():
                over += 1
                out.append((now, o, BEGINS, n, None, None, None, part, border, None))

        for batch in batches:
            job_kind = batch.column(0).type
            for j, t, k, o, part in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or j != now:
                    if state is not None:
                        left_open()
                        border = False
                    now, state = j, Sweep()
                if k == APPEARS:
                    state.appears(t)
                elif k == BEGINS:
                    state.begun[o] = (len(state.times), t)
                elif o in state.begun:
                    at, start = state.begun.pop(o)
                    best = state.ends(start, at, t, False)
                    after = state.ends(start, at, t, True) if border and at == 0 else best
                    out.append((now, o, ENDS, len(state.times), None, best, after, part, border, None))
                else:
                    over += 1
                    out.append((now, o, ENDS, len(state.times), state.times[-1] if state.times else None, None, None, part, border, None))
                if len(out) >= 10_000:
                    yield table()
                    out.clear()
        if state is not None:
            left_open()
            out.append((now, None, None, len(state.times), state.times[-1] if state.times else None, None, None, part, border, over))
        if out:
            yield table()

    counted = written(dealt.mapInArrow(count, f"job_id {job}, o long, kind int, n long, last double, best long, best_after long, part int, at_border boolean, over long"), "swept")
    carried, now, over = [], (None, 0, None), 0  # of each range: the job before it, its visuals so far, and its last time
    for r in sorted(counted.where("kind is null").collect(), key=lambda r: r.part):  # a row a range
        carried.append((r.part, *now))
        same = r.at_border and now[0] == r.job_id
        now = (r.job_id, r.n + (now[1] if same else 0), r.last if r.last is not None else (now[2] if same else None))
        over += r.over
    before = spark.createDataFrame(carried, f"part int, before_job {job}, before_n long, before_last double")
    rows = counted.where("kind is not null").join(F.broadcast(before), "part")
    goes_on = F.col("at_border") & F.col("before_job").eqNullSafe(F.col("job_id"))
    earlier = F.when(goes_on, F.col("before_n")).otherwise(F.lit(0))
    best = F.when(earlier > 0, F.col("best_after") + earlier).otherwise(F.col("best"))
    found = rows.where("best is not null").select("job_id", F.col("o").alias("seg_ord"), best.cast("int").alias("best"))
    if not over:
        return found, None
    rows = rows.where("best is null").select("job_id", F.col("o").alias("seg_ord"), "kind", (F.col("n") + earlier).alias("n"), F.coalesce("last", F.when(goes_on, F.col("before_last"))).alias("last"))
    at = lambda k, c: F.max(F.when(F.col("kind") == k, F.col(c)))
    return found, rows.groupBy("job_id", "seg_ord").agg(at(BEGINS, "n").alias("n_start"), at(ENDS, "n").alias("n_end"), at(ENDS, "last").alias("shown_at"))


def _longest(spans: DataFrame, wanted: DataFrame) -> DataFrame:
    """For (job_id, seg_ord, lo, hi) the (length, place) of the longest of the spans lo..hi, the earliest of equal ones.

    Spans are (job_id, idx, length). A table of the longest of 1, 2, 4, ... spans from each on answers any range by two of its rows.
    """
    best = lambda a, b: F.when(b["length"] > a["length"], b).otherwise(a)
    steps = wanted.select(F.max(F.col("hi") - F.col("lo") + 1).alias("m")).first().m
    level = spans.select("job_id", "idx", F.struct("length", F.col("idx").alias("place")).alias("best"))
    table, size = level.withColumn("size", F.lit(1)), 1
    while steps is not None and size * 2 <= steps:
        later = level.select("job_id", (F.col("idx") - size).alias("idx"), F.col("best").alias("other"))
        level = level.join(later, ["job_id", "idx"]).select("job_id", "idx", best(F.col("best"), F.col("other")).alias("best"))
        size *= 2
        table = table.unionByName(level.withColumn("size", F.lit(size)))
    asked = wanted.withColumn("size", F.expr("cast(shiftleft(1, cast(floor(log2(hi - lo + 1)) as int)) as int)"))
    one = asked.join(table.withColumnRenamed("idx", "lo").withColumnRenamed("best", "one"), ["job_id", "lo", "size"])
    both = one.withColumn("from", F.col("hi") - F.col("size") + 1).join(table.withColumnRenamed("idx", "from").withColumnRenamed("best", "two"), ["job_id", "from", "size"])
    return both.select("job_id", "seg_ord", best(F.col("one"), F.col("two")).alias("middle"))


def anchor(segments: DataFrame, visuals: DataFrame) -> DataFrame:
    """``segments`` of jobs that have visuals, with ``idx``: the interval that a segment overlaps most.

    Ties go to the earliest interval, and so does a segment that overlaps none. A sweep through the times finds the interval; only a segment
    over a border of its ranges is looked up in a table. So no segment is joined to all the intervals it covers.
    """
    best, over = swept(segments, visuals)
    if over is not None:
        best = best.unionByName(_over_borders(over, segments, visuals))
    best = best.where("best >= 0")
    shown = visuals.select("job_id").distinct()
    return (segments.join(shown, "job_id", "left_semi").join(best, ["job_id", "seg_ord"], "left")
            .withColumn("idx", F.coalesce("best", F.lit(0))).drop("best"))


def _over_borders(over: DataFrame, segments: DataFrame, visuals: DataFrame) -> DataFrame:
    """(job_id, seg_ord, best) of segments that begin and end in different ranges of the sweep: the first interval's end and the longest of those between are joined."""
    spans = intervals(visuals).select("job_id", "idx", F.coalesce("timestamp", F.lit(float("-inf"))).alias("a"), F.col("until").alias("b"))
    found = over.select("job_id", "seg_ord", (F.col("n_start") - 1).cast("int").alias("lo"), (F.col("n_end") - 1).cast("int").alias("hi"), "shown_at")
    found = written(found.where("hi >= 0"), "over")
    crossing = found.where("lo < hi").join(segments.select("job_id", "seg_ord", "start", "end"), ["job_id", "seg_ord"])
    wanted = crossing.where("hi - lo >= 2").select("job_id", "seg_ord", (F.col("lo") + 1).alias("lo"), (F.col("hi") - 1).alias("hi"))
    middle = _longest(spans.select("job_id", "idx", (F.col("b") - F.col("a")).alias("length")), wanted)
    ends = spans.select("job_id", F.col("idx").alias("lo"), F.col("b").alias("first_end"))
    none = F.struct(F.lit(-1.0).alias("length"), F.lit(-1).alias("place"))
    told = crossing.join(ends, ["job_id", "lo"], "left").join(middle, ["job_id", "seg_ord"], "left")
    first = F.when(F.col("lo") >= 0, F.struct((F.col("first_end") - F.col("start")).alias("length"), F.col("lo").alias("place"))).otherwise(none)
    last = F.struct((F.col("end") - F.greatest("shown_at", "start")).alias("length"), F.col("hi").alias("place"))
    better = lambda x, y: F.when(y["length"] > x["length"], y).otherwise(x)
    chosen = told.select("job_id", "seg_ord", better(better(first, F.coalesce("middle", none)), last)["place"].alias("best"))
    return found.where("lo = hi").select("job_id", "seg_ord", F.col("lo").alias("best")).unionByName(chosen)


def lookahead(anchored: DataFrame, visuals: DataFrame, languages: DataFrame | None = None) -> DataFrame:
    """``anchored`` with ``hops``, and ``idx`` moved on by them.

    A segment that starts less than ten seconds before the end of its interval moves to the next if it
    shares more words with the next visual than with its own, and may move on from there. Whether it
    does depends on its own words and on pairs of neighbouring visuals alone; the hops are the length
    of the unbroken run of boundaries that it passes. ``languages`` (job_id, language) names the stop
    words to leave out.
    """
    known = anchored.sparkSession.createDataFrame([], "job_id string, language string") if languages is None else languages.select("job_id", "language")
    known = known.withColumn("language", T.language_code(F.col("language")))
    words = lambda df, c: T.content_words(F.coalesce(F.col(c), F.lit("")), F.coalesce(F.col("language"), F.lit("")))
    order = Window.partitionBy("job_id").orderBy("idx")
    shown = intervals(visuals).join(known, "job_id", "left")
    shown = shown.withColumn("here", words(shown, "text")).withColumn("next", F.lead("here").over(order))
    ends = shown.where(F.col("next").isNotNull()).select("job_id", F.col("idx").alias("i"), F.col("until").alias("end_at"), "here", "next")
    slot = lambda t: F.floor(t / F.lit(LOOKAHEAD_SECONDS))
    ends = ends.withColumn("slot", slot(F.col("end_at")))
    said = anchored.join(known, "job_id", "left")
    said = said.select("job_id", "seg_ord", "start", "idx", words(said, "text").alias("said"))
    said = said.withColumn("slot", F.explode(F.array(slot(F.col("start")), slot(F.col("start")) + 1)))
    near = (said.join(ends, ["job_id", "slot"])
            .where((F.col("i") >= F.col("idx")) & (F.col("end_at") - LOOKAHEAD_SECONDS <= F.col("start")) & (F.col("start") < F.col("end_at"))))
    passed = near.where(T.overlap(F.col("said"), F.col("next")) > T.overlap(F.col("said"), F.col("here")))
    run = Window.partitionBy("job_id", "seg_ord").orderBy("i")
    hops = (passed.withColumn("nth", F.row_number().over(run) - 1).where(F.col("i") - F.col("idx") == F.col("nth"))
            .groupBy("job_id", "seg_ord").agg(F.count(F.lit(1)).cast("int").alias("hops")))
    return (anchored.join(hops, ["job_id", "seg_ord"], "left").withColumn("hops", F.coalesce("hops", F.lit(0)))
            .withColumn("idx", F.col("idx") + F.col("hops")))


_SEG = ("start", "end", "text", "words")
_VIS = ("timestamp", "kind", "text", "code_language", "description", "diagram")


def _sorted(items: Column, fields: tuple[str, ...]) -> Column:
    """Structs collected with their order in front, sorted by it, without it."""
    return F.transform(F.array_sort(items), lambda x: F.struct(*[x[f].alias(f) for f in fields]))


def bounds(segments: Column, visuals: Column) -> tuple[Column, Column]:
    """Start and end of a chunk by what is in it; 0 if it is empty."""
    times = F.transform(visuals, lambda v: v["timestamp"])
    start = F.array_min(F.concat(F.transform(segments, lambda s: s["start"]), times))
    end = F.array_max(F.concat(F.transform(segments, lambda s: s["end"]), times))
    return F.coalesce(start, F.lit(0.0)), F.coalesce(end, start, F.lit(0.0))


def chunks(placed: DataFrame, visuals: DataFrame) -> DataFrame:
    """(job_id, idx, segments, visuals, flags): a chunk for each visual, with the segments placed there."""
    key = lambda c: F.struct(F.col(c[0]), F.col(c[1]))
    said = placed.groupBy("job_id", "idx").agg(F.collect_list(F.struct(key(("start", "seg_ord")).alias("at"), *_SEG)).alias("segments"))
    said = said.withColumn("segments", _sorted(F.col("segments"), _SEG))
    shown = intervals(visuals).select("job_id", "idx", F.array(F.struct(*_VIS)).alias("visuals"))
    empty = F.array().cast(said.schema["segments"].dataType)
    return (shown.join(said, ["job_id", "idx"], "left").select("job_id", "idx", F.coalesce("segments", empty).alias("segments"), "visuals",
            F.array().cast("array<string>").alias("flags")))



def fold_scroll(frames: list[dict], share: float = SCROLL_SHARE) -> list[dict]:
    """Frames of one run of code chunks, merged while the next shares enough lines with what has been merged.

    Returns {"first", "count", "visual"} of each document; lines stand where they first appear.
    """
    out: list[dict] = []
    for at, frame in enumerate(frames):
        if out:
            now, lines = out[-1]["visual"], (frame["text"] or "").splitlines()
            held = (now["text"] or "").splitlines()
            shorter = min(len(held), len(lines))
            if shorter and common_lines([x.rstrip() for x in held], [x.rstrip() for x in lines]) / shorter >= share:
                order: dict[str, str] = {}
                for line in held + lines:
                    order.setdefault(line.rstrip(), line)
                out[-1]["visual"] = {"timestamp": min(now["timestamp"], frame["timestamp"]), "kind": "code", "text": "\n".join(order.values()), "diagram": "",
                                     "code_language": now["code_language"] or frame["code_language"], "description": now["description"] or frame["description"]}
                out[-1]["count"] += 1
                continue
        out.append({"first": at, "count": 1, "visual": frame})
    return out


def merge_scrolls(parts: DataFrame, share: float = SCROLL_SHARE) -> DataFrame:
    """``parts`` (as of ``chunks``) with runs of code chunks that show one scrolled document made one; ``merges`` counts them.

    The merged document is compared with the next frame, so a run is folded in order; runs are apart by
    chunks that don't show code alone, and only runs of two or more leave the JVM.
    """
    ship(parts.sparkSession)
    order = Window.partitionBy("job_id").orderBy("idx")
    code = (F.size("visuals") == 1) & (F.get("visuals", F.lit(0))["kind"] == "code")
    marked = parts.withColumn("code", code).withColumn("run", F.sum(F.when(F.col("code") & F.coalesce(F.lag("code").over(order), F.lit(False)), 0).otherwise(1)).over(order))
    length = F.count(F.lit(1)).over(Window.partitionBy("job_id", "run"))
    marked = marked.withColumn("length", length)
    alone = marked.where("length = 1").select("job_id", "idx", "segments", "visuals", "flags", F.lit(0).alias("merges"))
    runs = marked.where("length > 1").select("job_id", "run", "idx", F.get("visuals", F.lit(0)).alias("v"))

    def fold(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("idx")
        rows = []
        for made in fold_scroll([dict(v) if isinstance(v, dict) else v.asDict() for v in table["v"]], share):
            own = table["idx"].iloc[made["first"] : made["first"] + made["count"]]
            rows += [(table["job_id"].iloc[0], int(i), int(own.iloc[0]), made["count"] - 1, made["visual"]) for i in own]
        return pd.DataFrame(rows, columns=["job_id", "idx", "into", "merges", "visual"])

    visual = "struct<timestamp:double,kind:string,text:string,code_language:string,description:string,diagram:string>"
    folded = runs.groupBy("job_id", "run").applyInPandas(fold, f"job_id string, idx int, into int, merges int, visual {visual}")
    joined = (parts.select("job_id", "idx", "segments", "flags").join(folded, ["job_id", "idx"])
              .groupBy("job_id", "into").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("idx", "segments"))), lambda x: x["segments"])).alias("segments"),
                                             F.first("visual").alias("visual"), F.first("merges").alias("merges"), F.flatten(F.collect_list("flags")).alias("flags")))
    by_start = F.transform(F.array_sort(F.transform("segments", lambda s, i: F.struct(s["start"].alias("a"), i.alias("i"), s.alias("s")))), lambda x: x["s"])
    flags = F.when(F.col("merges") > 0, F.array_distinct(F.array_append("flags", F.lit(MERGED)))).otherwise(F.col("flags"))
    joined = joined.select("job_id", F.col("into").alias("idx"), by_start.alias("segments"), F.array("visual").alias("visuals"), flags.alias("flags"), "merges")
    return alone.unionByName(joined)


def attach_orphans(parts: DataFrame) -> DataFrame:
    """``parts`` where visuals without speech ride with the job's next chunk that has some; ``orphans`` counts them.

    What is left at the end makes a last chunk flagged as orphan alone. An orphan's own flags are lost.
    """
    onward = Window.partitionBy("job_id").orderBy("idx").rowsBetween(0, Window.unboundedFollowing)
    speaks = F.size("segments") > 0
    home = F.coalesce(F.min(F.when(speaks, F.col("idx"))).over(onward), F.lit(2147483647))
    grouped = parts.withColumn("speaks", speaks).withColumn("home", home).groupBy("job_id", "home").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("idx", "visuals"))), lambda x: x["visuals"])).alias("visuals"),
        F.max_by("segments", "speaks").alias("segments"), F.max_by("flags", "speaks").alias("flags"), F.sum(F.when(F.col("speaks"), 0).otherwise(1)).cast("int").alias("orphans"),
        F.sum("merges").cast("int").alias("merges"))
    trailing = F.col("home") == 2147483647
    flags = F.when(trailing, F.array(F.lit(ORPHAN))).when(F.col("orphans") > 0, F.array_distinct(F.array_append("flags", F.lit(ORPHAN)))).otherwise(F.col("flags"))
    return grouped.select("job_id", F.col("home").alias("idx"), "segments", "visuals", flags.alias("flags"), "merges", "orphans")


def cut_speech(starts: list[float], ends: list[float], longest: float = LONGEST_SPEECH_SECONDS) -> list[int]:
    """Numbers of the segments that a new part starts at: speech over ``longest`` is cut at its widest pause, the earliest in ties, and so on."""
    cuts, todo = [], [(0, len(starts))]
    while todo:
        a, b = todo.pop()
        if b - a < 2 or ends[b - 1] - starts[a] <= longest:
            continue
        at = max(range(a, b - 1), key=lambda k: (starts[k + 1] - ends[k], -k)) + 1
        cuts.append(at)
        todo += [(a, at), (at, b)]
    return sorted(cuts)


@F.pandas_udf(ArrayType(IntegerType()))
def _cuts(starts: pd.Series, ends: pd.Series) -> pd.Series:
    return pd.Series([cut_speech(list(a), list(b)) for a, b in zip(starts, ends)])


def split_bounds(parts: DataFrame) -> DataFrame:
    """``parts`` with chunks over five minutes of speech cut at pauses; visuals go by their time, flags to every part.

    Adds ``part``. Only start and end times leave the JVM, and only of chunks that are too long.
    """
    ship(parts.sparkSession)
    speech = F.element_at("segments", -1)["end"] - F.element_at("segments", 1)["start"]
    long = (F.size("segments") > 1) & (speech > LONGEST_SPEECH_SECONDS)
    marked = parts.withColumn("long", F.coalesce(F.when(F.size("segments") > 1, long), F.lit(False)))
    whole = marked.where(~F.col("long")).withColumn("part", F.lit(0)).drop("long")
    cut = marked.where("long").withColumn("cuts", _cuts(F.transform("segments", lambda s: s["start"]), F.transform("segments", lambda s: s["end"]))).drop("long")
    cut = cut.select("*", F.posexplode(F.concat(F.array(F.lit(0)), "cuts")).alias("part", "first"))
    until = F.coalesce(F.get("cuts", F.col("part")), F.size("segments"))
    # a cut's time is the start of the first segment after it; visuals before a part's time are in an earlier part
    left, right = F.get("segments", F.col("first"))["start"], F.get("segments", until)["start"]
    own = F.filter("visuals", lambda v: ((F.col("part") == 0) | (v["timestamp"] >= left)) & (right.isNull() | (v["timestamp"] < right)))
    cut = cut.withColumn("segments_", F.slice("segments", F.col("first") + 1, until - F.col("first"))).withColumn("visuals", own)
    cut = cut.drop("segments", "cuts", "first").withColumnRenamed("segments_", "segments")
    return whole.unionByName(cut)


def align(segments: DataFrame, visuals: DataFrame, languages: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(timeline, report) of all jobs: the five rules in their order.

    timeline: job_id, chunk_ord, start, end, segments, visuals, flags. report: job_id, chunk_count,
    segment_count, lookahead_moves, scroll_merges, orphans. A job without visuals is one chunk of all
    its speech, cut at pauses; one without speech keeps its visuals in a last chunk.
    """
    placed = written(lookahead(anchor(segments, visuals), visuals, languages), "placed")  # used twice
    moves = placed.groupBy("job_id").agg(F.sum("hops").cast("int").alias("lookahead_moves"))
    parts = attach_orphans(merge_scrolls(chunks(placed, visuals)))
    counts = parts.groupBy("job_id").agg(F.sum("merges").cast("int").alias("scroll_merges"), F.sum("orphans").cast("int").alias("orphans"))
    unseen = segments.join(visuals.select("job_id").distinct(), "job_id", "left_anti")
    said = unseen.groupBy("job_id").agg(F.collect_list(F.struct(F.struct("start", "seg_ord").alias("at"), *_SEG)).alias("segments"))
    said = said.select("job_id", F.lit(0).alias("idx"), _sorted(F.col("segments"), _SEG).alias("segments"), F.array().cast(parts.schema["visuals"].dataType).alias("visuals"),
                       F.array().cast("array<string>").alias("flags"), F.lit(0).alias("merges"), F.lit(0).alias("orphans"))
    final = split_bounds(parts.unionByName(said))
    start, end = bounds(F.col("segments"), F.col("visuals"))
    order = Window.partitionBy("job_id").orderBy("idx", "part")
    timeline = final.select("job_id", (F.row_number().over(order) - 1).alias("chunk_ord"), start.alias("start"), end.alias("end"), "segments", "visuals", "flags")
    total = timeline.groupBy("job_id").agg(F.count(F.lit(1)).cast("int").alias("chunk_count"), F.sum(F.size("segments")).cast("int").alias("segment_count"))
    report = total.join(moves, "job_id", "left").join(counts, "job_id", "left").na.fill(0)
    return timeline, report

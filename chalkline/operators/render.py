"""Digests and evaluation reports as Markdown.

Notes become text by column functions; numbers with one decimal are formatted in Python, whose rounding
the reports follow.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from chalkline.functions import text as T
from chalkline.operators.evaluate import WORDS_A_MINUTE, reading_words


@F.pandas_udf(StringType())
def one_decimal(values: pd.Series) -> pd.Series:
    return values.map(lambda x: None if pd.isna(x) else f"{x:.1f}")


def note_section(source: Column) -> Column:
    """A note's section; parts that it lacks are left out."""
    some = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    block = lambda *lines: F.concat_ws("\n", *[x if isinstance(x, Column) else F.lit(x) for x in lines])
    listed = lambda c: F.size(F.coalesce(c, F.array().cast("array<string>"))) > 0
    head = block(F.concat(F.lit("## "), F.col("concept")), "", F.concat(T.timestamp_link(source, F.col("source_timestamp")), F.lit(" · concept `"), F.col("canonical_concept_id"), F.lit("`")))
    drawing = F.when(some("diagram"), block("**Diagram**", "", "```text", F.col("diagram"), "```"))
    code = F.when(some("code_snippet"), F.concat(block("```", F.col("code_snippet"), "```"), F.when(F.col("partial"), "\n_(code fragment)_").otherwise("")))
    pitfalls = F.when(listed(F.col("pitfalls")), block("**Pitfalls**", "", F.array_join(F.transform("pitfalls", lambda p: F.concat(F.lit("- "), p)), "\n")))
    depends = F.when(listed(F.col("depends_on")), F.concat(F.lit("**Depends on:** "), F.array_join(F.transform("depends_on", lambda d: F.concat(F.lit("`"), d, F.lit("`"))), ", ")))
    return F.concat_ws("\n\n", head, F.when(some("summary"), F.col("summary")), drawing, code, pitfalls, depends)


def digests(notes: DataFrame, videos: DataFrame) -> DataFrame:
    """(job_id, digest): a job's whole digest, for every job in ``videos``."""
    named = notes.join(videos.select("job_id", "source_path"), "job_id")
    sections = named.select("job_id", "note_ord", reading_words(named).alias("words"), note_section(F.col("source_path")).alias("section"))
    whole = sections.groupBy("job_id").agg(F.sum("words").alias("words"), F.array_sort(F.collect_list(F.struct("note_ord", "section"))).alias("sections"))
    rows = videos.join(whole, "job_id", "left")
    listed = F.coalesce(F.transform("sections", lambda s: s["section"]), F.array().cast("array<string>"))
    words = F.coalesce("words", F.lit(0))
    reading, minutes = words / F.lit(float(WORDS_A_MINUTE)), F.col("duration_s") / 60
    ratio = F.when(reading > 0, F.try_divide(minutes, reading)).otherwise(F.lit(0.0))
    name = F.regexp_extract("source_path", "([^/]+)/*$", 1)
    head = F.concat(F.lit("# Study Digest\n\nSource: "), name, F.lit(" · "), F.size(listed).cast("string"), F.lit(" note(s)\n\n"))
    body = F.when(F.size(listed) == 0, F.lit("_No notes._\n\n")).otherwise(F.array_join(F.transform(listed, lambda s: F.concat(F.lit("---\n\n"), s, F.lit("\n\n"))), ""))
    foot = F.concat(F.lit("---\n\n## Compression\n\n- Video length: "), T.hms(F.col("duration_s")), F.lit(" ("), one_decimal(minutes), F.lit(" min)\n- Reading time: ~"), one_decimal(reading),
                    F.lit(f" min at {WORDS_A_MINUTE} wpm\n- Compression: "), one_decimal(ratio), F.lit("x\n"))
    return rows.select("job_id", F.concat(head, body, foot).alias("digest"))


def percent(part: int, whole: int) -> str:
    return f"{100 * part / whole:.0f}%" if whole else "n/a"


def _verification(found: dict | None, command: str | None) -> list[str]:
    if command is None:
        return ["_No verification command for this profile._"]
    if found is None:
        return [f"_Tool `{(command.split() or ['(command)'])[0]}` not found on PATH; skipped._"]
    if not found["total"]:
        return ["_No verifiable code snippets in this job._"]
    bad = [f"  - failed @ {f['source_timestamp']:.0f}s: {f['reason']}" for f in found["failures"][:5]]
    return [f"- Command: `{command}`", f"- **Extracted code compiles: {found['passed']}/{found['total']} ({percent(found['passed'], found['total'])})**", *bad]


def _vocabulary(found: dict | None) -> list[str]:
    if found is None:
        return ["_No vocabulary for this profile._"]
    missing = found["missing"]
    more = f" (+{len(missing) - 10} more)" if len(missing) > 10 else ""
    return [f"- **Terms found in transcript: {found['found']}/{found['total']} ({percent(found['found'], found['total'])})**", *([f"- Missing: {', '.join(missing[:10])}{more}"] if missing else [])]


def _grounding(found: dict | None, skipped: str | None) -> list[str]:
    if skipped:
        return [f"_Skipped: {skipped}._"]
    if found is None:
        return ["_No notes to check._"]
    bad = [f"  - unsupported @ {u['source_timestamp']:.0f}s: {u['concept']}" for u in found["unsupported"][:5]]
    return [f"- **Fully-supported notes: {found['supported']}/{found['sampled']} ({percent(found['supported'], found['sampled'])})**", *bad]


def _statistics(s: dict, stage_seconds: dict[str, float], total_seconds: float | None) -> list[str]:
    known = s["compression_ratio"] is not None and s["video_minutes"] is not None
    out = [f"- Compression: {s['video_minutes']:.1f} min video -> {s['reading_minutes']:.1f} min read = **{s['compression_ratio']:.1f}x**" if known
           else f"- Reading time: {s['reading_minutes']:.1f} min (video length unknown)", f"- Estimated cost: ${s['est_cost_usd']:.2f} total (est.)"]
    if s["est_cost_per_video_hour"] is not None:
        out.append(f"  - ~${s['est_cost_per_video_hour']:.2f} per video-hour")
    if stage_seconds:
        total = f" (total {total_seconds:.1f}s)" if total_seconds else ""
        return [*out, f"- Wall-clock: {', '.join(f'{k} {v:.1f}s' for k, v in stage_seconds.items())}{total}"]
    return [*out, "- Wall-clock: not recorded (run `process` to capture)"]


def report(profile_name: str, *, command: str | None, verification: dict | None, vocabulary: dict | None, grounding: dict | None, grounding_skipped: str | None,
           statistics: dict, stage_seconds: dict[str, float] | None = None, total_seconds: float | None = None) -> str:
    """The report of one job, from the one-row results of its checks."""
    sections = {"Code verification": _verification(verification, command), "Vocabulary hit-rate": _vocabulary(vocabulary), "Grounding spot-check": _grounding(grounding, grounding_skipped),
                "Pipeline stats": _statistics(statistics, stage_seconds or {}, total_seconds)}
    lines = ["# Eval Report", "", f"Profile: `{profile_name}`", ""]
    for title, body in sections.items():
        lines += [f"## {title}", "", *body, ""]
    return "\n".join(lines) + "\n"
